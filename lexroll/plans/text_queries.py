"""Queries on texts: lines and sections of documents, names, JSON, answers, codes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexroll.functions import answers, text
from lexroll.operators import sections as cut
from lexroll.operators.labels import code_rollup as roll_up, code_titles, resolve_label as resolve
from lexroll.operators.reports import run_metrics as metrics_of
from lexroll.plans.catalog import query, table
from lexroll.profile import CODE_TITLES, TYPE_LABELS, CleanRules, NameRules, SectionRules
from lexroll.sources.tables import harvest, load_dimension

# The rules for the bundled documents.
RULES = SectionRules(
    anchor="^the( |$)", confirm="(^| )and( |$)", header="^(and|of|in|to|is|de|en|la|der) ", terminator=r"\|"
)
CLEANING = CleanRules(removals=(r"\s*licensed.*", r";\s*tion.*", r"\s*the the( |$)", r"\s*\(?see .*?(\(|$)"))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "text")


def sections(spark: SparkSession, folder: str) -> DataFrame:
    lines = documents(spark, folder).select("doc_id", cut.paragraphs_of(F.col("text")).alias("paragraphs"))
    return cut.with_sections(lines, "paragraphs", RULES)


def judged(spark: SparkSession, folder: str) -> DataFrame:
    return cut.with_items(sections(spark, folder), RULES, CLEANING)


def cleaned_sql(column: str) -> str:
    for rule in (r"[\x00-\x08\x0b\x0c\x0e-\x1f]", *CLEANING.removals):
        column = f"regexp_replace({column}, '{rule}', '', 'gi')"
    column = rf"trim(regexp_replace({column}, '^\s*\d+([-.]\w+)*\)\s*', ''))"
    return f"trim(regexp_replace(trim(regexp_replace({column}, '[ \\t]+', ' ', 'g')), '[;,]+$', ''))"


LINES = """l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS idx
  FROM documents), n AS (
  SELECT *, trim(regexp_replace(line, '\\s+', ' ', 'g')) AS t FROM l)"""
SECTIONS = f"""{LINES}, f AS (
  SELECT *, regexp_matches(t, '(?i){RULES.anchor}') AS a,
    max(CASE WHEN regexp_matches(t, '(?i){RULES.confirm}') THEN 1 ELSE 0 END)
      OVER (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) AS c FROM n), s AS (
  SELECT *, sum(CASE WHEN a AND c = 1 THEN 1 ELSE 0 END)
      OVER (PARTITION BY doc_id ORDER BY idx ROWS UNBOUNDED PRECEDING) AS section_no FROM f), sections AS (
  SELECT doc_id, CAST(section_no AS BIGINT) AS section_no, idx, line, t FROM s WHERE section_no >= 1)"""
ITEMS = f"""{SECTIONS}, h AS (
  SELECT doc_id, section_no, min(CASE WHEN regexp_matches(t, '(?i){RULES.header}') THEN idx END) AS head
  FROM sections GROUP BY ALL), e AS (
  SELECT s.doc_id, s.section_no, min(idx) AS stop FROM sections s JOIN h USING (doc_id, section_no)
  WHERE idx > head AND regexp_matches(t, '(?i){RULES.terminator}') GROUP BY ALL), raw AS (
  SELECT s.doc_id, s.section_no, idx, {cleaned_sql('t')} AS item
  FROM sections s JOIN h USING (doc_id, section_no) LEFT JOIN e USING (doc_id, section_no)
  WHERE idx > head AND (stop IS NULL OR idx < stop) AND t <> '' AND NOT regexp_matches(t, '(?i){RULES.header}')), items AS (
  SELECT * FROM raw WHERE item <> ''), status AS (
  SELECT h.doc_id, h.section_no, CASE WHEN head IS NULL THEN 'HEADER_NOT_FOUND' WHEN n IS NULL THEN 'NO_ITEMS_FOUND' ELSE 'OK' END
    AS status, coalesce(n, 0) AS n
  FROM h LEFT JOIN (SELECT doc_id, section_no, count(*) AS n FROM items GROUP BY ALL) USING (doc_id, section_no))"""


@query(f"WITH {LINES} SELECT doc_id, idx AS para_idx, line AS text FROM l")
def paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    rows = cut.paragraph_rows(documents(spark, folder), "doc_id", "text")
    return rows.withColumn("para_idx", F.col("para_idx").cast("long"))


@query(f"WITH {SECTIONS} SELECT doc_id, section_no, idx AS para_idx, line AS text FROM sections")
def section_split(spark: SparkSession, folder: str) -> DataFrame:
    rows = cut.section_rows(sections(spark, folder), "doc_id")
    return rows.select("doc_id", F.col("section_no").cast("long").alias("section_no"), F.col("para_idx").cast("long").alias("para_idx"), "text")


@query(
    f"""WITH {ITEMS} SELECT doc_id, section_no, row_number() OVER (PARTITION BY doc_id, section_no ORDER BY idx) AS item_no, item
FROM items"""
)
def section_items(spark: SparkSession, folder: str) -> DataFrame:
    rows = cut.item_rows(judged(spark, folder), ["doc_id", "section_no"])
    return rows.select("doc_id", F.col("section_no").cast("long").alias("section_no"), F.col("item_no").cast("long").alias("item_no"), "item")


@query(f"WITH {ITEMS} SELECT doc_id, section_no, status FROM status")
def section_status(spark: SparkSession, folder: str) -> DataFrame:
    return judged(spark, folder).select("doc_id", F.col("section_no").cast("long").alias("section_no"), "status")


@query(
    f"""WITH {SECTIONS}, k AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, section_no ORDER BY idx) AS rn FROM sections)
SELECT doc_id, section_no, string_agg(trim(line), chr(10) ORDER BY idx) AS context FROM k WHERE rn <= 150 GROUP BY ALL"""
)
def section_context(spark: SparkSession, folder: str) -> DataFrame:
    return sections(spark, folder).select(
        "doc_id", F.col("section_no").cast("long").alias("section_no"), cut.context(F.col("paragraphs"), RULES).alias("context")
    )


@query(
    f"""WITH {ITEMS} SELECT doc_id, count(CASE WHEN status = 'OK' THEN 1 END) AS sections, CAST(sum(n) AS BIGINT) AS functions
FROM status GROUP BY doc_id"""
)
def run_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return metrics_of(judged(spark, folder), "doc_id")


@query(f"""WITH {LINES} SELECT doc_id, idx AS para_idx, {cleaned_sql("idx || '.1) ' || line || ' ;,'")} AS item FROM l""")
def clean_items(spark: SparkSession, folder: str) -> DataFrame:
    rows = cut.paragraph_rows(documents(spark, folder), "doc_id", "text")
    marked = F.concat(F.col("para_idx").cast("string"), F.lit(".1) "), F.col("text"), F.lit(" ;,"))
    return rows.select("doc_id", F.col("para_idx").cast("long").alias("para_idx"), text.clean_item(marked, CLEANING).alias("item"))


@query("SELECT conv_id, turn, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text FROM conversations")
def text_normalise(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversations").select("conv_id", "turn", text.normalise(F.col("text")).alias("text"))


@query(
    r"""WITH u AS (SELECT page_id, regexp_replace(url, '[<>:"/\\|?*]', '', 'g') AS u FROM pages)
SELECT page_id, CASE WHEN n = '' THEN 'unnamed' ELSE n END AS name FROM (
  SELECT page_id, trim(regexp_replace(regexp_replace(u, '[().,;\-\s/]+', '_', 'g'), '_+', '_', 'g'), '_') AS n FROM u)"""
)
def safe_name(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select("page_id", text.safe_name(F.col("url")).alias("name"))


# --- names of parts stand for names of bodies -------------------------------------------

NAMES = NameRules(
    parent_keywords=("ring", "bolt", "gear"),
    endings=(("1", ""), ("2", "e")),
    stop_words=("small", "of"),
    levels={"small": "1", "red": "1.1", "old": "2.1"},
    word="[A-Za-z]+",
)
NAMED = """named AS (SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN upper(p_name) WHEN 1 THEN '' WHEN 2 THEN 'small of'
  WHEN 3 THEN p_type || '-' || p_name ELSE p_name || ' of ' || p_brand END AS name FROM part)"""


def named_parts(spark: SparkSession, folder: str) -> DataFrame:
    turn = F.col("p_size") % 5
    name = (
        F.when(turn == 0, F.upper("p_name")).when(turn == 1, "").when(turn == 2, "small of")
        .when(turn == 3, F.concat("p_type", F.lit("-"), "p_name"))
        .otherwise(F.concat("p_name", F.lit(" of "), "p_brand"))
    )
    return table(spark, folder, "part").select("p_partkey", name.alias("name"))


@query(
    rf"""WITH {NAMED}, w AS (SELECT *, regexp_split_to_array(name, '[\s\-]+') AS words FROM named), i AS (
  SELECT *, list_filter(words, lambda x: x <> '' AND lower(x) NOT IN ('small', 'of')) AS telling,
    len(list_filter(words, lambda x: NOT (len(x) > 1 AND x = upper(x) AND x <> lower(x)))) = 0 AS shouted FROM w)
SELECT p_partkey, CASE WHEN name = '' THEN 'GO' WHEN shouted THEN words[1]
  WHEN len(telling) > 0 THEN array_to_string(list_transform(telling, lambda x: upper(x[1])), '')
  ELSE upper(words[1][1:3]) END AS abbreviation FROM i"""
)
def abbreviate(spark: SparkSession, folder: str) -> DataFrame:
    return named_parts(spark, folder).select("p_partkey", text.abbreviate(F.col("name"), NAMES).alias("abbreviation"))


@query(
    f"""WITH {NAMED} SELECT p_partkey, CASE lower(regexp_extract(name, '[A-Za-z]+'))
  WHEN 'small' THEN '1' WHEN 'red' THEN '1.1' WHEN 'old' THEN '2.1' ELSE '' END AS level FROM named"""
)
def level_of(spark: SparkSession, folder: str) -> DataFrame:
    return named_parts(spark, folder).select("p_partkey", text.level_of(F.col("name"), NAMES).alias("level"))


def position(word: str) -> str:
    return f"CASE WHEN regexp_matches(name, '(?i)\\b{word}\\b') THEN len(regexp_extract(name, '(?i)^(.*?)\\b{word}\\b', 1)) + 1 END"


@query(
    f"""WITH {NAMED}, p AS (SELECT *, coalesce({position('ring')}, {position('bolt')}, {position('gear')}) AS pos FROM named), c AS (
  SELECT *, trim(substr(name, 1, pos - 1)) AS head, trim(substr(name, pos)) AS tail FROM p), d AS (
  SELECT *, CASE WHEN tail LIKE '%1' THEN substr(tail, 1, len(tail) - 1) WHEN tail LIKE '%2' THEN substr(tail, 1, len(tail) - 1) || 'e'
    ELSE tail END AS turned FROM c)
SELECT p_partkey, CASE WHEN name = '' THEN NULL WHEN pos IS NULL THEN name WHEN head = '' THEN trim(turned) ELSE head END AS main,
  CASE WHEN pos IS NOT NULL AND head <> '' THEN trim(turned) END AS parent FROM d"""
)
def split_name(spark: SparkSession, folder: str) -> DataFrame:
    parts = named_parts(spark, folder).withColumn("_n", text.split_name(F.col("name"), NAMES))
    return parts.select("p_partkey", "_n.main", "_n.parent")


# --- taxonomy and codes -----------------------------------------------------------------

CODED = """coded AS (SELECT p_partkey, CASE WHEN p_size % 9 = 0 THEN 'NO_MATCH' WHEN p_size % 9 = 1 THEN '' ELSE
  lpad(CAST(p_partkey % 12 AS VARCHAR), 2, '0') || '.' || (p_size % 10) || CASE WHEN p_size % 2 = 0 THEN '.1' ELSE '' END
  || ' ' || p_name END AS label FROM part)"""
TITLES = "titles AS (SELECT * FROM (VALUES " + ", ".join(f"('{c}', '{t}')" for c, t in CODE_TITLES.items()) + ") AS t(code, title))"


@query(
    f"""WITH {CODED}, {TITLES}, c AS (
  SELECT *, CASE WHEN label IN ('', 'NO_MATCH') THEN '' ELSE split_part(label, ' ', 1) END AS code FROM coded), k AS (
  SELECT *, split_part(code, '.', 1) AS c3, CASE WHEN code = '' THEN '' ELSE split_part(code, '.', 1) || '.' || split_part(code, '.', 2) END AS c2 FROM c)
SELECT p_partkey, label,
  coalesce(c2 || ' ' || upper(a.title[1]) || lower(a.title[2:]), '') AS sphere_2,
  coalesce(c3 || ' ' || upper(b.title[1]) || lower(b.title[2:]), '') AS sphere_3
FROM k LEFT JOIN titles a ON a.code = c2 LEFT JOIN titles b ON b.code = c3"""
)
def code_rollup(spark: SparkSession, folder: str) -> DataFrame:
    size, key = F.col("p_size"), F.col("p_partkey")
    code = F.concat(
        F.lpad((key % 12).cast("string"), 2, "0"), F.lit("."), (size % 10).cast("string"),
        F.when(size % 2 == 0, ".1").otherwise(""), F.lit(" "), "p_name",
    )
    label = F.when(size % 9 == 0, "NO_MATCH").when(size % 9 == 1, "").otherwise(code)
    return roll_up(table(spark, folder, "part").select("p_partkey", label.alias("label")), "label", code_titles(spark))


def dimension(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "part").select(
        "p_partkey", F.col("p_name").alias("name"), F.nullif("p_type", F.lit("PROMO")).alias("description"), F.col("p_size").alias("activities")
    )
    return load_dimension(rows, ["name", "description", "activities"])


@query(
    """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name AS name, coalesce(nullif(p_type, 'PROMO'), '') AS description,
CAST(p_size AS VARCHAR) AS activities FROM part"""
)
def dimension_load(spark: SparkSession, folder: str) -> DataFrame:
    return dimension(spark, folder)


@query(
    """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, 'Сфера: ' || p_name || '. Описание: ' || coalesce(nullif(p_type, 'PROMO'), '') ||
'. Деятельность: ' || p_size AS corpus FROM part"""
)
def taxonomy_text(spark: SparkSession, folder: str) -> DataFrame:
    node = text.taxonomy_text(F.col("name"), F.col("description"), F.col("activities"))
    return dimension(spark, folder).select("p_partkey", node.alias("corpus"))


TAXONOMY = """taxonomy AS (
  SELECT min(p_partkey) AS ord, replace(p_brand, 'Brand#', '') || ' ' || p_brand || ' goods' AS name FROM part GROUP BY p_brand)"""
ASKED = """asked AS (SELECT p_partkey, trim(CASE p_size % 8 WHEN 0 THEN upper(replace(p_brand, 'Brand#', '') || ' ' || p_brand || ' goods')
  WHEN 1 THEN replace(p_brand, 'Brand#', '') || ' ' || p_name WHEN 2 THEN replace(p_brand, 'Brand#', '') WHEN 3 THEN ' ' || lower(p_brand)
  WHEN 4 THEN 'It is ' || replace(p_brand, 'Brand#', '') || ' ' || p_brand || ' goods.' WHEN 5 THEN 'NO_MATCH' WHEN 6 THEN ''
  ELSE p_name END) AS said FROM part)"""


@query(
    f"""WITH {TAXONOMY}, {ASKED}, loose AS (
  SELECT said, min_by(name, ord) AS loose FROM (SELECT DISTINCT said FROM asked WHERE said <> '') a JOIN taxonomy t
  ON contains(lower(name), lower(said)) OR contains(lower(said), lower(name)) GROUP BY said)
SELECT p_partkey, a.said AS answer, CASE WHEN a.said = 'NO_MATCH' THEN 'NO_MATCH'
  ELSE coalesce(x.name, y.name, z.name, loose, 'ОШИБКА') END AS sphere
FROM asked a LEFT JOIN taxonomy x ON lower(x.name) = lower(a.said)
LEFT JOIN taxonomy y ON contains(a.said, ' ') AND split_part(y.name, ' ', 1) = split_part(a.said, ' ', 1)
LEFT JOIN taxonomy z ON split_part(z.name, ' ', 1) = a.said LEFT JOIN loose l ON l.said = a.said"""
)
def resolve_label(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part")
    code = F.replace("p_brand", F.lit("Brand#"), F.lit(""))
    full = F.concat(code, F.lit(" "), "p_brand", F.lit(" goods"))
    taxonomy = parts.groupBy(full.alias("name")).agg(F.min("p_partkey").alias("ord"))
    turn = F.col("p_size") % 8
    said = (
        F.when(turn == 0, F.upper(full)).when(turn == 1, F.concat(code, F.lit(" "), "p_name")).when(turn == 2, code)
        .when(turn == 3, F.concat(F.lit(" "), F.lower("p_brand"))).when(turn == 4, F.concat(F.lit("It is "), full, F.lit(".")))
        .when(turn == 5, "NO_MATCH").when(turn == 6, "").otherwise(F.col("p_name"))
    )
    asked = parts.select("p_partkey", text.strip(said).alias("answer"))
    return resolve(asked, "answer", taxonomy).select("p_partkey", "answer", "sphere")


# --- answers and JSON -------------------------------------------------------------------

ANSWERED = """answered AS (SELECT event_id, CASE event_id % 6
  WHEN 0 THEN 'Well: ```json' || chr(10) || '{"verdict": "' || event_type || '", "why": ' || props || '}' || chr(10) || '``` done'
  WHEN 1 THEN 'before {"verdict": "' || upper(event_type) || '"} after' WHEN 2 THEN props WHEN 3 THEN 'no object in ' || event_type
  WHEN 4 THEN '{"verdict": ' || event_id || '}' ELSE '{"verdict": "' || event_type END AS answer FROM events), bodies AS (
  SELECT *, regexp_extract(answer, '(?s)\\{.*\\}') AS body FROM answered), said AS (
  SELECT event_id, CASE WHEN body <> '' AND json_valid(body) AND json_type(body, '$.verdict') = 'VARCHAR'
    THEN json_extract_string(body, '$.verdict') END AS verdict FROM bodies)"""


def event_answers(spark: SparkSession, folder: str) -> DataFrame:
    turn = F.col("event_id") % 6
    start = F.lit('{"verdict": "')
    answer = (
        F.when(turn == 0, F.concat(F.lit("Well: ```json\n"), start, "event_type", F.lit('", "why": '), "props", F.lit("}\n``` done")))
        .when(turn == 1, F.concat(F.lit("before "), start, F.upper("event_type"), F.lit('"} after')))
        .when(turn == 2, F.col("props")).when(turn == 3, F.concat(F.lit("no object in "), "event_type"))
        .when(turn == 4, F.concat(F.lit('{"verdict": '), "event_id", F.lit("}")))
        .otherwise(F.concat(start, "event_type"))
    )
    return table(spark, folder, "events").select("event_id", answer.alias("answer"))


@query(f"WITH {ANSWERED} SELECT event_id, verdict FROM said")
def json_verdict(spark: SparkSession, folder: str) -> DataFrame:
    return event_answers(spark, folder).select("event_id", answers.json_text(F.col("answer"), "verdict", fenced=True).alias("verdict"))


@query(
    """WITH docs AS (SELECT json_object('id', conv_id, 'turns', json_array(json_object('function', text || ' "said"',
  'inner', json_object('function', ' ' || role || ' ', 'n', json_object('function', turn))))) AS doc FROM conversations),
found AS (SELECT trim(json_extract_string(t.value, '$'), chr(32) || chr(10)) AS text
  FROM docs, json_tree(docs.doc) t WHERE t.key = 'function' AND t.type = 'VARCHAR')
SELECT DISTINCT text FROM found WHERE text <> ''"""
)
def json_harvest(spark: SparkSession, folder: str) -> DataFrame:
    inner = F.struct(
        F.concat(F.lit(" "), "role", F.lit(" ")).alias("function"), F.struct(F.col("turn").alias("function")).alias("n")
    )
    turn = F.struct(F.concat("text", F.lit(' "said"')).alias("function"), inner.alias("inner"))
    nested = F.to_json(F.struct(F.col("conv_id").alias("id"), F.array(turn).alias("turns")))
    return harvest(table(spark, folder, "conversations").select(nested.alias("doc")), "doc")


TYPE_OF = {"click": "  стратегические ", "view": "РЕГУЛЯТИВНЫЕ", "purchase": "Контрольные", "signup": "иное"}
TYPE_CASE = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TYPE_OF.items()) + " END"
LABEL_LIST = ", ".join(f"'{x}'" for x in TYPE_LABELS)


@query(
    f"""WITH s AS (SELECT event_id, trim({TYPE_CASE}) AS said FROM events), c AS (
  SELECT event_id, upper(said[1]) || lower(said[2:]) AS label FROM s)
SELECT event_id, CASE WHEN label IN ({LABEL_LIST}) THEN label ELSE 'НЕОПРЕДЕЛЕНО' END AS true_type FROM c"""
)
def type_verdict(spark: SparkSession, folder: str) -> DataFrame:
    said = F.create_map(*[F.lit(x) for pair in TYPE_OF.items() for x in pair])
    answer = F.concat(F.lit('{"verdict": "'), F.try_element_at(said, F.col("event_type")), F.lit('"}'))
    return table(spark, folder, "events").select("event_id", answers.type_verdict(answer).alias("true_type"))


@query(
    """SELECT event_id, CASE event_type WHEN 'click' THEN 'REAL' WHEN 'view' THEN 'FALSE' ELSE 'ERROR' END AS verdict FROM events"""
)
def pair_verdict(spark: SparkSession, folder: str) -> DataFrame:
    word = F.when(F.col("event_type") == "click", "real").when(F.col("event_type") == "view", "False").otherwise(F.col("event_type"))
    answer = F.concat(F.lit('Judged. {"verdict": "'), word, F.lit('"}'))
    return table(spark, folder, "events").select("event_id", answers.pair_verdict(answer).alias("verdict"))
