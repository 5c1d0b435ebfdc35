"""Queries on tables that grow: later rows are taken in without going over the earlier ones again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexroll.functions import answers
from lexroll.operators import hierarchy, sections as cut
from lexroll.operators.closure import group_pairs, grow_groups
from lexroll.operators.inference import embed, infer
from lexroll.operators.lineage import run_folder, written
from lexroll.operators.similar import near_duplicate_pairs, sound_blocks
from lexroll.operators.stage import write_measured
from lexroll.operators.store import Store
from lexroll.plans.catalog import query, table
from lexroll.plans.model_queries import DIGEST, TYPES, Answering, chosen
from lexroll.plans.registry_queries import NAMES, PATHS, bodies
from lexroll.plans.text_queries import CLEANING, ITEMS, RULES, judged
from lexroll.plans.vector_queries import PAIRS, THRESHOLD, pairs_of, vectors
from lexroll.plans.whole_stage_queries import Failing, digits, digits_of
from lexroll.profile import GROUP_PREFIX, TYPE_LABELS
from lexroll.streaming.arrivals import read_batches, take_batches, write_batch


def reached(name: str, source: str) -> str:
    """(id, root): the smallest id that links of ``source`` reach."""
    return f"""{name}_linked AS (SELECT id_a AS x, id_b AS y FROM {source} UNION ALL SELECT id_b, id_a FROM {source}), {name}_reach AS (
  SELECT x AS id, x AS other FROM {name}_linked UNION
  SELECT r.id, l.y FROM {name}_reach r JOIN {name}_linked l ON l.x = r.other), {name} AS (
  SELECT id, min(other) AS root FROM {name}_reach GROUP BY id)"""


@query(
    f"""WITH RECURSIVE {PAIRS}, first AS (
  SELECT * FROM pairs WHERE CAST(id_a AS BIGINT) % 2 = 0 AND CAST(id_b AS BIGINT) % 2 = 0), {reached("early", "first")}, {reached("late", "pairs")}, old AS (
  SELECT id, dense_rank() OVER (ORDER BY root) AS number FROM early), roots AS (
  SELECT root, min(number) AS number FROM late LEFT JOIN old USING (id) GROUP BY root), numbered AS (
  SELECT root, coalesce(number, (SELECT coalesce(max(number), 0) FROM old) + row_number() OVER (PARTITION BY number IS NULL ORDER BY root)) AS number
  FROM roots)
SELECT id, root, 'COLLISION_' || number AS group_id FROM late JOIN numbered USING (root)"""
)
def growing_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of every second vector, then the other vectors: these meet all rows, and only their links are closed."""
    rows = vectors(spark, folder).withColumn("fresh", F.col("vec_id") % 2 == 1)
    shape = dict(id_col="vec_id", vec_col="embedding", owner_col="owner", block_cols=["label"], threshold=THRESHOLD)
    early = group_pairs(near_duplicate_pairs(rows.where("NOT fresh"), **shape), prefix="")
    early = early.select("id", F.col("group_id").cast("long").alias("number"))
    grown = grow_groups(early, near_duplicate_pairs(rows, **shape, fresh_col="fresh"))
    roots = grown.groupBy("number").agg(F.min("id").alias("root"))
    return grown.join(roots, "number").select("id", "root", F.concat(F.lit(GROUP_PREFIX), F.col("number").cast("string")).alias("group_id"))


@query(
    f"""{PATHS}, i AS (SELECT main AS name, item, row_number() OVER (PARTITION BY main ORDER BY ord) AS item_no
  FROM bodies WHERE item IS NOT NULL), firsts AS (
  SELECT main AS name, count(*) AS n FROM bodies WHERE item IS NOT NULL AND ord <= (SELECT max(ord) // 2 FROM bodies) GROUP BY main)
SELECT p.id_prefix || '-' || item_no AS function_id, item AS function_text, executor, parent_executor, level, i.name AS node_name,
  CASE WHEN item_no > coalesce(f.n, 0) THEN 2 ELSE 1 END AS run
FROM i JOIN p ON p.name = i.name JOIN nodes n ON n.name = i.name LEFT JOIN firsts f ON f.name = i.name"""
)
def registry_rows_in_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of the first half of numbers, then the others: each body's numbers go on where they stood."""
    sections = bodies(spark, folder)
    items = sections.where("item IS NOT NULL").select(F.col("main").alias("name"), "ord", "item")
    half = F.lit(sections.agg(F.floor(F.max("ord") / 2)).first()[0])
    paths = hierarchy.hierarchy_paths(hierarchy.build_nodes(sections, NAMES), NAMES)
    first = hierarchy.registry_rows(paths, items.where(F.col("ord") <= half), ["ord"])
    second, _ = hierarchy.arriving_rows(paths, items.where(F.col("ord") > half), hierarchy.number_marks(first), ["ord"])
    runs = first.withColumn("run", F.lit(1)).unionByName(second.withColumn("run", F.lit(2)))
    return runs.drop("item_no")


KEPT = """p AS (SELECT event_id, 'Choose a type: ' || event_type || ' ' || props AS prompt FROM events), earlier AS (
  SELECT DISTINCT prompt FROM p WHERE event_id % 2 = 0)"""


@query(
    f"""WITH {KEPT}, a AS (SELECT event_id, {DIGEST} % 11 = 0 AS failed, {chosen(TYPES)} AS said, prompt IN (SELECT prompt FROM earlier) AS met FROM p)
SELECT event_id, CASE WHEN NOT failed THEN CASE WHEN said IN ({", ".join(f"'{x}'" for x in TYPE_LABELS)}) THEN said ELSE 'НЕОПРЕДЕЛЕНО' END END AS true_type,
  CASE WHEN failed THEN 'ERROR' ELSE 'OK' END AS status, CASE WHEN met AND NOT failed THEN 'first' ELSE 'second' END AS asked_in FROM a"""
)
def answers_of_two_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Every second event is typed, then all: prompts answered in the first run aren't asked again, failed ones are."""
    asked = table(spark, folder, "events").select(
        "event_id", F.concat(F.lit("Choose a type: "), "event_type", F.lit(" "), "props").alias("prompt")
    )
    path, model = f"{run_folder(spark)}/{uuid.uuid4().hex}", Failing(Answering("verdict", TYPES), 11)
    infer(asked.where("event_id % 2 = 0"), "prompt", model, store=Store(path, "first"))
    answered = infer(asked, "prompt", model, store=Store(path, "second"))
    fine = F.when(F.col("status") == "OK", answers.type_verdict(F.col("raw")))
    return answered.select("event_id", fine.alias("true_type"), "status", "asked_in")


@query(
    f"""WITH texts AS (SELECT doc_id, CASE WHEN trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> '' THEN text ELSE ' ' END AS text FROM documents)
SELECT doc_id, {digits('text')} AS embedding,
  CASE WHEN text IN (SELECT text FROM texts WHERE doc_id % 3 = 0) THEN 'first' ELSE 'second' END AS asked_in FROM texts"""
)
def vectors_of_two_runs(spark: SparkSession, folder: str) -> DataFrame:
    """A third of the documents is encoded, then all: texts that have a vector keep it."""
    docs, path = table(spark, folder, "documents").select("doc_id", "text"), f"{run_folder(spark)}/{uuid.uuid4().hex}"
    embed(docs.where("doc_id % 3 = 0"), "text", digits_of, store=Store(path, "first"))
    found = embed(docs, "text", digits_of, store=Store(path, "second"))
    return found.select("doc_id", F.col("embedding").cast("array<double>").alias("embedding"), "asked_in")


def broken(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors with a short one in block 3 and one that is no number in block 5."""
    short = F.slice("embedding", 1, 10)
    odd = F.transform("embedding", lambda x: F.lit(float("nan")).cast("float"))
    rows = vectors(spark, folder)
    first = {r["label"]: r["v"] for r in rows.where("label IN (3, 5)").groupBy("label").agg(F.min("vec_id").alias("v")).collect()}
    hit = lambda label: F.col("vec_id") == F.lit(first.get(label, -1))
    return rows.withColumn("embedding", F.when(hit(3), short).when(hit(5), odd).otherwise(F.col("embedding")))


@query("""SELECT label, count(*) AS n_items,
  CASE label WHEN 3 THEN 'vectors of mixed length' ELSE 'numbers that are not finite' END AS reason
FROM embeddings WHERE label IN (3, 5) GROUP BY label""")
def failed_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks that cannot be compared are reported; nothing stops."""
    return sound_blocks(broken(spark, folder), "embedding", ["label"])[1]


@query(f"WITH {PAIRS} SELECT id_a, id_b, round(sim, 6) AS sim FROM pairs WHERE label NOT IN (3, 5)")
def pairs_beside_failed_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """The other blocks' pairs are as ever."""
    sound, _ = sound_blocks(broken(spark, folder), "embedding", ["label"])
    return pairs_of(sound).withColumn("sim", F.round("sim", 6))


@query(
    f"""WITH {ITEMS} SELECT count(DISTINCT doc_id) AS documents, count(CASE WHEN status = 'OK' THEN 1 END) AS sections,
  CAST(sum(n) AS BIGINT) AS functions FROM status"""
)
def run_totals_observed(spark: SparkSession, folder: str) -> DataFrame:
    """Totals of a run, gathered while its sections are written."""
    found, path = judged(spark, folder), f"{run_folder(spark)}/{uuid.uuid4().hex}"
    fine = F.col("status") == "OK"
    totals = write_measured(
        found, path, sections=F.count_if(fine), functions=F.sum(F.when(fine, F.size("items")).otherwise(0)),
        firsts=F.count_if(F.col("section_no") == 1),
    )
    return spark.createDataFrame(
        [(totals["firsts"], totals["sections"], totals["functions"] or 0)], "documents long, sections long, functions long"
    )


@query(f"{PATHS} SELECT name, id_prefix, executor, parent_executor FROM p")
def hierarchy_paths_changed(spark: SparkSession, folder: str) -> DataFrame:
    """A tenth of the nations and customers had other parents before; only they and what lies below is climbed again."""
    nodes = hierarchy.build_nodes(bodies(spark, folder), NAMES)
    moved = F.pmod(F.xxhash64("name"), F.lit(10)) == 0
    other = F.when(F.col("parent_name").isNull(), F.lit("NATION_3")).when(F.col("parent_name").startswith("NATION"), F.lit("ASIA"))
    before = nodes.withColumn("parent_name", F.when(moved & ~F.col("name").isin("NATION_3", "ASIA"), other).otherwise(F.col("parent_name")))
    known = written(hierarchy.hierarchy_paths(before, NAMES))
    now = hierarchy.update_paths(known, nodes.where(moved), NAMES)
    return now.select("name", "id_prefix", "executor", "parent_executor")


OFFICES = ["North Office", "South Office", ""]


@query(
    f"""WITH {ITEMS}, k AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, section_no ORDER BY idx) AS rn FROM sections), heads AS (
  SELECT doc_id, section_no, string_agg(trim(line), chr(10) ORDER BY idx) AS prompt FROM k WHERE rn <= 150 GROUP BY ALL)
SELECT doc_id, section_no, status.status, {chosen(OFFICES)} AS name FROM heads JOIN status USING (doc_id, section_no)"""
)
def sections_of_arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that arrive three times, each time a micro-batch; their sections are cut and named, and one batch is repeated."""
    docs, base = table(spark, folder, "documents").select("doc_id", "text"), f"{run_folder(spark)}/{uuid.uuid4().hex}"

    def work(rows: DataFrame) -> DataFrame:
        lines = rows.select("doc_id", cut.paragraphs_of(F.col("text")).alias("paragraphs"))
        found = cut.with_items(cut.with_sections(lines, "paragraphs", RULES), RULES, CLEANING).withColumnRenamed("status", "item_status")
        asked = found.select("doc_id", "section_no", "item_status", cut.context(F.col("paragraphs"), RULES).alias("prompt"))
        named = infer(asked, "prompt", Answering("full_go_name", OFFICES))
        name = answers.json_text(F.col("raw"), "full_go_name", fenced=True)
        return named.select("doc_id", F.col("section_no").cast("long").alias("section_no"), F.col("item_status").alias("status"), name.alias("name"))

    for part in range(3):  # as many files as Spark writes; a run takes all that have arrived since the last one
        docs.where(F.pmod("doc_id", F.lit(3)) == part).write.mode("append").parquet(f"{base}/in")
        take_batches(spark, f"{base}/in", f"{base}/out", f"{base}/state", work).awaitTermination()
    write_batch(work(docs.where(F.pmod("doc_id", F.lit(3)) == 1)), f"{base}/out", batch_of(spark, f"{base}/out", 1))
    return read_batches(spark, f"{base}/out", "doc_id long, section_no long, status string, name string")


def batch_of(spark: SparkSession, out: str, part: int) -> int:
    """The number of the batch that took a part's documents."""
    rows = spark.read.schema("doc_id long, batch long").parquet(out)
    found = rows.where(F.pmod("doc_id", F.lit(3)) == part).agg(F.min("batch")).first()[0]
    return 99 if found is None else found
