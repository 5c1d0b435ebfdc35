"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lexroll.llm import alignment, bpe, decontaminate, divergence, licences, main_text, packing, quality_classifier, quality_rules, simhash, token_counts, transcripts, url_filter
from lexroll.llm.common import per_text

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# Each repeated 5-word window covers its words; words hold no blanks, so a window is its words joined by one.
@query(
    r"""
    WITH given AS (
        SELECT doc_id, source, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
        FROM documents
    ), all_rows AS (SELECT row_number() OVER () AS r, * FROM given),
    places AS (
        SELECT r, i, array_to_string(words[i:i + 4], ' ') AS win
        FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM all_rows WHERE len(words) > 5)
    ),
    windows AS (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM places),
    covered AS (
        SELECT r, count(DISTINCT i + k) AS n_repeat FROM windows, (SELECT unnest(range(5)) AS k) WHERE n > 1 GROUP BY r
    ), counted AS (
        SELECT counted_rows.r, doc_id, source, len(words)::BIGINT AS n_words,
               coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
               length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
               (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
               coalesce(n_repeat, 0)::BIGINT AS n_repeat_words
        FROM (SELECT *, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM all_rows) counted_rows
        LEFT JOIN covered ON covered.r = counted_rows.r
    ), judged AS (
        SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted
    ), hosts AS (
        SELECT source, count(*) AS n, sum(base_failed::INT)::DOUBLE AS bad FROM judged WHERE source IS NOT NULL GROUP BY source
    ), total AS (
        SELECT sum(bad) / sum(n) AS p, count(*) / sum(n) AS share, sum(bad * bad / n) / sum(n) AS sq FROM hosts
    ), prior AS (
        SELECT p, CASE WHEN p * (1 - p) > 0 AND share < 1 THEN least(1.0, greatest(1e-6,
            (sq - p * p - p * (1 - p) * share) / (p * (1 - p) * (1 - share)))) ELSE 1e-6 END AS rho FROM total
    ), verdicts AS (
        SELECT source, (bad + p * (1 / rho - 1)) / (n + (1 / rho - 1)) <= 0.5 AS host_kept FROM hosts, prior
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND coalesce(host_kept, true) AS kept
    FROM judged LEFT JOIN verdicts USING (source)
    """
)
def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, folder, "documents")).drop("host_rate")


@query()
def op2_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality_classifier.score_quality(docs, quality_classifier.learn_quality(docs, table(spark, folder, "labels")))


# Windows of ten words, or a whole shorter item, against all runs of as many words.
@query(
    r"""
    WITH d AS (
        SELECT row_number() OVER () AS r, doc_id,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM documents
    ), b AS (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM benchmark
    ), item_windows AS (
        SELECT DISTINCT item_id, least(10, len(words)) AS size, words[i:i + least(10, len(words)) - 1] AS win
        FROM (SELECT *, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i FROM b WHERE len(words) > 0)
    ), sizes AS (SELECT DISTINCT size FROM item_windows),
    doc_windows AS (
        SELECT r, i, size, words[i:i + size - 1] AS win
        FROM (SELECT r, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM d, sizes WHERE len(words) >= size)
    ), found AS (SELECT r, i, size, item_id FROM doc_windows JOIN item_windows USING (size, win)),
    hit AS (SELECT r, count(DISTINCT i + k) AS n_hit FROM (SELECT DISTINCT r, i, unnest(range(size)) AS k FROM found) GROUP BY r),
    items AS (SELECT r, count(DISTINCT item_id) AS n_items, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM found GROUP BY r)
    SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
    """
)
def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, benchmark = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return decontaminate.contamination(docs, benchmark).drop("items", "spans")


@query()
def op8_bpe(spark: SparkSession, folder: str) -> DataFrame:
    automaton = bpe.load(spark, public_tokenizers.path("byte_bpe_50k.json"))
    return bpe.token_digests(table(spark, folder, "documents"), automaton)


@query()
def op10_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


@query()
def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    model = token_counts.load(spark, public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts.token_counts(table(spark, folder, "documents"), model)


# Named rules by their length, then the globs as patterns over host and path.
@query(
    r"""
    WITH parts AS (
        SELECT page_id,
               translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
        FROM pages
    ), rules AS (
        SELECT * FROM (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                              ('com', '/fr/', 'allow'), ('com', '/de/', 'block')) AS t(rule_host, rule_path, said)
    ), fits AS (
        SELECT host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
               arg_max(said, length(rule_host || rule_path)) AS said
        FROM (SELECT DISTINCT host, path FROM parts) JOIN rules
          ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        GROUP BY host, path
    )
    SELECT page_id, host, path, rule,
           CASE WHEN said IS NOT NULL THEN said
                WHEN regexp_full_match(host || path,
                     '(?s).*casino.*|.*cheap-pills.*|.*spam.*|([^/]*\.)?ads-track\.[^/]*/.*|.*free-bets.*|([^/]*\.)?adult-[^/]*/.*|.*/wp-login\.php.*|.*/ads/.*')
                THEN 'block' ELSE 'allow' END AS verdict
    FROM parts LEFT JOIN fits USING (host, path)
    """
)
def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, folder, "pages"))


@query()
def op7_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_text.main_texts(table(spark, folder, "pages"))


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(str(x) if isinstance(x, int) else "'" + x + "'" for x in row) + ")" for row in rows)


LICENCE_SQL = r"""
    WITH files AS (
        SELECT concat_ws('/', source, lang, CAST(doc_id // 1000 AS VARCHAR), doc_id || '.txt') AS path,
               concat_ws('/', source, lang, CAST(doc_id // 1000 AS VARCHAR)) AS dir, text,
               list_filter(string_split(text, chr(10)), lambda l: regexp_matches(lower(l), CUES)) AS lines
        FROM documents
    ), heads AS (
        SELECT path, dir, CASE WHEN len(lines) > 0 THEN array_to_string(lines, chr(10)) END AS header, text FROM files
    ), sized AS (
        SELECT *, header IS NOT NULL AND len(regexp_extract_all(header, '[^ \t-\r]+')) / len(regexp_extract_all(text, '[^ \t-\r]+')) >= 0.3
                  AS is_file FROM heads
    ), headers AS (SELECT header, count(*) AS n FROM heads WHERE header IS NOT NULL GROUP BY header),
    terms AS (
        SELECT header, n, term, count(*) AS tf
        FROM (SELECT header, n, unnest(regexp_extract_all(lower(header), '[a-z0-9]+(?:[.-][a-z0-9]+)*')) AS term FROM headers)
        GROUP BY header, n, term
    ), templates AS (SELECT * FROM (VALUES TEMPLATES) AS t(number, licence, wording)),
    own AS (
        SELECT number, licence, term, count(*) AS tf
        FROM (SELECT number, licence, unnest(regexp_extract_all(lower(wording), '[a-z0-9]+(?:[.-][a-z0-9]+)*')) AS term FROM templates)
        GROUP BY number, licence, term
    ), total AS (SELECT (SELECT coalesce(sum(n), 0) FROM headers) + (SELECT count(*) FROM templates) AS files),
    idf AS (
        SELECT term, ln((1.0::DOUBLE + any_value(files)) / (1.0::DOUBLE + sum(n))) + 1 AS idf
        FROM (SELECT term, n FROM terms UNION ALL SELECT term, 1 FROM own), total GROUP BY term
    ), norms AS (SELECT header, sqrt(sum(tf * idf * tf * idf)) AS norm FROM terms JOIN idf USING (term) GROUP BY header),
    own_norms AS (SELECT number, sqrt(sum(tf * idf * tf * idf)) AS norm FROM own JOIN idf USING (term) GROUP BY number),
    dots AS (
        SELECT header, number, licence, sum(terms.tf * idf * own.tf * idf) AS dot
        FROM terms JOIN own USING (term) JOIN idf USING (term) GROUP BY header, number, licence
    ), scored AS (
        SELECT header, licence, round(dot / (norms.norm * own_norms.norm), 6) AS score
        FROM dots JOIN norms USING (header) JOIN own_norms USING (number)
    ), best AS (
        SELECT header, licence, score
        FROM (SELECT *, row_number() OVER (PARTITION BY header ORDER BY score DESC, licence) AS rank FROM scored)
        WHERE rank = 1 AND score >= 0.5
    ), found AS (SELECT path, dir, is_file, licence, score FROM sized LEFT JOIN best USING (header)),
    said AS (
        SELECT dir AS above, licence AS inherited
        FROM (SELECT dir, licence, row_number() OVER (PARTITION BY dir ORDER BY count(*) DESC, licence) AS rank
              FROM found WHERE is_file AND licence IS NOT NULL GROUP BY dir, licence)
        WHERE rank = 1
    ), nearest AS (
        SELECT dir, arg_max(inherited, length(above)) AS inherited
        FROM (SELECT DISTINCT dir FROM found) JOIN said ON dir = above OR starts_with(dir, above || '/') OR above = '' GROUP BY dir
    )
    SELECT path, coalesce(licence, inherited) AS licence, score,
           CASE WHEN licence IS NOT NULL THEN 'header' WHEN inherited IS NOT NULL THEN 'inherited' END AS how
    FROM found LEFT JOIN nearest USING (dir)
    """.replace("CUES", "'" + "|".join(licences.CUES) + "'").replace(
    "TEMPLATES", _values((i, n, t) for i, (n, t) in enumerate(licences.TEMPLATES))
)


@query(LICENCE_SQL)
def op9_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files of a tree by source, language and thousand."""
    docs = table(spark, folder, "documents")
    folders = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 1000).cast("string"))
    path = F.concat_ws("/", folders, F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return licences.scan_licences(docs.select(path.alias("path"), "text"))


@query()
def op3_transcripts(spark: SparkSession, folder: str) -> DataFrame:
    """Chat logs made of the conversations: the model is counted over all of them, then parses each."""
    logs = transcripts.logs_of(table(spark, folder, "conversations"))
    model = transcripts.learn_model(logs)
    logs = transcripts.carried(logs, model)
    count = lambda p: transcripts.right_lines(p["turns"], model, p["enter"], p["leave"])
    right = per_text(count, "struct<n_lines: bigint, n_right: bigint>")(F.struct("turns", "enter", "leave"))
    found = transcripts.parse(F.col("text"), model, F.col("enter"), F.col("leave"))
    parsed = logs.select("conv_id", "piece", "part", found.alias("found"), right.alias("r"))
    roles = F.array_join(F.transform("found", lambda t: t["role"]), ",")
    return parsed.select(
        "conv_id", "piece", "part", "r.*", F.size("found").cast("long").alias("n_turns"), roles.alias("roles"),
        transcripts.rendered(F.col("found")).alias("rendered"),
    )


# Counts, shares and differences as they are defined; every pair of groups over every kept term.
@query(
    r"""
    WITH given AS (
        SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
        FROM documents
    ), found AS (
        SELECT r, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
        FROM given
    ), kept AS (
        SELECT lang, term, count(*) AS all_n FROM found GROUP BY lang, term HAVING count(DISTINCT r) >= 10
    ), counts AS (SELECT lang, source, term, count(*) AS n FROM found JOIN kept USING (lang, term) GROUP BY lang, source, term),
    langs AS (SELECT lang, count(*) AS v, sum(all_n) AS lang_n FROM kept GROUP BY lang),
    sizes AS (SELECT lang, source, sum(n) AS group_n FROM counts GROUP BY lang, source),
    groups AS (SELECT DISTINCT lang, source FROM given),
    shares AS (
        SELECT lang, source, term, coalesce(n, 0) AS n,
               1 + (1000000000 * (coalesce(n, 0) + 2)::HUGEINT) // (coalesce(group_n, 0) + 2 * v)::HUGEINT AS p,
               1 + (1000000000 * (all_n + 2)::HUGEINT) // (lang_n + 2 * v)::HUGEINT AS q
        FROM groups JOIN kept USING (lang) JOIN langs USING (lang) LEFT JOIN counts USING (lang, source, term)
             LEFT JOIN sizes USING (lang, source)
    ), sums AS (
        SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
        FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
    ), items AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
             LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source
        UNION ALL
        SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM shares WHERE n > 0 AND p > q
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM items
    )
    SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
    """
)
def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.divergence(table(spark, folder, "documents"))


@query()
def op11_packing(spark: SparkSession, folder: str) -> DataFrame:
    encoder = packing.load(spark, public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(table(spark, folder, "documents"), encoder)


@query()
def op12_alignment(spark: SparkSession, folder: str) -> DataFrame:
    files = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    docs = table(spark, folder, "documents")
    return alignment.alignment(docs, alignment.load(spark, *files)).withColumn("doc_id", F.col("doc_id").cast("long"))
