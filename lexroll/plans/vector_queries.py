"""Queries on the embeddings table.

Block is ``label``, owner is ``vec_id % 7``.  Where a library is needed, the vectors of one
label are the library and all other vectors the registry, so every row has a part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexroll.functions.vectors import cosine as cosine_of
from lexroll.operators.closure import group_pairs, write_back
from lexroll.operators.inference import HashedWords, embed
from lexroll.operators.labels import candidate_prompts, hint_sets, pair_prompts as prompts_of_pairs, type_prompts as prompts_of_types
from lexroll.operators.lineage import broadcast_if_small
from lexroll.operators.pair_tiles import ID_ROWS
from lexroll.operators.similar import (
    Sizes,
    block_stats as stats_of_blocks,
    drop_boilerplate,
    max_similarity as largest_similarity,
    near_duplicate_links,
    near_duplicate_pairs,
    nearest,
)
from lexroll.plans.catalog import query, table

THRESHOLD = 0.3
LOW_THRESHOLD = 0.42
LIBRARY, EXAMPLES = 0, 1  # labels whose vectors serve as library and as labelled examples


def vectors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").withColumn("owner", F.col("vec_id") % 7)


def split(spark: SparkSession, folder: str, label: int) -> tuple[DataFrame, DataFrame]:
    every = vectors(spark, folder)
    return every.where(F.col("label") != label), every.where(F.col("label") == label)


# Limits so low that the bundled tables take the ways meant for large blocks and libraries.
TIGHT = Sizes(tile=40, max_pivots=16, broadcast_cells=64, sample=32)


def pairs_of(df: DataFrame, counted: DataFrame | None = None, sizes: Sizes = Sizes()) -> DataFrame:
    return near_duplicate_pairs(df, "vec_id", "embedding", "owner", ["label"], THRESHOLD, sizes=sizes, counted=counted)


VECTORS = """v AS (
  SELECT vec_id, CAST(vec_id AS VARCHAR) AS id, vec_id % 7 AS owner, label, CAST(embedding AS DOUBLE[]) AS e
  FROM embeddings)"""
PAIRS = f"""{VECTORS}, pairs AS (
  SELECT a.id AS id_a, b.id AS id_b, a.label, round(list_cosine_similarity(a.e, b.e), 9) AS sim
  FROM v a JOIN v b ON a.label = b.label AND a.id < b.id AND a.owner <> b.owner
  WHERE round(list_cosine_similarity(a.e, b.e), 9) >= {THRESHOLD})"""
BEST = f"""{VECTORS}, best AS (
  SELECT a.vec_id, max(round(list_cosine_similarity(a.e, l.e), 9)) AS max_sim
  FROM v a, v l WHERE a.label <> {LIBRARY} AND l.label = {LIBRARY} GROUP BY a.vec_id)"""


def ranked(label: int) -> str:
    return f"""{VECTORS}, hits AS (
  SELECT a.vec_id, l.vec_id AS ref_id, round(list_cosine_similarity(a.e, l.e), 9) AS sim
  FROM v a, v l WHERE a.label <> {label} AND l.label = {label}), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, ref_id) AS rank FROM hits)"""


GROUPS = f"""WITH RECURSIVE {PAIRS}, linked AS (
  SELECT id_a AS x, id_b AS y FROM pairs UNION ALL SELECT id_b, id_a FROM pairs), reach AS (
  SELECT x AS id, x AS other FROM linked UNION
  SELECT r.id, b.y FROM reach r JOIN linked b ON b.x = r.other), roots AS (
  SELECT id, min(other) AS root FROM reach GROUP BY id), grouped AS (
  SELECT id, 'COLLISION_' || dense_rank() OVER (ORDER BY root) AS group_id FROM roots)"""


@query(
    f"""WITH {VECTORS}, lib AS (SELECT * FROM v WHERE label = {LIBRARY}), kept AS (
  SELECT * FROM v a WHERE label <> {LIBRARY} AND NOT EXISTS (
    SELECT 1 FROM lib l WHERE round(list_cosine_similarity(a.e, l.e), 9) >= {THRESHOLD}))
SELECT a.id AS id_a, b.id AS id_b, round(list_cosine_similarity(a.e, b.e), 6) AS sim
FROM kept a JOIN kept b ON a.label = b.label AND a.id < b.id AND a.owner <> b.owner
WHERE round(list_cosine_similarity(a.e, b.e), 9) >= {THRESHOLD}"""
)
def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicates of different owners in a block, boilerplate left out first."""
    registry, library = split(spark, folder, LIBRARY)
    kept = drop_boilerplate(registry, library, "vec_id", "embedding", "vec_id", "embedding", THRESHOLD)
    return pairs_of(kept, counted=registry).withColumn("sim", F.round("sim", 6))


@query(f"WITH {PAIRS} SELECT id_a, id_b, round(sim, 6) AS sim FROM pairs")
def collision_candidates(spark: SparkSession, folder: str) -> DataFrame:
    return pairs_of(vectors(spark, folder)).withColumn("sim", F.round("sim", 6))


@query(f"WITH {PAIRS} SELECT id_a, id_b, round(sim, 6) AS sim FROM pairs")
def collision_candidates_cells(spark: SparkSession, folder: str) -> DataFrame:
    """The same by pivot cells and salted tiles, as for blocks too large for one task."""
    return pairs_of(vectors(spark, folder), sizes=TIGHT).withColumn("sim", F.round("sim", 6))


@query(f"""WITH {VECTORS}
SELECT a.id AS id_a, b.id AS id_b, round(list_cosine_similarity(a.e, b.e), 6) AS sim
FROM v a JOIN v b ON a.id < b.id AND a.owner <> b.owner WHERE round(list_cosine_similarity(a.e, b.e), 9) >= {LOW_THRESHOLD}""")
def one_block_candidates(spark: SparkSession, folder: str) -> DataFrame:
    """A threshold below the default, where angles prune little, and no block column that exists: all rows are one large
    block, in which heads of the vectors settle most pairs."""
    rows = vectors(spark, folder)
    sizes = Sizes(tile=rows.count() // 3, max_pivots=4)
    pairs = near_duplicate_pairs(rows, "vec_id", "embedding", "owner", ["sphere_3"], LOW_THRESHOLD, sizes=sizes)
    return pairs.withColumn("sim", F.round("sim", 6))


@query(f"WITH {BEST} SELECT vec_id FROM best WHERE max_sim < {THRESHOLD}")
def universal_filter(spark: SparkSession, folder: str) -> DataFrame:
    registry, library = split(spark, folder, LIBRARY)
    return drop_boilerplate(registry, library, "vec_id", "embedding", "vec_id", "embedding", THRESHOLD).select("vec_id")


@query(f"WITH {BEST} SELECT vec_id FROM best WHERE max_sim < {THRESHOLD}")
def universal_filter_cells(spark: SparkSession, folder: str) -> DataFrame:
    """The same by pivot cells, as for a library too large to send to every task."""
    registry, library = split(spark, folder, LIBRARY)
    return drop_boilerplate(registry, library, "vec_id", "embedding", "vec_id", "embedding", THRESHOLD, TIGHT).select("vec_id")


@query(f"WITH {BEST} SELECT vec_id, round(max_sim, 6) AS max_sim FROM best")
def max_similarity_cells(spark: SparkSession, folder: str) -> DataFrame:
    registry, library = split(spark, folder, LIBRARY)
    scored = largest_similarity(registry, library, "vec_id", "embedding", "vec_id", "embedding", TIGHT)
    return scored.select("vec_id", F.round("max_sim", 6).alias("max_sim"))


@query(f"WITH {BEST} SELECT vec_id, round(max_sim, 6) AS max_sim FROM best")
def max_similarity(spark: SparkSession, folder: str) -> DataFrame:
    registry, library = split(spark, folder, LIBRARY)
    scored = largest_similarity(registry, library, "vec_id", "embedding", "vec_id", "embedding")
    return scored.select("vec_id", F.round("max_sim", 6).alias("max_sim"))


@query(
    f"""WITH {VECTORS}
SELECT a.vec_id, round(list_cosine_similarity(a.e, b.e), 6) AS sim FROM v a JOIN v b ON b.vec_id = a.vec_id + 1"""
)
def cosine(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector against the one that follows it."""
    here = table(spark, folder, "embeddings")
    following = here.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    joined = here.join(following, "vec_id")
    return joined.select("vec_id", F.round(cosine_of(F.col("embedding"), F.col("other")), 6).alias("sim"))


@query(
    f"""WITH {PAIRS}, n AS (SELECT label, count(*) AS n_items FROM v GROUP BY label),
p AS (SELECT label, count(*) AS n_pairs FROM pairs GROUP BY label)
SELECT n.label, n_items, coalesce(n_pairs, 0) AS n_pairs FROM n LEFT JOIN p ON p.label = n.label"""
)
def block_stats(spark: SparkSession, folder: str) -> DataFrame:
    every = vectors(spark, folder)
    return stats_of_blocks(every, ["label"], pairs_of(every), "vec_id")


@query(f"WITH {ranked(LIBRARY)} SELECT vec_id, ref_id, round(sim, 6) AS sim, rank FROM ranked WHERE rank <= 10")
def top_k_nodes(spark: SparkSession, folder: str) -> DataFrame:
    registry, nodes = split(spark, folder, LIBRARY)
    hits = nearest(registry, nodes, 10, "vec_id", "embedding", "vec_id", "embedding")
    return hits.withColumn("sim", F.round("sim", 6)).withColumn("rank", F.col("rank").cast("long"))


@query(f"WITH {ranked(LIBRARY)} SELECT vec_id, ref_id, round(sim, 6) AS sim, rank FROM ranked WHERE rank <= 10")
def top_k_nodes_cells(spark: SparkSession, folder: str) -> DataFrame:
    """The same by pivot cells, as for a library too large to send to every task."""
    registry, nodes = split(spark, folder, LIBRARY)
    hits = nearest(registry, nodes, 10, "vec_id", "embedding", "vec_id", "embedding", sizes=TIGHT)
    return hits.withColumn("sim", F.round("sim", 6)).withColumn("rank", F.col("rank").cast("long"))


def hints(spark: SparkSession, folder: str, sizes: Sizes = Sizes()) -> tuple[DataFrame, DataFrame]:
    registry, examples = split(spark, folder, EXAMPLES)
    hits = nearest(registry, examples, 3, "vec_id", "embedding", "vec_id", "embedding", THRESHOLD, sizes)
    labelled = hits.withColumn("ref_label", F.concat(F.lit("type "), (F.col("ref_id") % 5).cast("string")))
    return registry, labelled


HINTS = f"""WITH {ranked(EXAMPLES)}, hints AS (
  SELECT vec_id, string_agg(DISTINCT 'type ' || (ref_id % 5), ', ' ORDER BY 'type ' || (ref_id % 5)) AS hints
  FROM ranked WHERE rank <= 3 AND sim >= {THRESHOLD} GROUP BY vec_id)"""


@query(
    f"""{HINTS} SELECT vec_id, rank, ref_id, 'type ' || (ref_id % 5) AS ref_label FROM ranked
WHERE rank <= 3 AND sim >= {THRESHOLD}"""
)
def nearest_labels(spark: SparkSession, folder: str) -> DataFrame:
    _, labelled = hints(spark, folder)
    return labelled.select("vec_id", F.col("rank").cast("long").alias("rank"), "ref_id", "ref_label")


@query(
    f"""{HINTS} SELECT vec_id, rank, ref_id, 'type ' || (ref_id % 5) AS ref_label FROM ranked
WHERE rank <= 3 AND sim >= {THRESHOLD}"""
)
def nearest_labels_cells(spark: SparkSession, folder: str) -> DataFrame:
    _, labelled = hints(spark, folder, TIGHT)
    return labelled.select("vec_id", F.col("rank").cast("long").alias("rank"), "ref_id", "ref_label")


@query(
    f"""{HINTS} SELECT v.vec_id, 'Choose a type.' || CASE WHEN hints IS NULL THEN '' ELSE chr(10) || chr(10) ||
'SIMILARITY ANALYSIS: Based on semantic proximity to verified examples, the most likely types are: ' || hints ||
'. Please consider this information when making your verdict.' END || ' Answer in JSON.' AS prompt
FROM v LEFT JOIN hints h ON h.vec_id = v.vec_id WHERE label <> {EXAMPLES}"""
)
def type_prompts(spark: SparkSession, folder: str) -> DataFrame:
    registry, labelled = hints(spark, folder)
    said = hint_sets(labelled, "vec_id", "ref_label")
    return prompts_of_types(registry.select("vec_id"), said, "vec_id", "Choose a type.{embedding_suggestions} Answer in JSON.")


@query(
    f"""WITH {ranked(LIBRARY)}
SELECT vec_id, 'Pick a node.' || chr(10) || chr(10) || 'СПИСОК ДОСТУПНЫХ СФЕР:' || chr(10) || '---' || chr(10) ||
string_agg('Название сферы: node ' || ref_id || chr(10) || 'Описание: of owner ' || (ref_id % 7) || chr(10) ||
'Виды деятельности: ', chr(10) || '---' || chr(10) ORDER BY rank) || chr(10) || '---' AS prompt
FROM ranked WHERE rank <= 10 GROUP BY vec_id"""
)
def candidate_prompt(spark: SparkSession, folder: str) -> DataFrame:
    registry, nodes = split(spark, folder, LIBRARY)
    hits = nearest(registry, nodes, 10, "vec_id", "embedding", "vec_id", "embedding")
    taxonomy = nodes.select(
        F.col("vec_id").alias("ref_id"),
        F.concat(F.lit("node "), F.col("vec_id")).alias("name"),
        F.concat(F.lit("of owner "), F.col("owner")).alias("description"),
        F.lit(None).cast("string").alias("activities"),
    )
    return candidate_prompts(hits, taxonomy, "vec_id", "Pick a node.")


@query(
    f"""WITH {PAIRS}, f AS (SELECT v.id, v.owner, v.label, d.text FROM v LEFT JOIN documents d ON d.doc_id = v.vec_id)
SELECT id_a, id_b, 'Judge.' || chr(10) || chr(10) ||
'FUNCTION 1:' || chr(10) || 'ID: ' || a.id || chr(10) || 'Executor: ' || a.owner || chr(10) || 'Type: ' || a.label || chr(10)
|| 'Sphere: N/A' || chr(10) || 'Text: ' || coalesce(a.text, '') || chr(10) || chr(10) ||
'FUNCTION 2:' || chr(10) || 'ID: ' || b.id || chr(10) || 'Executor: ' || b.owner || chr(10) || 'Type: ' || b.label || chr(10)
|| 'Sphere: N/A' || chr(10) || 'Text: ' || coalesce(b.text, '') || chr(10) || chr(10) ||
'Analyze if these functions represent a REAL collision or FALSE alarm.' AS prompt
FROM pairs JOIN f a ON a.id = id_a JOIN f b ON b.id = id_b"""
)
def pair_prompts(spark: SparkSession, folder: str) -> DataFrame:
    every = vectors(spark, folder)
    documents = table(spark, folder, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    documents = documents.join(broadcast_if_small(every.select("vec_id"), ID_ROWS), "vec_id", "left_semi")  # texts that no row has stay
    functions = every.drop("embedding").join(documents, "vec_id", "left").select(
        "vec_id", F.col("owner").alias("executor"), F.col("label").alias("type"), F.lit(None).alias("sphere"), "text"
    )
    return prompts_of_pairs(pairs_of(every), functions, "vec_id", "Judge.")


def groups_of(df: DataFrame, sizes: Sizes = Sizes()) -> DataFrame:
    return group_pairs(near_duplicate_links(df, "vec_id", "embedding", "owner", ["label"], THRESHOLD, sizes=sizes))


@query(f"{GROUPS} SELECT id, group_id FROM grouped")
def collision_groups(spark: SparkSession, folder: str) -> DataFrame:
    """All candidates taken as real, closed into groups."""
    return groups_of(vectors(spark, folder))


@query(f"{GROUPS} SELECT id, group_id FROM grouped")
def collision_groups_cells(spark: SparkSession, folder: str) -> DataFrame:
    return groups_of(vectors(spark, folder), TIGHT)


@query(
    f"""{GROUPS} SELECT vec_id, label, coalesce(group_id, 'NO_COLLISION') AS collision_group,
CASE WHEN group_id IS NULL THEN 'FALSE' ELSE 'REAL' END AS collision_verdict
FROM v LEFT JOIN grouped g ON g.id = v.id"""
)
def verdict_writeback(spark: SparkSession, folder: str) -> DataFrame:
    every = vectors(spark, folder)
    return write_back(every.select("vec_id", "label"), groups_of(every), "vec_id")


WEIGHTS = """words AS (
  SELECT doc_id, unnest(regexp_split_to_array(lower(text), '\\s+')) AS word FROM documents), counts AS (
  SELECT doc_id, CAST('0x' || substr(md5(word), 1, 7) AS BIGINT) % 64 AS bucket, count(*) AS n
  FROM words WHERE word <> '' GROUP BY ALL), weights AS (
  SELECT doc_id, bucket, CAST(CAST(n / sqrt(sum(n * n) OVER (PARTITION BY doc_id)) AS FLOAT) AS DOUBLE) AS weight
  FROM counts)"""


@query(f"WITH {WEIGHTS} SELECT doc_id, bucket, weight FROM weights")
def embed_texts(spark: SparkSession, folder: str) -> DataFrame:
    """The built-in encoder on whole documents; entries that are not zero."""
    embedded = embed(table(spark, folder, "documents").select("doc_id", "text"), "text", HashedWords())
    entries = embedded.select("doc_id", F.posexplode("embedding").alias("bucket", "weight")).where("weight <> 0")
    return entries.select("doc_id", F.col("bucket").cast("long").alias("bucket"), F.col("weight").cast("double").alias("weight"))


DOCUMENT_THRESHOLD = 0.98


@query(
    f"""WITH {WEIGHTS}, b AS (SELECT unnest(range(64)) AS bucket), dense AS (
  SELECT d.doc_id, d.lang, d.source, list(coalesce(w.weight, 0.0) ORDER BY b.bucket) AS e
  FROM documents d CROSS JOIN b LEFT JOIN weights w ON w.doc_id = d.doc_id AND w.bucket = b.bucket GROUP BY ALL), f AS (
  SELECT *, CAST(doc_id AS VARCHAR) AS id FROM dense)
SELECT a.id AS id_a, b.id AS id_b, round(list_cosine_similarity(a.e, b.e), 6) AS sim
FROM f a JOIN f b ON a.lang = b.lang AND a.source <> b.source AND a.id < b.id
WHERE round(list_cosine_similarity(a.e, b.e), 9) >= {DOCUMENT_THRESHOLD}"""
)
def document_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents, embedded and paired: same language, different sources."""
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    embedded = embed(documents, "text", HashedWords()).drop("text")
    pairs = near_duplicate_pairs(embedded, "doc_id", "embedding", "source", ["lang"], DOCUMENT_THRESHOLD)
    return pairs.withColumn("sim", F.round("sim", 6))
