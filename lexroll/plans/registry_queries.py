"""Queries on hierarchies and registries: regions, nations, customers and their orders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexroll.operators import hierarchy, reports
from lexroll.plans.catalog import query, table
from lexroll.profile import LEVEL_TAGS, NameRules, ReportRules

NAMES = NameRules(levels={"customer": "2", "nation": "1"}, root="World Union")


def bodies(spark: SparkSession, folder: str) -> DataFrame:
    """Sections: each order speaks of its customer below a nation, or at times a region."""
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    orders = table(spark, folder, "orders").join(
        table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey")
    ).join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    of_orders = orders.select(
        (F.col("o_orderkey") + 100).alias("ord"),
        F.concat("c_name", F.lit(" "), "o_orderpriority").alias("full_name"),
        F.col("c_name").alias("main"),
        F.when(F.col("o_orderstatus") == "P", F.col("r_name"))
        .when((F.col("o_orderstatus") == "O") & (F.col("c_acctbal") < 0), F.lit(" ")).otherwise(F.col("n_name")).alias("parent"),
        F.concat("o_orderpriority", F.lit(" of "), F.col("o_orderkey").cast("string")).alias("item"),
    )
    of_nations = nations.select(
        F.col("n_nationkey").cast("long").alias("ord"), F.lit("").alias("full_name"), F.col("n_name").alias("main"),
        F.col("r_name").alias("parent"), F.lit(None).cast("string").alias("item"),
    )
    return of_orders.unionByName(of_nations)


BODIES = """bodies AS (
  SELECT o_orderkey + 100 AS ord, c_name || ' ' || o_orderpriority AS full_name, c_name AS main,
    CASE WHEN o_orderstatus = 'P' THEN r_name WHEN o_orderstatus = 'O' AND c_acctbal < 0 THEN ' ' ELSE n_name END AS parent,
    o_orderpriority || ' of ' || o_orderkey AS item
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT n_nationkey, '', n_name, r_name, NULL FROM nation JOIN region ON n_regionkey = r_regionkey)"""
# abbreviations: NATION_1 and AFRICA are all capitals, MIDDLE EAST gives its first word
NODES = f"""{BODIES}, mentions AS (
  SELECT main AS name, ord, 0 AS second, coalesce(nullif(full_name, ''), main) AS full_name, nullif(trim(parent), '') AS parent, CAST(NULL AS VARCHAR) AS child
  FROM bodies
  UNION ALL SELECT trim(parent), ord, 1, trim(parent), CAST(NULL AS VARCHAR), main FROM bodies WHERE trim(parent) <> ''), nodes AS (
  SELECT name, arg_min(full_name, (-len(full_name), ord, second)) AS full_name,
    arg_min(parent, (ord, second)) FILTER (WHERE parent IS NOT NULL) AS parent_name,
    CASE WHEN name LIKE 'Customer%' THEN 'C' ELSE split_part(name, ' ', 1) END AS abbreviation,
    CASE WHEN name LIKE 'Customer%' THEN '2' WHEN name LIKE 'NATION%' THEN '1' ELSE '' END AS level,
    count(DISTINCT child) AS children, count(DISTINCT parent) > 1 AS conflict FROM mentions GROUP BY name)"""
PATHS = f"""WITH RECURSIVE {NODES}, p AS (
  SELECT name, abbreviation AS id_prefix, full_name || ' WU' AS executor, 'World Union' AS parent_executor, abbreviation AS mark
  FROM nodes WHERE parent_name IS NULL
  UNION ALL SELECT n.name, p.id_prefix || '-' || n.abbreviation, n.full_name || ' ' || p.mark, p.executor, n.abbreviation
  FROM nodes n JOIN p ON n.parent_name = p.name)"""


def nodes(spark: SparkSession, folder: str) -> DataFrame:
    return hierarchy.build_nodes(bodies(spark, folder), NAMES)


@query(f"WITH {NODES} SELECT name, full_name, parent_name, abbreviation, level, children, conflict FROM nodes")
def hierarchy_nodes(spark: SparkSession, folder: str) -> DataFrame:
    return nodes(spark, folder).select("name", "full_name", "parent_name", "abbreviation", "level", "children", "conflict")


@query(f"{PATHS} SELECT name, id_prefix, executor, parent_executor FROM p")
def hierarchy_paths(spark: SparkSession, folder: str) -> DataFrame:
    return hierarchy.hierarchy_paths(nodes(spark, folder), NAMES).select("name", "id_prefix", "executor", "parent_executor")


@query(
    f"""WITH {BODIES} SELECT main AS name, count(DISTINCT trim(parent)) AS parents FROM bodies WHERE trim(parent) <> ''
GROUP BY main HAVING count(DISTINCT trim(parent)) > 1"""
)
def hierarchy_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    return hierarchy.hierarchy_conflicts(bodies(spark, folder))


@query(
    """WITH RECURSIVE n AS (SELECT count(*) AS n FROM part), f AS (
  SELECT 'P' || p_partkey AS x, 'P' || ((p_partkey * p_partkey + 1) % n) AS y FROM part, n), reach AS (
  SELECT x, y FROM f UNION SELECT r.x, f.y FROM reach r JOIN f ON f.x = r.y)
SELECT x AS name, min(y) AS cycle FROM reach WHERE x IN (SELECT x FROM reach WHERE x = y) GROUP BY x"""
)
def hierarchy_cycles(spark: SparkSession, folder: str) -> DataFrame:
    """Parts, each below another one worked out from its key: many chains run into cycles."""
    parts = table(spark, folder, "part").select("p_partkey")
    key = F.col("p_partkey")
    above = F.concat(F.lit("P"), ((key * key + 1) % parts.count()).cast("string"))
    return hierarchy.find_cycles(parts.select(F.concat(F.lit("P"), key.cast("string")).alias("name"), above.alias("parent_name")))


@query(
    f"""{PATHS}, i AS (SELECT main AS name, item, row_number() OVER (PARTITION BY main ORDER BY ord) AS item_no
  FROM bodies WHERE item IS NOT NULL)
SELECT p.id_prefix || '-' || item_no AS function_id, item AS function_text, executor, parent_executor, level, i.name AS node_name
FROM i JOIN p ON p.name = i.name JOIN nodes n ON n.name = i.name"""
)
def registry_rows(spark: SparkSession, folder: str) -> DataFrame:
    sections = bodies(spark, folder)
    items = sections.where("item IS NOT NULL").select(F.col("main").alias("name"), "ord", "item")
    paths = hierarchy.hierarchy_paths(hierarchy.build_nodes(sections, NAMES), NAMES)
    return hierarchy.registry_rows(paths, items, ["ord"]).drop("item_no")


# --- reports: orders as functions of nations ---------------------------------------------


def registry(spark: SparkSession, folder: str) -> DataFrame:
    owners = table(spark, folder, "customer").join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    orders = table(spark, folder, "orders").join(owners, F.col("o_custkey") == F.col("c_custkey"))
    status = F.col("o_orderstatus")
    return orders.select(
        F.concat("n_name", F.lit("-"), F.col("o_orderkey").cast("string")).alias("function_id"),
        F.when(F.col("o_totalprice") > 5000, F.concat(F.lit(" "), "c_name", F.lit(":\n"), "o_orderpriority", F.lit(" "))).alias("function_text"),
        F.when(F.col("c_acctbal") > -900, F.concat(F.lit("Office of "), "n_name")).alias("executor"),
        (F.col("n_regionkey") * 2 + 1).cast("string").alias("level"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("true_type"),
        F.concat(F.lit("01.1 "), "c_mktsegment").alias("sphere"),
        F.when(status != "F", F.concat(F.lit("01.1 "), "c_mktsegment")).alias("sphere_2"),
        F.when(status == "P", F.concat(F.lit("COLLISION_"), F.col("o_custkey").cast("string")))
        .when(status == "O", "NO_COLLISION").alias("collision_group"),
        F.when(status == "P", "REAL").otherwise("FALSE").alias("collision_verdict"),
        F.col("o_orderkey").alias("row_ord"),
    )


REGISTRY = """registry AS (
  SELECT n_name || '-' || o_orderkey AS function_id,
    CASE WHEN o_totalprice > 5000 THEN ' ' || c_name || ':' || chr(10) || o_orderpriority || ' ' END AS function_text,
    CASE WHEN c_acctbal > -900 THEN 'Office of ' || n_name END AS executor, CAST(n_regionkey * 2 + 1 AS VARCHAR) AS level,
    CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS true_type, '01.1 ' || c_mktsegment AS sphere,
    CASE WHEN o_orderstatus <> 'F' THEN '01.1 ' || c_mktsegment END AS sphere_2,
    CASE o_orderstatus WHEN 'P' THEN 'COLLISION_' || o_custkey WHEN 'O' THEN 'NO_COLLISION' END AS collision_group,
    CASE o_orderstatus WHEN 'P' THEN 'REAL' ELSE 'FALSE' END AS collision_verdict, o_orderkey AS row_ord
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey), owned AS (
  SELECT *, coalesce(collision_group, 'NO_COLLISION') <> 'NO_COLLISION' AS hit FROM registry WHERE executor IS NOT NULL), totals AS (
  SELECT executor, count(*) AS total, count(CASE WHEN hit THEN 1 END) AS collisions FROM owned GROUP BY executor)"""


def share_sql(column: str) -> str:
    return f"""(SELECT o.executor, coalesce({column}, '') AS {column}, count(*) AS n,
  CAST(printf('%.1f', count(*)::DOUBLE / any_value(total)::DOUBLE * 100.0) AS DOUBLE) AS share
  FROM owned o JOIN totals t ON t.executor = o.executor GROUP BY o.executor, coalesce({column}, ''))"""


@query(f"WITH {REGISTRY} SELECT executor, total, collisions FROM totals")
def portrait_totals(spark: SparkSession, folder: str) -> DataFrame:
    return reports.portrait_totals(registry(spark, folder))


@query(f"WITH {REGISTRY} SELECT * FROM {share_sql('true_type')}")
def portrait_type_share(spark: SparkSession, folder: str) -> DataFrame:
    return reports.portrait_share(registry(spark, folder), "true_type")


@query(f"WITH {REGISTRY} SELECT * FROM {share_sql('sphere')}")
def portrait_sphere_share(spark: SparkSession, folder: str) -> DataFrame:
    return reports.portrait_share(registry(spark, folder), "sphere")


R = ReportRules()
LINE = "unnest(x) AS line, unnest(range(len(x))) AS line_no"
STRIPPED = "trim(function_text, ' ' || chr(10))"
SPHERE = r"regexp_replace(sphere_2, '^\d+\.?\s*', '')"
TAG = "CASE level " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LEVEL_TAGS.items()) + f" ELSE '{R.tag_fallback}' || level END"
ANCHOR = "replace(executor, ' ', '_')"


def page(doc: str, owner: str, part: int, lines: str, source: str, key: str = "''", row: str = "-1") -> str:
    return f"""SELECT doc_name, owner, part, key, row_ord, line_no, line FROM (
  SELECT *, {LINE} FROM (SELECT {doc} AS doc_name, {owner} AS owner, {part} AS part, {key} AS key, {row} AS row_ord, {lines} AS x
  FROM {source}))"""


LEVEL_DOC = "'level_' || level || '_functions.md'"
LEVEL_DETAILS = f"""concat_ws(' | ', '{R.type_word}' || true_type, '{R.sphere_word}' || {SPHERE})"""
ENTRY = f"""'- {R.bullet} **' || function_id || '**' || CASE WHEN {LEVEL_DETAILS} <> '' THEN ' (' || {LEVEL_DETAILS} || ')' ELSE '' END"""
LEVEL_PAGES = " UNION ALL ".join(
    [
        page(LEVEL_DOC, "level", 0, f"['{R.level_title}' || level, {TAG}, '', '{R.contents}', '']", "(SELECT DISTINCT level FROM owned)"),
        page(LEVEL_DOC, "level", 1, f"['- [' || executor || '](#' || {ANCHOR} || ')']", "(SELECT DISTINCT level, executor FROM owned)", "executor"),
        page(LEVEL_DOC, "level", 2, "['']", "(SELECT DISTINCT level FROM owned)"),
        page(
            LEVEL_DOC, "level", 3, f"""['## ' || executor, '<a name="' || {ANCHOR} || '"></a>', '', '{R.functions}', '']""",
            "(SELECT DISTINCT level, executor FROM owned)", "executor",
        ),
        page(
            LEVEL_DOC, "level", 3,
            f"CASE WHEN function_text IS NULL THEN [{ENTRY}] ELSE [{ENTRY}, '', '```', {STRIPPED}, '```', ''] END", "owned", "executor", "row_ord",
        ),
    ]
)
GROUP_DOC = "'collision_' || collision_group || '.md'"
BODY = f"coalesce({STRIPPED}, '{R.no_text}')"
GROUP_PAGES = " UNION ALL ".join(
    [
        page(GROUP_DOC, "collision_group", 0, f"['{R.group_title}' || collision_group, '', '{R.group_items}', '']", "(SELECT DISTINCT collision_group FROM grouped)"),
        page(
            GROUP_DOC, "collision_group", 1,
            f"""['### ' || function_id, '{R.executor_word}' || coalesce(executor, ''), '{R.verdict_word}' || collision_verdict, '', '```', {BODY}, '```', '']""",
            "grouped", row="row_ord",
        ),
    ]
)
PORTRAIT_DOC = f"'portrait_' || {ANCHOR} || '.md'"
PORTRAIT_DETAILS = f"""concat_ws(' | ', '{R.type_word}' || true_type, '{R.sphere_word}' || {SPHERE},
  CASE WHEN hit THEN '{R.collision_word}' || collision_group END)"""
PORTRAIT_PAGES = " UNION ALL ".join(
    [
        page(
            PORTRAIT_DOC, "executor", 0,
            f"""['{R.portrait_title}' || executor, '', '{R.statistics}', '', '{R.total_word}' || total, '{R.collisions_word}' || collisions,
  '', '{R.types_title}', '', '{R.types_head[0]}', '{R.types_head[1]}']""", "totals",
        ),
        page(PORTRAIT_DOC, "executor", 1, "['| ' || true_type || ' | ' || n || ' | ' || printf('%.1f', share) || '% |']", share_sql("true_type"), "true_type"),
        page(PORTRAIT_DOC, "executor", 2, f"['', '{R.spheres_title}', '', '{R.spheres_head[0]}', '{R.spheres_head[1]}']", "totals"),
        page(PORTRAIT_DOC, "executor", 3, "['| ' || sphere || ' | ' || n || ' | ' || printf('%.1f', share) || '% |']", share_sql("sphere"), "sphere"),
        page(PORTRAIT_DOC, "executor", 4, f"['', '{R.list_title}', '']", "totals"),
        page(
            PORTRAIT_DOC, "executor", 5,
            f"""['### {R.bullet} ' || function_id, CASE WHEN {PORTRAIT_DETAILS} <> '' THEN '{R.details_word}' || {PORTRAIT_DETAILS} ELSE '' END,
  '', '```', {BODY}, '```', '']""", "owned", row="row_ord",
        ),
    ]
)


def typed(lines: DataFrame) -> DataFrame:
    return lines.withColumn("line_no", F.col("line_no").cast("long"))


@query(f"WITH {REGISTRY} {LEVEL_PAGES}")
def level_documents(spark: SparkSession, folder: str) -> DataFrame:
    return typed(reports.level_documents(registry(spark, folder)))


@query(
    f"""WITH {REGISTRY}, grouped AS (
  SELECT * FROM registry WHERE coalesce(collision_group, 'NO_COLLISION') <> 'NO_COLLISION') {GROUP_PAGES}"""
)
def collision_documents(spark: SparkSession, folder: str) -> DataFrame:
    return typed(reports.collision_documents(registry(spark, folder)))


@query(f"WITH {REGISTRY} {PORTRAIT_PAGES}")
def portrait_documents(spark: SparkSession, folder: str) -> DataFrame:
    return typed(reports.portrait_documents(registry(spark, folder)))
