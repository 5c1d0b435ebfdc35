"""From pairs to groups: connected components, numbering, write-back."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lexroll.operators.lineage import cut_lineage
from lexroll.operators.ranks import row_numbers
from lexroll.operators.skew import join_to_keys
from lexroll.profile import GROUP_PREFIX, NO_COLLISION


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the links of each batch by stars around the smallest id they connect."""
    for batch in batches:
        lead: dict = {}

        def find(x):
            while lead.setdefault(x, x) != x:
                lead[x] = lead[lead[x]]
                x = lead[x]
            return x

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(a), find(b)
            if a != b:
                lead[max(a, b)] = min(a, b)
        links = [(x, find(x)) for x in lead if find(x) != x]
        columns = [pa.array([x[i] for x in links], batch.schema.field(i).type) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays(columns, names=["u", "v"])


def connected_groups(links: DataFrame, a: str = "id_a", b: str = "id_b") -> DataFrame:
    """(id, root): ``root`` is the smallest id connected to ``id``.

    Large-star / small-star rounds: every round reconnects neighbours to the smallest id
    around them until only stars are left.  Links are thinned batch by batch before the
    first shuffle, and every round is written to the shared folder.
    """
    kind = links.schema[a].dataType.simpleString()
    pairs = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    edges = cut_lineage(pairs.mapInArrow(_forest, f"u {kind}, v {kind}").distinct())
    while not _only_stars(edges):
        edges = cut_lineage(_small_star(cut_lineage(_large_star(edges))))
    members = edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
    return members.unionByName(roots)


def _only_stars(edges: DataFrame) -> bool:
    """No id hangs on two others, and none both hangs on one and is hung on."""
    ends = [F.struct(F.col(c).alias("id"), F.lit(hangs).alias("hangs")) for c, hangs in (("u", 1), ("v", 0))]
    roles = edges.select(F.explode(F.array(*ends)).alias("r")).groupBy("r.id").agg(
        F.sum("r.hangs").alias("ups"), F.count_if(F.col("r.hangs") == 0).alias("downs")
    )
    return roles.where("ups > 1 OR (ups > 0 AND downs > 0)").isEmpty()


def _least(links: DataFrame) -> DataFrame:
    """(u, m, n): the smallest neighbour of each id and how many links it has."""
    return cut_lineage(links.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).select("u", F.least("u", "m").alias("m"), "n")
    # A hub may have any share of the links.
    near = join_to_keys(both.where("v > u"), least, "u", "n")
    return near.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    moved = join_to_keys(down, least, "u", "n").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def group_pairs(links: DataFrame, a: str = "id_a", b: str = "id_b", prefix: str = GROUP_PREFIX) -> DataFrame:
    """(id, group_id): groups numbered from 1 in the order of their smallest id."""
    members = cut_lineage(connected_groups(links, a, b))
    sizes = members.groupBy("root").agg(F.count("*").alias("size"))
    numbered = cut_lineage(row_numbers(sizes, [], ["root"], "n"))
    return join_to_keys(members, numbered, "root", "size").select(
        "id", F.concat(F.lit(prefix), F.col("n").cast("string")).alias("group_id")
    )


def grow_groups(groups: DataFrame, links: DataFrame, a: str = "id_a", b: str = "id_b") -> DataFrame:
    """(id, number): ``groups``, of these columns, with new links taken in; old links are not needed.

    A group that is touched enters as one contracted node, so only the new links and the groups at their ends are
    closed.  Old groups keep their numbers; those that grow together keep the least; groups of new ids only get the
    numbers after the largest so far, in the order of their smallest id.  Numbers of vanished groups aren't
    given again.
    """
    pairs = cut_lineage(links.select(F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b")).where("a <> b"))
    ends = pairs.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count("*").alias("uses"))
    # A group's name comes before any id and in the order of its number.
    named = F.coalesce(F.concat(F.lit("0:"), F.lpad(F.col("number").cast("string"), 20, "0")), F.concat(F.lit("1:"), "id"))
    nodes = cut_lineage(ends.join(groups, "id", "left").select("id", "uses", "number", named.alias("node")))
    facts = nodes.select("id", "node", "uses")
    for side in ("a", "b"):
        pairs = join_to_keys(pairs, facts.withColumnsRenamed({"id": side, "node": f"node_{side}"}), side, "uses")
    roots = cut_lineage(connected_groups(pairs.select("node_a", "node_b"), "node_a", "node_b"))
    is_old = lambda c: F.col(c).startswith("0:")
    number_of = lambda c: F.substring(c, 3, 20).cast("long")
    # Old groups that have grown into an older one: as many as new links at most.
    moved = roots.where(is_old("id") & (F.col("id") != F.col("root"))).select(number_of("id").alias("number"), number_of("root").alias("into"))
    sizes = groups.groupBy("number").agg(F.count("*").alias("size")).join(cut_lineage(moved), "number")
    kept = join_to_keys(groups, cut_lineage(sizes), "number", "size").select("id", F.coalesce("into", "number").alias("number"))
    last = groups.agg(F.max("number")).first()[0] or 0
    fresh = nodes.where("number IS NULL").select("id", F.col("node").alias("_node"))
    of_new = cut_lineage(fresh.join(roots, fresh["_node"] == roots["id"]).select(fresh["id"], "root"))
    counts = of_new.groupBy("root").agg(F.count("*").alias("size"))
    numbers = row_numbers(cut_lineage(counts.where(~is_old("root"))), [], ["root"], "n").select("root", "size", (F.col("n") + last).alias("number"))
    numbers = cut_lineage(numbers.unionByName(counts.where(is_old("root")).withColumn("number", number_of("root"))))
    return kept.unionByName(join_to_keys(of_new, numbers, "root", "size").select("id", "number"))


def write_back(df: DataFrame, groups: DataFrame, id_col: str) -> DataFrame:
    """``df`` with ``collision_group`` and ``collision_verdict``; rows in no group get the
    constants, also when there is no group at all."""
    found = groups.select(F.col("id").alias("_member"), "group_id")
    return (
        df.join(found, F.col(id_col).cast("string") == F.col("_member"), "left")
        .withColumn("collision_group", F.coalesce("group_id", F.lit(NO_COLLISION)))
        .withColumn("collision_verdict", F.when(F.col("group_id").isNull(), "FALSE").otherwise("REAL"))
        .drop("_member", "group_id")
    )
