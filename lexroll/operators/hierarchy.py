"""Bodies and their parents: nodes, paths, cycles, registry rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexroll.functions.text import abbreviate, level_of
from lexroll.operators.lineage import broadcast_if_small, cut_lineage
from lexroll.operators.ranks import go_on_numbering, row_numbers
from lexroll.operators.skew import join_to_keys
from lexroll.profile import NameRules


def build_nodes(sections: DataFrame, rules: NameRules = NameRules()) -> DataFrame:
    """One node per body from (ord, full_name, main, parent[, items]).

    ``ord`` orders the sections.  The first parent that is given wins, and the longest full
    name, the earlier one of equals.  Bodies that are only named as parents are nodes too.
    ``conflict`` marks bodies with more than one parent.
    """
    full = F.coalesce(F.when(F.col("full_name") != "", F.col("full_name")), F.col("main"))
    # once per body and parent: what follows is small, and every child counts once
    spoken = sections.groupBy("main", F.when(F.trim("parent") != "", F.trim("parent")).alias("parent")).agg(
        F.min("ord").alias("ord"),
        # the longest name; of equals, the one seen first
        F.min(F.struct((-F.length(full)).alias("shorter"), F.col("ord"), full.alias("full"))).alias("longest"),
    )

    def mention(name: str, as_parent: int, ord: str, shorter: Column, full: str, parent: Column) -> DataFrame:
        seen = F.struct(F.col("ord"), F.lit(as_parent).alias("as_parent"))
        longest_seen = F.struct(F.col(ord).alias("ord"), F.lit(as_parent).alias("as_parent"))
        return spoken.select(
            F.col(name).alias("name"),
            seen.alias("seen"),
            F.struct(shorter.alias("shorter"), longest_seen.alias("seen"), F.col(full).alias("full")).alias("longest"),
            parent.alias("parent"),
            F.lit(as_parent).alias("child"),
        )

    own = mention("main", 0, "longest.ord", F.col("longest.shorter"), "longest.full", F.col("parent"))
    named = mention("parent", 1, "ord", -F.length("parent"), "parent", F.lit(None).cast("string")).where("name IS NOT NULL")
    nodes = own.unionByName(named).groupBy("name").agg(
        F.min("seen").alias("seen"),
        F.min(F.when(F.col("parent").isNotNull(), F.struct("seen", "parent"))).alias("first"),
        F.min("longest").alias("longest"),
        (F.min("parent") != F.max("parent")).alias("conflict"),
        F.sum("child").alias("children"),
    )
    return nodes.select(
        "name",
        F.col("longest.full").alias("full_name"),
        F.col("first.parent").alias("parent_name"),
        abbreviate(F.col("name"), rules).alias("abbreviation"),
        level_of(F.col("name"), rules).alias("level"),
        "children",
        F.coalesce("conflict", F.lit(False)).alias("conflict"),
        F.col("seen.ord").alias("ord"),
        F.col("seen.as_parent").alias("as_parent"),
    )


def child_links(nodes: DataFrame) -> DataFrame:
    """(name, child): the children of each body as rows, however many there are."""
    return nodes.where("parent_name IS NOT NULL").select(F.col("parent_name").alias("name"), F.col("name").alias("child"))


def hierarchy_conflicts(sections: DataFrame) -> DataFrame:
    """Bodies that are given more than one parent, with the number of parents."""
    given = sections.where(F.trim("parent") != "").select(F.col("main").alias("name"), F.trim("parent").alias("parent"))
    return given.distinct().groupBy("name").agg(F.count("*").alias("parents")).where("parents > 1")


def _climb(links: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Paths from (name, up, abbreviation); ``up`` is NULL at a root.

    ``links`` should be cut from its lineage.  Every round doubles the distance a node looks
    up, so the rounds follow the logarithm of the depth.  Returns (name, path) of the nodes
    that reach a root, and the rest: nodes on a cycle or below one.  There ``peak`` is the
    least name among all that lie above.
    """
    columns = ["name", "up", "path", "peak"]
    state = links.select("name", "up", F.col("abbreviation").alias("path"), F.col("up").alias("peak"))
    finished, still = state.where("up IS NULL"), state.where("up IS NOT NULL")
    before = None
    while True:
        found = still.agg(
            F.count("*").alias("open"),
            F.count_distinct("up").alias("ends"),
            F.sum(F.xxhash64("name", "peak").cast("decimal(38,0)")).alias("mark"),
        ).first()
        if found["open"] == 0:
            return finished.select("name", "path"), None
        if before == tuple(found):
            return finished.select("name", "path"), still.select("name", F.col("up").alias("end"), "peak")
        before = tuple(found)
        above = finished.unionByName(still).select(
            F.col("name").alias("up"), F.col("up").alias("next"), F.col("path").alias("head"), F.col("peak").alias("high")
        )
        # Only nodes on their way take part; every ``up`` is a node.
        moved = cut_lineage(
            still.join(above, "up").select(
                "name",
                F.col("next").alias("up"),
                F.concat_ws("-", "head", "path").alias("path"),
                F.least("peak", "high").alias("peak"),
            )
        ).select(columns)
        finished, still = finished.unionByName(moved.where("up IS NULL")), moved.where("up IS NOT NULL")


def _look_up(rows: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Left join; rows without a key take no part in the shuffle."""
    asked = rows.where(F.col(key).isNotNull()).join(dim, key, "left")
    return asked.unionByName(rows.where(F.col(key).isNull()), allowMissingColumns=True)


def _parents(nodes: DataFrame) -> DataFrame:
    """Nodes with ``up``: the parent's name where the parent is a node.  ``nodes`` should be cut from its lineage."""
    known = nodes.select(F.col("name").alias("_asked"), F.col("name").alias("up"))
    return _look_up(nodes.withColumn("_asked", F.trim("parent_name")), known, "_asked").drop("_asked")


def find_cycles(nodes: DataFrame) -> DataFrame:
    """(name, cycle): bodies that are their own ancestors; ``cycle`` is the least of them."""
    linked = cut_lineage(_parents(cut_lineage(nodes)).select("name", "up", F.lit(None).cast("string").alias("abbreviation")))
    _, rest = _climb(linked)
    if rest is None:
        return linked.select("name", F.col("name").alias("cycle")).where(F.lit(False))
    # far enough up, everything ends on a cycle, and every member of one is such an end
    on_cycle = rest.select(F.col("end").alias("name")).distinct()
    return rest.join(on_cycle, "name", "left_semi").select("name", F.col("peak").alias("cycle"))


def hierarchy_paths(nodes: DataFrame, rules: NameRules = NameRules()) -> DataFrame:
    """Add ``id_prefix``, ``executor`` and ``parent_executor``.

    The prefix joins the abbreviations from the root down.  The executor is the full name
    with the parent's abbreviation, or the root's.  A cycle is cut above its least member,
    which then counts as a root.
    """
    nodes = cut_lineage(nodes)
    linked = cut_lineage(_parents(nodes).select(*nodes.columns, "up"))
    paths, rest = _climb(linked.select("name", "up", "abbreviation"))
    if rest is not None:
        cuts = rest.where("name = peak").select("name", F.lit(True).alias("_cut"))
        linked = linked.join(cuts, "name", "left").withColumn(
            "up", F.when(F.col("_cut").isNull(), F.col("up"))
        ).drop("_cut")
        paths, _ = _climb(linked.select("name", "up", "abbreviation"))
    root_mark = abbreviate(F.lit(rules.root), rules)
    above = linked.select(F.col("name").alias("up"), F.col("abbreviation").alias("_mark"))
    labelled = cut_lineage(
        _look_up(linked, above, "up").withColumn(
            "executor", F.trim(F.concat_ws(" ", "full_name", F.coalesce("_mark", root_mark)))
        )
    )
    parents = labelled.select(F.col("name").alias("up"), F.col("executor").alias("_parent_executor"))
    return (
        _look_up(labelled, parents, "up")
        .join(paths.withColumnRenamed("path", "id_prefix"), "name")
        .select(
            *nodes.columns,
            "id_prefix",
            "executor",
            F.coalesce("_parent_executor", F.lit(rules.root)).alias("parent_executor"),
        )
    )


def update_paths(known: DataFrame, changed: DataFrame, rules: NameRules = NameRules()) -> DataFrame:
    """``known``, as ``hierarchy_paths`` gave it, after bodies have changed or come in.

    ``changed`` has the new nodes of these bodies.  They and all that lies below them are climbed again, level by level down
    and then in doubling steps up to the first body that stays as it was; other rows are taken over as they are.  A
    cycle has a changed link, and so all of it is climbed again; it is cut as ever.
    """
    columns = changed.columns
    changed = cut_lineage(changed)
    marks = changed.select("name").distinct()
    others = known.join(broadcast_if_small(marks), "name", "left_anti")
    nodes = others.select(*columns).unionByName(changed)
    links = cut_lineage(nodes.where(F.trim("parent_name") != "").select(F.trim("parent_name").alias("above"), "name"))
    below = frontier = cut_lineage(marks)
    while not frontier.isEmpty():
        lower = links.join(broadcast_if_small(frontier.withColumnRenamed("name", "above")), "above").select("name").distinct()
        frontier = cut_lineage(lower.join(below, "name", "left_anti"))
        below = below.unionByName(frontier)
    below = cut_lineage(below)
    stay = cut_lineage(others.join(broadcast_if_small(below), "name", "left_anti"))
    # Rows to climb, with what is known of the parents that stay.
    todo = cut_lineage(nodes.join(broadcast_if_small(below), "name", "left_semi").withColumn("_asked", F.trim("parent_name")))
    wanted = broadcast_if_small(cut_lineage(todo.select(F.col("_asked").alias("name")).where("name IS NOT NULL").distinct()))
    above = stay.join(wanted, "name", "left_semi").select("name", F.col("id_prefix").alias("_path"), F.col("abbreviation").alias("_mark"), F.col("executor").alias("_boss"))
    known_above = above.unionByName(todo.select("name"), allowMissingColumns=True).withColumnsRenamed({"name": "_asked"})
    known_above = known_above.withColumn("up", F.col("_asked"))
    linked = _look_up(todo, cut_lineage(known_above), "_asked").withColumn("_stays", F.col("_path").isNotNull())
    # A parent that stays ends the climb, with its whole path before the body's own mark.
    start = linked.select(
        "name", F.when(~F.coalesce("_stays", F.lit(False)), F.col("up")).alias("up"),
        F.concat_ws("-", "_path", "abbreviation").alias("abbreviation"),
    )
    start = cut_lineage(start)
    paths, rest = _climb(start)
    linked = cut_lineage(linked)
    if rest is not None:
        cuts = cut_lineage(rest.where("name = peak").select("name", F.lit(True).alias("_cut")))
        without = lambda df: df.join(cuts, "name", "left").withColumn("up", F.when(F.col("_cut").isNull(), F.col("up"))).drop("_cut")
        start, linked = cut_lineage(without(start)), cut_lineage(without(linked))
        paths, _ = _climb(start)
    root_mark = abbreviate(F.lit(rules.root), rules)
    own = linked.select(F.col("name").alias("up"), F.col("abbreviation").alias("_own_mark"))
    labelled = cut_lineage(
        _look_up(linked, own, "up").withColumn(
            "executor", F.trim(F.concat_ws(" ", "full_name", F.coalesce("_mark", "_own_mark", root_mark)))
        )
    )
    bosses = labelled.select(F.col("name").alias("up"), F.col("executor").alias("_own_boss"))
    again = _look_up(labelled, bosses, "up").join(paths.withColumnRenamed("path", "id_prefix"), "name").select(
        *columns, "id_prefix", "executor", F.coalesce("_boss", "_own_boss", F.lit(rules.root)).alias("parent_executor")
    )
    return stay.select(*columns, "id_prefix", "executor", "parent_executor").unionByName(again)


def registry_rows(
    nodes: DataFrame, items: DataFrame, order: list[str], carry: list[str] = [], numbered: bool = False
) -> DataFrame:
    """Registry of (name, order…, item): ids ``prefix-1``, ``prefix-2``, … per body.

    Bodies without items give no row.  ``order`` is unique within a body.  Columns named in
    ``carry`` are kept.  ``numbered`` items bring their ``item_no``, as ``arriving_rows`` gives it.
    """
    items = cut_lineage(items)
    counted = items if numbered else row_numbers(items, ["name"], order, "item_no")
    sizes = items.groupBy("name").agg(F.count("*").alias("_items"))
    body = nodes.select("name", "id_prefix", "abbreviation", "executor", "full_name", "parent_executor", "level").join(sizes, "name")
    prefix = F.coalesce(F.when(F.col("id_prefix") != "", F.col("id_prefix")), F.col("abbreviation"))
    known = F.col("abbreviation").isNotNull()
    return join_to_keys(counted, cut_lineage(body), "name", "_items").where(known).select(
        F.concat_ws("-", prefix, F.col("item_no").cast("string")).alias("function_id"),
        F.col("item").alias("function_text"),
        F.coalesce("executor", "full_name").alias("executor"),
        "parent_executor",
        F.coalesce("level", F.lit("")).alias("level"),
        F.col("name").alias("node_name"),
        "item_no",
        *carry,
    )


def number_marks(registry: DataFrame) -> DataFrame:
    """(name, last): the last number that each body has given."""
    return registry.groupBy(F.col("node_name").alias("name")).agg(F.max("item_no").alias("last"))


def arriving_rows(
    nodes: DataFrame, items: DataFrame, marks: DataFrame, order: list[str], carry: list[str] = []
) -> tuple[DataFrame, DataFrame]:
    """Registry rows of items that arrive later, numbered on from their bodies' marks, and the marks after them."""
    numbered, after = go_on_numbering(items, marks, "name", order, "item_no")
    return registry_rows(nodes, numbered, order, carry, numbered=True), after
