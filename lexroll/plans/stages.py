"""The five stages as plain function composition.

parse -> classify -> place -> collide -> report.  Each takes and returns DataFrames, works
on pending rows only and can be run again on its own output.  Between stages write a
snapshot (``stage.write_snapshot``) and read it back.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F, Window

from lexroll.functions import answers, text
from lexroll.operators import hierarchy, labels, reports, sections as cut, similar, stage
from lexroll.operators.closure import connected_groups, group_pairs, write_back
from lexroll.operators.inference import Encoder, Model, embed, infer, infer_pairs
from lexroll.operators.lineage import broadcast_if_small, cut_lineage, fits_broadcast
from lexroll.operators.pair_tiles import ID_ROWS
from lexroll.operators.ranks import row_numbers
from lexroll.operators.skew import join_to_keys
from lexroll.profile import (
    ATTEMPTS,
    BOILERPLATE_THRESHOLD,
    CATCH_ALL_LABEL,
    HINTS,
    PAIR_THRESHOLD,
    TOP_NODES,
    CleanRules,
    LabelRules,
    NameRules,
    ReportRules,
    SectionRules,
)


@dataclass(frozen=True)
class Parsed:
    registry: DataFrame
    rejected: DataFrame
    nodes: DataFrame


def parse(
    documents: DataFrame,
    name_model: Model,
    rules: SectionRules = SectionRules(),
    cleaning: CleanRules = CleanRules(),
    names: NameRules = NameRules(),
    aliases: DataFrame | None = None,
) -> Parsed:
    """Registry of the items of (doc, paragraphs), ordered by ``doc``.

    ``name_model`` is given the head of a section and answers with ``full_go_name``.
    ``aliases`` (name, instead) puts other names for parents, such as their base form.
    """
    found = cut.with_items(cut.with_sections(documents, "paragraphs", rules), rules, cleaning)
    asked = found.withColumn("prompt", cut.context(F.col("paragraphs"), rules)).drop("paragraphs")
    asked = asked.withColumnRenamed("status", "item_status")
    named = infer(asked, "prompt", name_model, accept=lambda a: a is not None and "full_go_name" in a)
    full = text.strip(answers.json_text(F.col("raw"), "full_go_name", fenced=True))
    named = (
        named.withColumn("full_name", full)
        .withColumn("_name", text.split_name(F.col("full_name"), names))
        .withColumn("main", F.col("_name.main"))
        .withColumn("parent", F.col("_name.parent"))
        .select("doc", "section_no", "full_name", "main", "parent", "items", F.col("item_status").alias("status"))
    )
    if aliases is not None:
        known = aliases.select(F.col("name").alias("parent"), "instead")
        named = named.join(known, "parent", "left").withColumn("parent", F.coalesce("instead", "parent")).drop("instead")
    accepted, rejected = cut.accept(cut_lineage(named))
    spoken = accepted.withColumn("ord", F.struct("doc", "section_no"))
    nodes = hierarchy.hierarchy_paths(hierarchy.build_nodes(spoken, names), names)
    items = cut.item_rows(accepted, ["doc", "section_no", "main"]).withColumnRenamed("main", "name")
    # ids of bodies with equal initials may repeat; the position in the input does not
    placed = row_numbers(items.withColumnRenamed("item_no", "para_no"), [], ["doc", "section_no", "para_no"], "row_ord")
    return Parsed(hierarchy.registry_rows(nodes, placed, ["row_ord"], ["row_ord"]), rejected, nodes)


def classify(
    registry: DataFrame,
    model: Model,
    template: str,
    examples: DataFrame | None = None,
    encode: Encoder | None = None,
    threshold: float = BOILERPLATE_THRESHOLD,
    k: int = HINTS,
    rules: LabelRules = LabelRules(),
    retry_undefined: bool = False,
) -> DataFrame:
    """Add ``true_type``, ``final_label``, ``labeled_by`` and ``type_status``.

    ``examples`` (ref_text, ref_label) give hints in the prompt; none of them, no hints.
    Rows whose call failed stay pending.
    """
    if retry_undefined and "true_type" in registry.columns:
        registry = registry.withColumn("true_type", F.nullif("true_type", F.lit(rules.undefined)))
    todo, done = stage.split_pending(registry, "true_type")
    todo = todo.drop("true_type", "final_label", "labeled_by", "type_status")
    # Rows with equal texts share hints, prompt and answer, so all of these are worked out once a text.
    keyed = todo.withColumn("_text", F.sha2(F.coalesce("function_text", F.lit("")), 256))
    texts = cut_lineage(
        keyed.groupBy("_text").agg(F.first(F.coalesce("function_text", F.lit(""))).alias("function_text"), F.count("*").alias("_same"))
    )
    hints = texts.select("_text", F.array().cast("array<string>").alias("hints"))
    if examples is not None and encode is not None:
        vectors = embed(texts.select("_text", "function_text"), "function_text", encode)
        # of equally near examples the first labels count
        name = F.concat(F.coalesce("ref_label", F.lit("")), F.lit("\0"), F.hex(F.xxhash64("ref_text", "ref_label")))
        library = embed(examples, "ref_text", encode).select(name.alias("ref_id"), "ref_label", "embedding")
        library = cut_lineage(library.dropDuplicates(["ref_id"]))
        hits = similar.nearest(vectors, library, k, "_text", "embedding", "ref_id", "embedding", threshold)
        hints = labels.hint_sets(hits.join(library.select("ref_id", "ref_label"), "ref_id"), "_text", "ref_label")
    asked = labels.type_prompts(texts, hints, "_text", template)
    asked = asked.withColumn("prompt", F.concat_ws("\n\n", "prompt", "function_text")).drop("function_text")
    answered = infer(asked, "prompt", model)
    fine = F.col("status") == "OK"
    label = F.when(fine, answers.type_verdict(F.col("raw"), rules=rules))
    said = answered.select(
        "_text", "_same", label.alias("true_type"), F.when(fine, "AI").alias("labeled_by"), F.col("status").alias("type_status")
    )
    told = said.withColumn("final_label", F.coalesce("true_type", F.lit(rules.error)))
    told = told.select("_text", "_same", "true_type", "final_label", "labeled_by", "type_status")
    new = join_to_keys(keyed, cut_lineage(told), "_text", "_same").drop("_text")
    return stage.merge_stage(done, new)


def place(
    registry: DataFrame,
    taxonomy: DataFrame,
    model: Model,
    encode: Encoder,
    template: str,
    titles: DataFrame | None = None,
    k: int = TOP_NODES,
    rules: LabelRules = LabelRules(),
    rounds: int = ATTEMPTS,
) -> DataFrame:
    """Add ``sphere``, ``sphere_2``, ``sphere_3`` and ``sphere_status``.

    ``taxonomy`` is (ord, name, description, activities).  The k nodes nearest to a text
    are put to the model; an answer that names no node is asked for again, up to
    ``rounds`` times.  Rows without a node stay pending.  Rows that no nodes are near to,
    since their text could not be encoded, get the error mark and are not asked.
    """
    todo, done = stage.split_pending(registry, "sphere_3", normalised=True)
    todo = todo.drop("sphere", "sphere_2", "sphere_3", "sphere_status")
    corpus = text.taxonomy_text(F.col("name"), F.col("description"), F.col("activities"))
    nodes = embed(taxonomy.withColumn("corpus", corpus), "corpus", encode)
    vectors = embed(todo, "function_text", encode)
    hits = similar.nearest(vectors, nodes, k, "row_ord", "embedding", "ord", "embedding")
    prompts = labels.candidate_prompts(hits, taxonomy.withColumnRenamed("ord", "ref_id"), "row_ord", template)
    offered = vectors.drop("embedding").join(prompts, "row_ord", "left")
    # A text that could not be encoded, or has no direction, has no nodes to choose from: it isn't asked.
    unplaced = offered.where("prompt IS NULL").withColumns(
        {"sphere": F.lit(rules.error), "how": F.lit("no nodes"), "status": F.lit("ERROR")}
    )
    asked = offered.where("prompt IS NOT NULL").withColumn("prompt", F.concat_ws("\n\n", "prompt", "function_text"))
    settled = []
    for round_no in range(1, rounds + 1):
        answered = infer(asked, "prompt", model, attempts=ATTEMPTS)
        named = answered.withColumn("_said", answers.json_text(F.col("raw"), "name"))
        placed = cut_lineage(labels.resolve_label(named, "_said", taxonomy, rules).drop("_said", "raw", "attempts"))
        again = placed.where((F.col("how") == "invalid") & (F.col("status") == "OK"))
        if round_no == rounds or again.isEmpty():
            settled.append(placed)
            break
        settled.append(placed.where((F.col("how") != "invalid") | (F.col("status") != "OK")))
        asked = again.drop("sphere", "how", "status")
    new = unplaced
    for part in settled:
        new = new.unionByName(part)
    new = new.withColumn("sphere_status", F.col("how")).drop("prompt", "how", "status")
    titles = labels.code_titles(registry.sparkSession) if titles is None else titles
    return labels.code_rollup(stage.merge_stage(done.drop("sphere_2", "sphere_3"), new), "sphere", titles, rules)


@dataclass(frozen=True)
class Collided:
    registry: DataFrame
    pairs: DataFrame


def _judged(pairs: DataFrame, registry: DataFrame, model: Model, template: str) -> DataFrame:
    """``pairs`` (id_a, id_b, …) with the model's ``verdict``."""
    given = lambda c: F.col(c) if c in registry.columns else F.lit(None)
    shown = registry.select(
        "row_ord",
        "function_id",
        "executor",
        given("true_type").alias("type"),
        given("sphere").alias("sphere"),
        F.col("function_text").alias("text"),
    )
    accept = lambda a: a is not None and any(v in a.upper() for v in ("REAL", "FALSE"))
    ask = lambda a, b: labels.pair_prompt(template, a, b)
    answered = infer_pairs(pairs, labels.pair_records(shown, "row_ord", "function_id"), model, ask, accept)
    return answered.withColumn("verdict", answers.pair_verdict(F.col("raw"))).drop("raw", "status", "attempts")


ASKED_FIRST = 4  # pairs of a group that are asked in the first round; each further round doubles them
ASKED_TOGETHER = 200_000  # pairs that are left, at which no further round pays


def _judged_for_groups(
    pairs: DataFrame, judge: Callable[[DataFrame], DataFrame], real: DataFrame | None = None, a: str = "id_a", b: str = "id_b"
) -> DataFrame:
    """``judge`` for the ``pairs`` whose verdict can change a group; the groups are those of all of them.

    Round by round, pairs within a group as it is known so far, by ``real`` (u, v) and the real pairs found, are settled: whatever
    their verdict, the group stays.  Of the others some of each group are asked, those of the smaller group of a pair, until
    no pair is left that was not asked and has its ends in different groups.  A pair of ``a`` with itself counts if it alone can make a group.
    """
    left, share, asked_in, chosen = cut_lineage(pairs), ASKED_FIRST, [], None
    spark, kind = pairs.sparkSession, pairs.schema[a].dataType.simpleString()
    links = spark.createDataFrame([], f"u {kind}, v {kind}") if real is None else cut_lineage(real)
    while True:
        members = cut_lineage(connected_groups(links, "u", "v"))
        sizes = members.groupBy("root").agg(F.count("*").alias("size"))
        facts = cut_lineage(join_to_keys(members, cut_lineage(sizes.withColumn("_size", F.col("size"))), "root", "_size"))
        placed = left
        if not facts.isEmpty():
            placed = _placed(placed, facts, a, b)
        else:
            placed = placed.withColumns({"_root_a": F.col(a), "_root_b": F.col(b), "_size_a": F.lit(1).cast("long"), "_size_b": F.lit(1).cast("long")})
        alone = (F.col(a) == F.col(b)) & (F.col("_size_a") == 1)
        open_ = placed.where((F.col("_root_a") != F.col("_root_b")) | alone)
        if chosen is not None:
            open_ = open_.join(broadcast_if_small(chosen.select("id_a", "id_b")), ["id_a", "id_b"], "left_anti")
        smaller = F.when(F.col("_size_a") <= F.col("_size_b"), F.col("_root_a")).otherwise(F.col("_root_b")).alias("_of")
        open_ = cut_lineage(open_.select(*pairs.columns, smaller, (F.col(a) == F.col(b)).alias("_self")))
        left = open_.select(*pairs.columns)
        waiting = left.count()
        if waiting <= ASKED_TOGETHER:
            if waiting or not asked_in:
                asked_in.append(judge(left))
            break
        order = Window.partitionBy("_of").orderBy("_self", F.xxhash64(a, b), a, b)
        chosen = cut_lineage(open_.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= share).select(*pairs.columns))
        judged = cut_lineage(judge(chosen))
        asked_in.append(judged)
        found = judged.where("verdict = 'REAL'").where(F.col(a) != F.col(b)).select(F.col(a).alias("u"), F.col(b).alias("v"))
        links = cut_lineage(members.where("id <> root").select(F.col("id").alias("u"), F.col("root").alias("v")).unionByName(found))
        share *= 2
    return reduce(DataFrame.unionByName, asked_in)


def _placed(pairs: DataFrame, facts: DataFrame, a: str, b: str) -> DataFrame:
    """``pairs`` with the groups (id, root, size) of both ends; an id in none is a group of its own."""
    few = fits_broadcast(facts, ID_ROWS)
    if not few:
        uses = pairs.select(F.explode(F.array(a, b)).alias("id")).groupBy("id").agg(F.count("*").alias("_uses"))
        facts = cut_lineage(facts.join(uses, "id"))
    for side, own in (("a", a), ("b", b)):
        named = facts.withColumnsRenamed({"id": own, "root": f"_root_{side}", "size": f"_size_{side}"})
        pairs = pairs.join(F.broadcast(named), own, "left") if few else join_to_keys(pairs, named, own, "_uses")
        pairs = pairs.withColumns({f"_root_{side}": F.coalesce(f"_root_{side}", F.col(own)), f"_size_{side}": F.coalesce(f"_size_{side}", F.lit(1))})
    return pairs


def _with_groups(plain: DataFrame, vectors: DataFrame, groups: DataFrame) -> DataFrame:
    """The registry with groups and verdicts; both NULL for rows that could not be encoded and are in no group."""
    failed = broadcast_if_small(vectors.where("embedding IS NULL").select(F.col("row_ord").alias("_failed")))
    written = write_back(plain, groups, "row_ord").join(failed, F.col("row_ord") == F.col("_failed"), "left")
    unknown = F.col("_failed").isNotNull() & (F.col("collision_verdict") == "FALSE")
    for column in ("collision_group", "collision_verdict"):
        written = written.withColumn(f"_{column}", F.when(~unknown, F.col(column)))
    return written.select(
        *plain.columns, F.col("_collision_group").alias("collision_group"), F.col("_collision_verdict").alias("collision_verdict")
    )


def collide(
    registry: DataFrame,
    model: Model,
    encode: Encoder,
    template: str,
    universal: DataFrame | None = None,
    known: DataFrame | None = None,
    block_cols: tuple[str, ...] = ("true_type", "sphere_3"),
    threshold: float = PAIR_THRESHOLD,
    universal_threshold: float | None = BOILERPLATE_THRESHOLD,
    catch_all: str | None = CATCH_ALL_LABEL,
    sizes: similar.Sizes = similar.Sizes(),
    every_pair: bool = True,
) -> Collided:
    """Add ``collision_group`` and ``collision_verdict``; also the judged pairs.

    ``known`` (id_a, id_b, verdict) are the pairs judged earlier.  With them, pending rows
    are compared with all rows of their blocks, and pairs in error are judged again; without
    them everything is.  Groups are made of all real pairs.  ``universal`` is (text).  Rows whose
    text could not be encoded stay pending: their group and verdict are NULL.  Unless ``every_pair``, the model is not asked
    about pairs within a group that other pairs have made already: the registry is the same, and ``pairs`` are those asked.
    """
    blocks = [c for c in block_cols if c in registry.columns]
    keyed = registry.withColumn("_block", similar.block_key(blocks)).withColumn("_fresh", F.lit(True))
    if known is not None:
        if "collision_group" in registry.columns:
            keyed = keyed.withColumn("_fresh", stage.is_pending("collision_group"))
        keyed = keyed.join(keyed.where("_fresh").select("_block").distinct(), "_block", "left_semi")
    vectors = embed(keyed, "function_text", encode)
    kept = vectors
    if universal is not None:
        library = embed(universal.select("text").distinct(), "text", encode)
        kept = similar.drop_boilerplate(vectors, library, "row_ord", "embedding", "text", "embedding", universal_threshold, sizes, rounded=False)
    exclude = ("true_type", catch_all) if catch_all and "true_type" in registry.columns else None
    pairs = similar.near_duplicate_pairs(
        kept, "row_ord", "embedding", "executor", blocks, threshold, exclude,
        sizes=sizes, counted=vectors, fresh_col=None if known is None else "_fresh", rounded=False,
    ).select("id_a", "id_b")
    if known is not None:
        settled = known.where("verdict <> 'ERROR'")
        again = known.where("verdict = 'ERROR'").select("id_a", "id_b").distinct()
        # Only known pairs with a pending row can be found again, mostly none.
        pending = cut_lineage(keyed.where("_fresh").select(F.col("row_ord").cast("string").alias("_id")))
        touched = [known.join(pending, F.col(c) == F.col("_id"), "left_semi").select("id_a", "id_b") for c in ("id_a", "id_b")]
        found_again = cut_lineage(touched[0].unionByName(touched[1]).distinct())
        pairs = pairs.join(broadcast_if_small(found_again), ["id_a", "id_b"], "left_anti").unionByName(
            again.join(settled.select("id_a", "id_b"), ["id_a", "id_b"], "left_anti")
        )
    judge = lambda some: _judged(some, registry, model, template).select("id_a", "id_b", "verdict")
    if every_pair:
        judged = judge(pairs)
    else:
        real = None if known is None else settled.where("verdict = 'REAL'").select(F.col("id_a").alias("u"), F.col("id_b").alias("v"))
        judged = _judged_for_groups(pairs, judge, real)
    if known is not None:
        judged = judged.unionByName(settled.select("id_a", "id_b", "verdict"))
    judged = cut_lineage(judged)
    groups = group_pairs(judged.where("verdict = 'REAL'"))
    plain = registry.drop("collision_group", "collision_verdict")
    return Collided(_with_groups(plain, vectors, groups), judged)


@dataclass(frozen=True)
class Grouped:
    registry: DataFrame
    pairs: DataFrame
    members: DataFrame


def collide_classes(
    registry: DataFrame,
    model: Model,
    encode: Encoder,
    template: str,
    universal: DataFrame | None = None,
    block_cols: tuple[str, ...] = ("true_type", "sphere_3"),
    threshold: float = PAIR_THRESHOLD,
    universal_threshold: float | None = BOILERPLATE_THRESHOLD,
    catch_all: str | None = CATCH_ALL_LABEL,
    sizes: similar.Sizes = similar.Sizes(),
    every_pair: bool = True,
) -> Grouped:
    """As ``collide`` from scratch, with one verdict for all copies of a text in a block.

    Rows of a block with equal texts are a class.  The model is asked about one pair of rows for each pair of similar
    classes and for each class of several owners, so its calls follow the texts and not the pairs of copies.
    Where it says so, all rows of both classes are in one group.  ``pairs`` has the representatives with their
    classes, the classes' sizes and the verdict; ``members`` (class, id) the rows of each class.  ``every_pair`` as for ``collide``.
    """
    blocks = [c for c in block_cols if c in registry.columns]
    vectors = cut_lineage(embed(registry, "function_text", encode))
    kept = vectors
    if universal is not None:
        library = embed(universal.select("text").distinct(), "text", encode)
        kept = similar.drop_boilerplate(vectors, library, "row_ord", "embedding", "text", "embedding", universal_threshold, sizes, rounded=False)
    kept = kept.withColumn("_text", F.coalesce("function_text", F.lit("")))
    exclude = ("true_type", catch_all) if catch_all and "true_type" in registry.columns else None
    found = similar.near_duplicate_classes(kept, "row_ord", "embedding", "executor", "_text", blocks, threshold, exclude, sizes=sizes, rounded=False)
    pairs, members = cut_lineage(found.pairs), cut_lineage(found.members)
    judge = lambda some: _judged(some, registry, model, template)
    judged = cut_lineage(judge(pairs) if every_pair else _judged_for_groups(pairs, judge, a="class_a", b="class_b"))
    real = judged.where("verdict = 'REAL'")
    # A class that goes with itself has no link to another one; its members are tied to its name.
    live = real.select(F.explode(F.array("class_a", "class_b")).alias("class")).distinct()
    ties = members.join(broadcast_if_small(cut_lineage(live)), "class", "left_semi").where("class <> id")
    links = real.select("class_a", "class_b").unionByName(ties.select(F.col("class").alias("class_a"), F.col("id").alias("class_b")))
    groups = group_pairs(links, "class_a", "class_b")
    plain = registry.drop("collision_group", "collision_verdict")
    return Grouped(_with_groups(plain, vectors, groups), judged, members)


def report(registry: DataFrame, rules: ReportRules = ReportRules()) -> DataFrame:
    """The lines of all level, group and portrait pages."""
    return (
        reports.level_documents(registry, rules)
        .unionByName(reports.collision_documents(registry, rules))
        .unionByName(reports.portrait_documents(registry, rules))
    )
