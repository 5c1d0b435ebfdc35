"""Statistics and report pages.

A page is a table of lines with a sort key, not one value: however many functions a body
has, no task holds a whole page.  ``LINE_ORDER`` puts the lines of all pages in order.
Input columns: function_id, function_text, executor, level, true_type, sphere, sphere_2,
collision_group, collision_verdict and row_ord, the input order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lexroll.functions.text import percent, safe_name, strip, without_code
from lexroll.profile import NO_COLLISION, ReportRules

LINE_ORDER = ["doc_name", "owner", "part", "key", "row_ord", "line_no"]
FENCE = "```"


def _filled(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("")) != ""


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def in_collision() -> Column:
    """The group is named and is not the no-collision mark; a missing group is none."""
    return _filled("collision_group") & (F.col("collision_group") != NO_COLLISION)


def portrait_totals(df: DataFrame) -> DataFrame:
    """(executor, total, collisions)."""
    return df.where(_filled("executor")).groupBy("executor").agg(
        F.count("*").alias("total"), F.count_if(in_collision()).alias("collisions")
    )


def portrait_share(df: DataFrame, column: str, totals: DataFrame | None = None) -> DataFrame:
    """(executor, column, n, share): rows per value and their percentage, to one decimal."""
    totals = portrait_totals(df) if totals is None else totals
    counts = df.where(_filled("executor")).groupBy("executor", _text(column).alias(column)).agg(F.count("*").alias("n"))
    return _shares(counts, column, totals)


def _shares(counts: DataFrame, column: str, totals: DataFrame) -> DataFrame:
    return counts.join(totals, "executor").select("executor", column, "n", percent(F.col("n"), F.col("total")).alias("share"))


def run_metrics(sections: DataFrame, doc_col: str) -> DataFrame:
    """(doc, sections, functions) per document: sections used and items taken."""
    return sections.groupBy(doc_col).agg(
        F.count_if(F.col("status") == "OK").alias("sections"),
        F.sum(F.when(F.col("status") == "OK", F.size("items")).otherwise(0)).alias("functions"),
    )


def _lines(
    df: DataFrame,
    doc: Column,
    owner: Column,
    part: int,
    lines: Column,
    key: Column | None = None,
    row: Column | None = None,
) -> DataFrame:
    head = df.select(
        doc.alias("doc_name"),
        owner.alias("owner"),
        F.lit(part).alias("part"),
        (F.lit("") if key is None else key).alias("key"),
        (F.lit(-1) if row is None else row).cast("long").alias("row_ord"),
        lines.alias("_lines"),
    )
    return head.select(*LINE_ORDER[:-1], F.posexplode("_lines").alias("line_no", "line"))


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _array(*lines: Column | str) -> Column:
    return F.array(*[F.lit(x) if isinstance(x, str) else x for x in lines])


def _details(rules: ReportRules, with_group: bool) -> Column:
    parts = [
        F.when(_filled("true_type"), F.concat(F.lit(rules.type_word), F.col("true_type"))),
        F.when(_filled("sphere_2"), F.concat(F.lit(rules.sphere_word), without_code(F.col("sphere_2")))),
    ]
    if with_group:
        parts.append(F.when(in_collision(), F.concat(F.lit(rules.collision_word), F.col("collision_group"))))
    return F.concat_ws(" | ", *parts)


def _fenced_or(rules: ReportRules) -> Column:
    return F.when(_filled("function_text"), strip(_text("function_text"))).otherwise(rules.no_text)


def level_documents(df: DataFrame, rules: ReportRules = ReportRules()) -> DataFrame:
    """One page per level: contents, then each executor with its functions."""
    rows = df.where(_filled("executor") & _filled("level"))
    level, executor = F.col("level"), F.col("executor")
    doc, owner = F.concat(F.lit("level_"), level, F.lit("_functions.md")), level
    tags = F.create_map(*[F.lit(x) for pair in rules.tags.items() for x in pair])
    tag = F.coalesce(F.try_element_at(tags, level), F.concat(F.lit(rules.tag_fallback), level))
    executors = rows.select("level", "executor").distinct()
    levels = executors.select("level").distinct()
    anchor = safe_name(executor)
    details = _details(rules, with_group=False)
    entry = F.concat(
        F.lit(f"- {rules.bullet} **"), _text("function_id"), F.lit("**"),
        F.when(details != "", F.concat(F.lit(" ("), details, F.lit(")"))).otherwise(""),
    )
    body = F.concat(
        F.array(entry),
        F.when(_filled("function_text"), _array("", FENCE, strip(_text("function_text")), FENCE, "")).otherwise(
            F.array().cast("array<string>")
        ),
    )
    return _all(
        [
            _lines(levels, doc, owner, 0, _array(F.concat(F.lit(rules.level_title), level), tag, "", rules.contents, "")),
            _lines(executors, doc, owner, 1, _array(F.concat(F.lit("- ["), executor, F.lit("](#"), anchor, F.lit(")"))), executor),
            _lines(levels, doc, owner, 2, _array("")),
            _lines(
                executors, doc, owner, 3,
                _array(
                    F.concat(F.lit("## "), executor), F.concat(F.lit('<a name="'), anchor, F.lit('"></a>')),
                    "", rules.functions, "",
                ),
                executor,
            ),
            _lines(rows, doc, owner, 3, body, executor, F.col("row_ord")),
        ]
    )


def collision_documents(df: DataFrame, rules: ReportRules = ReportRules()) -> DataFrame:
    """One page per collision group."""
    rows = df.where(in_collision())
    group = F.col("collision_group")
    doc = F.concat(F.lit("collision_"), safe_name(group), F.lit(".md"))
    body = _array(
        F.concat(F.lit("### "), _text("function_id")),
        F.concat(F.lit(rules.executor_word), _text("executor")),
        F.concat(F.lit(rules.verdict_word), _text("collision_verdict")),
        "", FENCE, _fenced_or(rules), FENCE, "",
    )
    return _all(
        [
            _lines(
                rows.select("collision_group").distinct(), doc, group, 0,
                _array(F.concat(F.lit(rules.group_title), group), "", rules.group_items, ""),
            ),
            _lines(rows, doc, group, 1, body, row=F.col("row_ord")),
        ]
    )


def portrait_documents(df: DataFrame, rules: ReportRules = ReportRules()) -> DataFrame:
    """One page per executor: totals, shares by type and sphere, and all functions."""
    rows = df.where(_filled("executor"))
    executor = F.col("executor")
    doc = F.concat(F.lit("portrait_"), safe_name(executor), F.lit(".md"))
    # One aggregate of the rows, from which totals and shares follow; Spark reuses its exchange.
    counts = rows.groupBy("executor", _text("true_type").alias("true_type"), _text("sphere").alias("sphere")).agg(
        F.count("*").alias("n"), F.count_if(in_collision()).alias("hits")
    )
    totals = counts.groupBy("executor").agg(F.sum("n").alias("total"), F.sum("hits").alias("collisions"))

    def table(part: int, column: str) -> DataFrame:
        share = F.format_string("%.1f%%", F.col("share"))
        line = F.concat(F.lit("| "), F.col(column), F.lit(" | "), F.col("n").cast("string"), F.lit(" | "), share, F.lit(" |"))
        shares = _shares(counts.groupBy("executor", column).agg(F.sum("n").alias("n")), column, totals)
        return _lines(shares, doc, executor, part, F.array(line), F.col(column))

    details = _details(rules, with_group=True)
    body = _array(
        F.concat(F.lit(f"### {rules.bullet} "), _text("function_id")),
        F.when(details != "", F.concat(F.lit(rules.details_word), details)).otherwise(""),
        "", FENCE, _fenced_or(rules), FENCE, "",
    )
    head = _array(
        F.concat(F.lit(rules.portrait_title), executor), "", rules.statistics, "",
        F.concat(F.lit(rules.total_word), F.col("total").cast("string")),
        F.concat(F.lit(rules.collisions_word), F.col("collisions").cast("string")),
        "", rules.types_title, "", *rules.types_head,
    )
    return _all(
        [
            _lines(totals, doc, executor, 0, head),
            table(1, "true_type"),
            _lines(totals, doc, executor, 2, _array("", rules.spheres_title, "", *rules.spheres_head)),
            table(3, "sphere"),
            _lines(totals, doc, executor, 4, _array("", rules.list_title, "")),
            _lines(rows, doc, executor, 5, body, row=F.col("row_ord")),
        ]
    )
