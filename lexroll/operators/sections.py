"""Sections and items of ordered paragraphs.

A document is one row, so its paragraphs are handled as an array inside that row: looking
ahead, opening sections and capturing blocks need no shuffle and no window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexroll.functions.text import clean_item, normalise, strip
from lexroll.profile import CleanRules, SectionRules


def paragraphs_of(text: Column) -> Column:
    """ARRAY<STRING> of the lines of a text, blank ones kept."""
    return F.split(text, "\n", -1)


def paragraph_rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, para_idx, text), counting from 0."""
    return df.select(id_col, F.posexplode(paragraphs_of(F.col(text_col))).alias("para_idx", "text"))


def with_sections(df: DataFrame, paragraphs_col: str, rules: SectionRules = SectionRules()) -> DataFrame:
    """One row per section: ``section_no`` from 1, ``start`` position and ``paragraphs``.

    A section opens where a paragraph matches the anchor and the confirmation follows within
    the look-ahead, itself included; it runs to the next opening.  What comes before the
    first one is left out.
    """
    anchor, confirm = rules.flags + rules.anchor, rules.flags + rules.confirm
    # Each line is normalised and marked once; an anchor then looks at the marks ahead of it only.
    marked = df.withColumn("_lines", F.transform(paragraphs_col, normalise)).withColumn(
        "_anchors", F.filter(F.transform("_lines", lambda p, i: F.when(p.rlike(anchor), i)), lambda i: i.isNotNull())
    )
    marked = marked.withColumn(
        "_confirms",
        F.when(F.size("_anchors") > 0, F.transform("_lines", lambda p: p.rlike(confirm))).otherwise(F.array().cast("array<boolean>")),
    )
    ahead = F.lit(rules.lookahead + 1)
    opened = marked.withColumn(
        "_starts", F.filter("_anchors", lambda a: F.array_contains(F.slice("_confirms", a + 1, ahead), True))
    )
    ends = F.concat(F.slice("_starts", 2, F.greatest(F.size("_starts"), F.lit(1))), F.array(F.size(paragraphs_col)))
    sections = F.transform(
        F.col("_starts"),
        lambda s, k: F.struct(
            (k + 1).alias("section_no"),
            s.alias("start"),
            F.slice(F.col(paragraphs_col), s + 1, F.get(F.col("_ends"), k) - s).alias("paragraphs"),
        ),
    )
    rest = [c for c in df.columns if c != paragraphs_col]
    return opened.drop("_lines").withColumn("_ends", ends).select(*rest, F.inline(sections))


def section_rows(sections: DataFrame, id_col: str) -> DataFrame:
    """(id, section_no, para_idx, text) of the paragraphs of all sections."""
    return sections.select(
        id_col, "section_no", "start", F.posexplode("paragraphs").alias("_at", "text")
    ).select(id_col, "section_no", (F.col("start") + F.col("_at")).alias("para_idx"), "text")


def context(paragraphs: Column, rules: SectionRules = SectionRules()) -> Column:
    """The head of a section as one text, for asking the model who the body is."""
    return F.array_join(F.transform(F.slice(paragraphs, 1, rules.context), strip), "\n", "")


def with_items(
    sections: DataFrame, rules: SectionRules = SectionRules(), cleaning: CleanRules = CleanRules()
) -> DataFrame:
    """Add ``items``, an array of cleaned texts, and ``status``.

    Items stand after the first header and before the first terminator that follows it;
    further headers and blank paragraphs are passed over.
    """
    header, terminator = rules.flags + rules.header, rules.flags + rules.terminator
    head = F.array_position(F.transform("_lines", lambda x: (x != "") & x.rlike(header)), True)
    tail = F.slice("_lines", F.col("_head") + 1, F.size("_lines") - F.col("_head"))
    stop = F.array_position(F.transform("_tail", lambda x: (x != "") & x.rlike(terminator)), True)
    length = F.when(F.col("_stop") > 0, F.col("_stop") - 1).otherwise(F.size("_tail"))
    block = F.filter(F.slice("_tail", F.lit(1), length), lambda x: (x != "") & ~x.rlike(header))
    cleaned = F.filter(F.transform(block, lambda x: clean_item(x, cleaning)), lambda x: x != "")
    return (
        sections.withColumn("_lines", F.transform("paragraphs", normalise))
        .withColumn("_head", head.cast("int"))
        .withColumn("_tail", F.when(F.col("_head") > 0, tail).otherwise(F.array().cast("array<string>")))
        .withColumn("_stop", stop.cast("int"))
        .withColumn("items", cleaned)
        .withColumn(
            "status",
            F.when(F.col("_head") == 0, "HEADER_NOT_FOUND")
            .when(F.size("items") == 0, "NO_ITEMS_FOUND")
            .otherwise("OK"),
        )
        .drop("_lines", "_head", "_tail", "_stop")
    )


def item_rows(sections: DataFrame, keep: list[str]) -> DataFrame:
    """(keep…, item_no, item), counting from 1."""
    return sections.select(*keep, F.posexplode("items").alias("_at", "item")).select(
        *keep, (F.col("_at") + 1).alias("item_no"), "item"
    )


def accept(sections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sections that have a name, a main body and items; and the others with a reason."""
    reason = (
        F.when(F.coalesce(strip(F.col("full_name")), F.lit("")) == "", "NAME_NOT_FOUND")
        .when(F.coalesce(strip(F.col("main")), F.lit("")) == "", "MAIN_NOT_FOUND")
        .when(F.col("status") != "OK", F.col("status"))
    )
    judged = sections.withColumn("reason", reason)
    return judged.where("reason IS NULL").drop("reason"), judged.where("reason IS NOT NULL")
