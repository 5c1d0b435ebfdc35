import re
import random

from pyspark.sql import functions as F

from lexroll.operators import sections as cut
from lexroll.profile import SectionRules


def items_of(spark, paragraphs):
    df = spark.createDataFrame([(1, paragraphs)], "doc int, paragraphs array<string>")
    row = cut.with_items(df).first()
    return row["items"], row["status"]


def test_items(spark):
    assert items_of(spark, ["7. Функции:", "Function 1", "Function 2", "Глава 2", "Should not include this"]) == (
        ["Function 1", "Function 2"], "OK",
    )
    assert items_of(spark, ["Some intro text", "7. Функции:", "", "8. Права"]) == (["8. Права"], "OK")
    assert items_of(spark, ["Some text", "other"]) == ([], "HEADER_NOT_FOUND")
    assert items_of(spark, ["Функции", "  ", ";"]) == ([], "NO_ITEMS_FOUND")
    assert items_of(spark, ["Раздел 1", "Функции комитета", "1) a;", "Функции:", "2) b,", "раздел 2", "c"]) == (["a", "b"], "OK")
    assert items_of(spark, []) == ([], "HEADER_NOT_FOUND")
    assert items_of(spark, ["Функции департамента :", "x"]) == (["x"], "OK")


def test_sections_look_ahead(spark):
    filler = [""] * 11
    near = ["x", "Положение о комитете", *filler, "Глава 1", "a"]
    far = ["Положение о комитете", *filler, "", "Глава 1"]
    about = ["Положение об агентстве", "Глава 1"]
    same = ["Положение  о центре. Глава 1", "b", "Положение о фонде", "глава 1."]
    df = spark.createDataFrame([(1, near), (2, far), (3, about), (4, same), (5, []), (6, None)], "doc int, paragraphs array<string>")
    rows = cut.with_sections(df, "paragraphs").orderBy("doc", "section_no").collect()
    assert [(r["doc"], r["section_no"], r["start"]) for r in rows] == [(1, 1, 1), (4, 1, 0), (4, 2, 2)]
    assert rows[0]["paragraphs"] == near[1:]
    assert rows[1]["paragraphs"] == same[:2]
    assert rows[2]["paragraphs"] == same[2:]


def test_sections_against_a_plain_loop(spark):
    draw = random.Random(5)
    words = ["a", "anchor", "confirm", "anchor confirm", "", "end"]
    docs = [(i, [draw.choice(words) for _ in range(draw.randrange(0, 60))]) for i in range(60)]
    rules = SectionRules(anchor=r"\banchor\b", confirm=r"\bconfirm\b", lookahead=3)
    df = spark.createDataFrame(docs, "doc int, paragraphs array<string>")
    found = {(r["doc"], r["section_no"]): r["paragraphs"] for r in cut.with_sections(df, "paragraphs", rules).collect()}
    expected = {}
    for doc, lines in docs:
        starts = [
            i for i, x in enumerate(lines)
            if re.search("anchor", x) and any("confirm" in y for y in lines[i : i + 4])
        ]
        for n, (a, b) in enumerate(zip(starts, [*starts[1:], len(lines)]), 1):
            expected[doc, n] = lines[a:b]
    assert found == expected


def test_context_and_acceptance(spark):
    df = spark.createDataFrame([([" a ", "", "b "] + ["x"] * 200,)], "p array<string>")
    context = df.select(cut.context(F.col("p")).alias("c")).first()["c"]
    assert context.split("\n")[:3] == ["a", "", "b"] and len(context.split("\n")) == 150
    judged = spark.createDataFrame(
        [("n", "m", "OK"), (None, "m", "OK"), ("n", " ", "OK"), ("n", "m", "NO_ITEMS_FOUND")], "full_name string, main string, status string"
    )
    good, bad = cut.accept(judged)
    assert good.count() == 1
    assert sorted(r["reason"] for r in bad.collect()) == ["MAIN_NOT_FOUND", "NAME_NOT_FOUND", "NO_ITEMS_FOUND"]
