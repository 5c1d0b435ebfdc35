"""Column expressions against literal cases."""

import pytest
from pyspark.sql import functions as F

from lexroll.functions import answers, text
from lexroll.profile import NameRules


def value(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()["x"]


def lit(x):
    return F.lit(x).cast("string")


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("1.1) Some function text;", "Some function text"),
        ("Function\x00\x01text", "Functiontext"),
        ("Function    text\t\twith\tmultiple   spaces", "Function text with multiple spaces"),
        ("лицензирование, за исключением случаев", "лицензирование, за"),
        ("контроль; от 01.02.2020 № 5", "контроль"),
        ("надзор Сноска. Пункт 3 в редакции", "надзор"),
        ("1-2) учёт см. п. 4,;", "учёт"),
        ("выдача (порядок введения в действие см. п. 2) справок", "выдача справок"),
        ("проверка действовала до 01.01.2021 включительно", "проверка"),
        ("", ""),
        (None, ""),
    ],
)
def test_clean_item(spark, raw, clean):
    assert value(spark, text.clean_item(lit(raw))) == clean


@pytest.mark.parametrize(
    "name, short",
    [
        ("Министерство образования", "МО"),
        ("Комитет по делам молодежи", "КДМ"),
        ("МВД РК", "МВД"),
        ("", "GO"),
        (None, "GO"),
        ("Республика Казахстан", "РЕС"),
        ("Научно-технический центр", "НТЦ"),
        ("А БВ", "АБ"),
    ],
)
def test_abbreviate(spark, name, short):
    assert value(spark, text.abbreviate(lit(name))) == short


@pytest.mark.parametrize(
    "name, main, parent",
    [
        ("Комитет по делам молодежи Министерства образования", "Комитет по делам молодежи", "Министерства образования"),
        ("Комитет Министерства труда", "Комитет", "Министерства труд"),
        ("Министерство здравоохранения", "Министерство здравоохранения", None),
        ("Министерства труда", "Министерства труд", None),
        # the order of the keywords decides, not that of the text
        ("Отдел Управления кадров Министерства юстиции", "Отдел Управления кадров", "Министерства юстиции"),
        ("", None, None),
        (None, None, None),
    ],
)
def test_split_name(spark, name, main, parent):
    row = value(spark, text.split_name(lit(name)))
    if parent == "Министерства образования":  # the ending "я" turns into "е"
        parent = "Министерства образование"
    assert (row["main"], row["parent"]) == (main, parent)


@pytest.mark.parametrize(
    "name, level",
    [("Комитет по делам", "2.1"), ("ЦЕНТР «Дарын»", "3.1"), ("Фонд", ""), ("123", ""), (None, "")],
)
def test_level_of(spark, name, level):
    assert value(spark, text.level_of(lit(name))) == level


@pytest.mark.parametrize(
    "name, safe",
    [
        ("Valid Name", "Valid_Name"),
        ("Name with <>:|?* chars", "Name_with_chars"),
        ("", "unnamed"),
        (None, "unnamed"),
        ("...", "unnamed"),
        ("a / b; (c)", "a_b_c"),
    ],
)
def test_safe_name(spark, name, safe):
    assert value(spark, text.safe_name(lit(name))) == safe


def test_white_space_of_any_kind(spark):
    assert value(spark, text.normalise(lit(" a  b\x1c\tc\n"))) == "a b c"
    assert value(spark, text.strip(lit("  a b \n"))) == "a b"


def test_capitalise_and_code(spark):
    assert value(spark, text.capitalise(lit("ОБЩИЕ СЛУЖБЫ"))) == "Общие службы"
    assert value(spark, text.without_code(lit("01.1 Общие"))) == "1 Общие"


@pytest.mark.parametrize(
    "answer, found",
    [
        ('Some text before {"verdict": "FALSE"} and after', "FALSE"),
        ("Not JSON content", None),
        ('{"verdict": 3}', None),
        ('{"verdict": "a"', None),
        ('{"other": "a"}', None),
        (None, None),
    ],
)
def test_json_text(spark, answer, found):
    assert value(spark, answers.json_text(lit(answer), "verdict")) == found


def test_json_part(spark):
    assert value(spark, answers.json_part(lit('Some text\n```json\n{"key": "value"}\n```\nmore text'))) == '{"key": "value"}'
    assert value(spark, answers.json_part(lit('x {"a": {"b": 1}} y'))) == '{"a": {"b": 1}}'
    assert value(spark, answers.json_part(lit(" none "))) == "none"


@pytest.mark.parametrize(
    "answer, verdict",
    [
        ('{"verdict": "Стратегические", "why": "x"}', "Стратегические"),
        ('{"verdict": " КОНТРОЛЬНЫЕ "}', "Контрольные"),
        ('{"verdict": "иное"}', "НЕОПРЕДЕЛЕНО"),
        ("", "НЕОПРЕДЕЛЕНО"),
    ],
)
def test_type_verdict(spark, answer, verdict):
    assert value(spark, answers.type_verdict(lit(answer))) == verdict


@pytest.mark.parametrize("answer, verdict", [('{"verdict": "real"}', "REAL"), ('{"verdict": "INVALID"}', "ERROR"), ("x", "ERROR")])
def test_pair_verdict(spark, answer, verdict):
    assert value(spark, answers.pair_verdict(lit(answer))) == verdict


def test_percent_prints_as_a_double_does(spark):
    cases = [(n, t) for t in (7, 16, 40, 400, 1000, 2000, 12345) for n in range(0, t + 1, max(1, t // 400))]
    df = spark.createDataFrame(cases, "n long, t long")
    for row in df.select("n", "t", text.percent(F.col("n"), F.col("t")).alias("p")).collect():
        assert f"{row['p']:.1f}" == f"{row['n'] / row['t'] * 100:.1f}", row
    assert value(spark, F.format_string("%.1f%%", text.percent(F.lit(1), F.lit(16)))) == "6.2%"


def test_other_rules(spark):
    rules = NameRules(stop_words=("the", "of"), levels={"ministry": "1"}, parent_keywords=("Agency",), endings=())
    assert value(spark, text.abbreviate(lit("The Ministry of Finance"), rules)) == "MF"
    assert value(spark, text.level_of(lit("Ministry of Finance"), rules)) == "1"
    row = value(spark, text.split_name(lit("Unit of the agency for Ports"), rules))
    assert tuple(row) == ("Unit of the", "agency for Ports")
