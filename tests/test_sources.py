import io
import zipfile

import pytest
from pyspark.sql import functions as F

from lexroll.operators import reports
from lexroll.sources import documents, sinks, tables
from lexroll.streaming.arrivals import take_arrivals

W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"


def office_file(body):
    holder = io.BytesIO()
    with zipfile.ZipFile(holder, "w") as archive:
        archive.writestr("word/document.xml", f'<w:document xmlns:w="{W}"><w:body>{body}</w:body></w:document>')
    return holder.getvalue()


def test_scan(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name in ("doc1.docx", "doc2.pdf", "file.DOC", "file.Doc", "sub/doc4.docx", "~$temp.docx", "~backup.docx", ".hidden.docx", "notes.txt"):
        (tmp_path / name).write_bytes(b"x")
    found = documents.scan_documents(spark, str(tmp_path))
    assert sorted(r["name"] for r in found.collect()) == ["doc1.docx", "doc4.docx", "file.DOC", "file.Doc"]


def test_office_paragraphs(spark, tmp_path):
    body = (
        "<w:p><w:r><w:t>Глава</w:t></w:r><w:r><w:tab/><w:t>1</w:t><w:br/></w:r></w:p><w:p/>"
        "<w:tbl><w:tr><w:tc><w:p><w:r><w:t>in a table</w:t></w:r></w:p></w:tc></w:tr></w:tbl>"
        "<w:p><w:hyperlink><w:r><w:t>link</w:t></w:r></w:hyperlink></w:p>"
    )
    (tmp_path / "a.docx").write_bytes(office_file(body))
    (tmp_path / "b.docx").write_bytes(b"broken")
    found = documents.office_paragraphs(documents.scan_documents(spark, str(tmp_path))).orderBy("path").collect()
    assert [(r["paragraphs"], r["status"]) for r in found] == [(["Глава\t1\n", "", "link"], "OK"), ([], "UNREADABLE")]


@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig", "cp1251", "latin-1"])
@pytest.mark.parametrize("separator", [",", ";", "\t", "|"])
def test_read_table(spark, tmp_path, encoding, separator):
    word = "\x98é" if encoding == "latin-1" else "слово"
    path = tmp_path / "t.csv"
    path.write_bytes(separator.join(["ид", "текст"] if encoding != "latin-1" else ["id", "text"]).encode(encoding) + b"\n" + separator.join(["1", word]).encode(encoding if encoding != "utf-8-sig" else "utf-8") + b"\n")
    table = tables.read_table(spark, str(path))
    assert len(table.columns) == 2 and tuple(table.first()) == ("1", word)
    assert table.columns[0] in ("ид", "id")


def test_other_tables(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t.parquet"))
    assert tables.read_table(spark, str(tmp_path / "t.parquet")).count() == 3
    (tmp_path / "t.json").write_text('{"a": 1}\n{"a": 2}\n')
    assert tables.read_table(spark, str(tmp_path / "t.json")).count() == 2
    with pytest.raises(ValueError, match="Unsupported"):
        tables.read_table(spark, "t.odt")


def test_dimension_and_examples(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert [tuple(r) for r in tables.load_dimension(df, ["a"]).collect()] == [("1", ""), ("2", "x")]
    with pytest.raises(ValueError, match="Missing required columns: c, d"):
        tables.load_dimension(df, ["a", "c", "d"])
    assert tables.load_examples(df).count() == 0
    full = spark.createDataFrame([("t", "l")], "function string, TrueType string")
    assert tuple(tables.load_examples(full).first()) == ("t", "l")


@pytest.mark.parametrize(
    "document, found",
    [
        ('{"function": " a ", "x": [{"function": "b"}, {"y": {"function": "a"}}]}', {"a", "b"}),
        ('{"function": 1, "x": {"function": null}, "z": {"function": ["q"]}}', set()),
        ('{"function": {"function": "deep"}}', {"deep"}),
        (r'{"function": "say \"hi\" б\n"}', {'say "hi" б'}),
        ('{"x": "\\"function\\": \\"no\\"", "function": ""}', set()),
        ('{"function": "a"', set()),
        ("", set()),
        (None, set()),
    ],
)
def test_harvest(spark, document, found):
    df = spark.createDataFrame([(document,)], "doc string")
    assert {r["text"] for r in tables.harvest(df, "doc").collect()} == found


REPORT = "function_id string, function_text string, executor string, level string, true_type string, sphere string, sphere_2 string, collision_group string, collision_verdict string, row_ord long"


def test_pages(spark, tmp_path):
    rows = [
        ("GO-1", " Text 1 ", "Agency (A)", "1", "Стратегические", "01.1 S", "01.1 Сфера", "NO_COLLISION", "FALSE", 0),
        ("GO-2", None, "Agency (A)", "1", None, "01.1 S", None, "COLLISION_1", "REAL", 1),
        ("GO-3", "t3", "B", "9", "Общие", None, "", None, None, 2),
        ("GO-4", "t4", None, "1", "Общие", None, "", "COLLISION_1", "REAL", 3),
    ]
    df = spark.createDataFrame(rows, REPORT)
    lines = (
        reports.level_documents(df).unionByName(reports.collision_documents(df)).unionByName(reports.portrait_documents(df))
    )
    sinks.write_documents(lines, str(tmp_path / "out"))
    pages = {}
    for folder in sorted((tmp_path / "out").glob("doc_name=*")):
        pages[folder.name.split("=")[1]] = "".join(p.read_text() for p in sorted(folder.glob("part-*")))
    assert set(pages) == {"level_1_functions.md", "level_9_functions.md", "collision_COLLISION_1.md", "portrait_Agency_A.md", "portrait_B.md"}
    assert pages["level_1_functions.md"] == (
        "# Функции уровня 1\n#Центральные_аппараты\n\n## Содержание\n\n- [Agency (A)](#Agency_A)\n\n"
        '## Agency (A)\n<a name="Agency_A"></a>\n\n### Функции\n\n'
        "- ⚙️ **GO-1** (Тип: Стратегические | Сфера (ур. 2): 1 Сфера)\n\n```\nText 1\n```\n\n- ⚙️ **GO-2**\n"
    )
    assert "#Уровень_9" in pages["level_9_functions.md"]
    assert pages["collision_COLLISION_1.md"] == (
        "# Группа коллизий: COLLISION_1\n\n## Функции в группе\n\n"
        "### GO-2\n**Исполнитель:** Agency (A)\n**Вердикт:** REAL\n\n```\nТекст функции отсутствует\n```\n\n"
        "### GO-4\n**Исполнитель:** \n**Вердикт:** REAL\n\n```\nt4\n```\n\n"
    )
    assert pages["portrait_Agency_A.md"] == (
        "# Портрет исполнителя: Agency (A)\n\n## Общая статистика\n\n**Общее количество функций:** 2\n**Функций с коллизиями:** 1\n\n"
        "### Распределение по типам функций\n\n| Тип | Количество | Доля |\n|-----|------------|------|\n|  | 1 | 50.0% |\n| Стратегические | 1 | 50.0% |\n\n"
        "### Распределение по сферам\n\n| Сфера | Количество | Доля |\n|-------|------------|------|\n| 01.1 S | 2 | 100.0% |\n\n## Список функций\n\n"
        "### ⚙️ GO-1\n**Детали:** Тип: Стратегические | Сфера (ур. 2): 1 Сфера\n\n```\nText 1\n```\n\n"
        "### ⚙️ GO-2\n**Детали:** Коллизия: COLLISION_1\n\n```\nТекст функции отсутствует\n```\n\n"
    )


def test_arrivals_are_taken_once(spark, tmp_path):
    folder, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    text = "Положение о комитете\nГлава 1\nФункции\n1) a;\n2) b"
    for batch in (1, 2):
        spark.createDataFrame([(batch, text)], "doc_id long, text string").write.mode("append").parquet(folder)
        take_arrivals(spark, folder, out, log).awaitTermination()
        rows = sorted((r["doc_id"], tuple(r["items"]), r["status"]) for r in spark.read.parquet(out).collect())
        assert rows == [(n, ("a", "b"), "OK") for n in range(1, batch + 1)]


def test_quoted_csv(spark, tmp_path):
    path = tmp_path / "q.csv"
    path.write_text('name;note\n"He said ""hi""; twice";2\n"two\nlines";3\nplain;"4"\n', encoding="utf-8")
    rows = [tuple(r) for r in tables.read_table(spark, str(path)).collect()]
    assert rows == [('He said "hi"; twice', "2"), ("two\nlines", "3"), ("plain", "4")]


def test_json_arrays_and_broken_json(spark, tmp_path):
    (tmp_path / "a.json").write_text('\n [{"function": "f", "TrueType": "t"},\n {"function": "g", "TrueType": "u"}]', encoding="utf-8")
    found = tables.read_examples(spark, str(tmp_path / "a.json"))
    assert sorted(tuple(r) for r in found.collect()) == [("f", "t"), ("g", "u")]
    (tmp_path / "b.json").write_text('{"function": "f"}\n{"function": "g"}\n', encoding="utf-8")
    assert tables.read_table(spark, str(tmp_path / "b.json")).count() == 2
    (tmp_path / "c.json").write_text('{"function": \n oops', encoding="utf-8")
    with pytest.raises(ValueError, match="Broken"):
        tables.read_table(spark, str(tmp_path / "c.json"))


def test_missing_files_give_nothing(spark, tmp_path):
    assert tables.read_examples(spark, str(tmp_path / "no.json")).count() == 0
    assert tables.load_library(spark, str(tmp_path / "no.json")).count() == 0
    (tmp_path / "lib.json").write_text('{"a": [{"function": " x "}, {"b": {"function": "y"}}]}', encoding="utf-8")
    assert sorted(r["text"] for r in tables.load_library(spark, str(tmp_path / "lib.json")).collect()) == ["x", "y"]


def test_a_document_too_large_to_tell_is_refused(spark, monkeypatch):
    broken = spark.createDataFrame([('{"function": "x"',)], "doc string")
    assert tables.harvest(broken, "doc").count() == 0
    monkeypatch.setattr(tables, "SURE_BYTES", 4)
    with pytest.raises(Exception, match="too large"):
        tables.harvest(broken, "doc").collect()
    sound = spark.createDataFrame([('{"function": "x"}',)], "doc string")
    assert [r["text"] for r in tables.harvest(sound, "doc").collect()] == ["x"]
