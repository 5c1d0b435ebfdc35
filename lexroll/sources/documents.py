"""Document folders and office files."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

OFFICE_SUFFIXES = (".docx", ".doc")
HIDDEN_PREFIXES = ("~", ".")


def scan_documents(spark: SparkSession, folder: str, suffixes: tuple[str, ...] = OFFICE_SUFFIXES) -> DataFrame:
    """Files below ``folder`` with a listed suffix in any case, no temporary or hidden ones.

    (path, name, length, modificationTime, content); ``content`` is read only if used.
    Spark's own listing also leaves out names that start with "_".
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    wanted = F.lit(False)
    for suffix in suffixes:
        wanted = wanted | F.endswith(F.lower("name"), F.lit(suffix.lower()))
    for prefix in HIDDEN_PREFIXES:
        wanted = wanted & ~F.startswith(F.col("name"), F.lit(prefix))
    return files.withColumn("name", name).where(wanted).select("path", "name", "length", "modificationTime", "content")


W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
MARKS = {"tab": "\t", "br": "\n", "cr": "\n", "noBreakHyphen": "-"}


def _office_paragraphs(content: bytes) -> list[str]:
    """Texts of the paragraphs that stand directly in the body, blank ones kept."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        body = ElementTree.fromstring(archive.read("word/document.xml")).find(f"{W}body")
    texts = []
    for paragraph in body.findall(f"{W}p"):
        pieces = []
        for child in paragraph:
            runs = [child] if child.tag == f"{W}r" else child.findall(f"{W}r") if child.tag == f"{W}hyperlink" else []
            pieces += [part for run in runs for part in run]
        texts.append("".join(p.text or "" if p.tag == f"{W}t" else MARKS.get(p.tag.removeprefix(W), "") for p in pieces))
    return texts


def office_paragraphs(files: DataFrame, id_col: str = "path") -> DataFrame:
    """(id, paragraphs, status) from (id, content); a broken file is marked and passed over."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for content in frame["content"]:
                try:
                    out.append((_office_paragraphs(content), "OK"))
                except Exception:
                    out.append(([], "UNREADABLE"))
            yield pd.DataFrame({id_col: frame[id_col], "paragraphs": [x[0] for x in out], "status": [x[1] for x in out]})

    kind = files.schema[id_col].dataType.simpleString()
    return files.select(id_col, "content").mapInPandas(read, f"{id_col} {kind}, paragraphs array<string>, status string")
