"""Tables from files: by suffix, dimensions with a contract, labelled examples, JSON."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lexroll.functions.text import strip

SEPARATORS = (",", ";", "\t", "|")
ENCODINGS = ("UTF-8", "windows-1251", "ISO-8859-1")
UNDEFINED_BYTE = "\x98"  # has no meaning in windows-1251
UPPER_BYTES = bytes(b for b in range(128, 256) if b != ord(UNDEFINED_BYTE))
CYRILLIC_BYTES = (UPPER_BYTES.decode("latin-1"), UPPER_BYTES.decode("cp1251"))


def _raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with one character per byte, whatever the encoding."""
    reader = spark.read.option("encoding", "ISO-8859-1").option("sep", "\x01").option("quote", "")
    return reader.schema("line string").csv(path)


@dataclass(frozen=True)
class TextFormat:
    """What a reading of a text table's bytes shows."""

    encoding: str
    separator: str
    broken_lines: bool  # a quoted field runs over a line's end


def guess_format(spark: SparkSession, path: str) -> TextFormat:
    """The first encoding that every line can be read in, the separator most frequent in the first line, and
    whether quotes are left open at some line's end.  One scan, and a look at the first line."""
    lines = _raw_lines(spark, path)
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    bad = lines.agg(
        F.count_if(~F.is_valid_utf8(F.encode("line", "ISO-8859-1").cast("string"))).alias("utf8"),
        F.count_if(F.contains("line", F.lit(UNDEFINED_BYTE))).alias("cyrillic"),
        F.count_if(quotes % 2 == 1).alias("open"),
    ).first()
    encoding = ENCODINGS[0] if not bad["utf8"] else ENCODINGS[1] if not bad["cyrillic"] else ENCODINGS[2]
    first = lines.first()
    separator = max(SEPARATORS, key=(first["line"] if first and first["line"] else "").count)
    return TextFormat(encoding, separator, bad["open"] > 0)


def guess_encoding(spark: SparkSession, path: str) -> str:
    return guess_format(spark, path).encoding


def guess_separator(spark: SparkSession, path: str) -> str:
    return guess_format(spark, path).separator


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Read CSV (encoding and separator found out), Parquet or JSON by the suffix.

    CSV fields may be quoted, with quotes doubled and line breaks inside; only a file that has such breaks is
    read in one piece.  JSON may be one object a line or an array; a file that is neither is refused.
    """
    suffix = path.lower().rstrip("/").rsplit(".", 1)[-1]
    if suffix == "parquet":
        return spark.read.parquet(path)
    if suffix == "json":
        first = _raw_lines(spark, path).where(F.trim("line") != "").first()
        whole = first is not None and first["line"].lstrip("\xef\xbb\xbf \t").startswith("[")
        table = spark.read.json(path, multiLine=whole)
        if "_corrupt_record" in table.columns:
            raise ValueError(f"Broken JSON: {path}")
        return table
    if suffix == "csv":
        found = guess_format(spark, path)
        as_bytes = "ISO-8859-1" if found.encoding == "windows-1251" else found.encoding  # Spark's reader lacks the former
        table = spark.read.csv(
            path, header=True, encoding=as_bytes, sep=found.separator, escape='"', multiLine=found.broken_lines
        )
        if found.encoding == "windows-1251":
            names = [c.translate(str.maketrans(*CYRILLIC_BYTES)) for c in table.columns]
            table = table.select(*[F.translate(f"`{c}`", *CYRILLIC_BYTES) for c in table.columns]).toDF(*names)
        return table.toDF(*[c.lstrip("\ufeff") for c in table.columns])
    raise ValueError(f"Unsupported file format: {path}")


def _there(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def load_library(spark: SparkSession, path: str, key: str = "function") -> DataFrame:
    """(text): the universal texts of JSON documents; none if nothing is there."""
    if not _there(spark, path):
        return spark.createDataFrame([], "text string")
    return harvest(spark.read.text(path, wholetext=True), "value", key)


def read_examples(spark: SparkSession, path: str) -> DataFrame:
    """The labelled examples of a file; none if nothing is there, which turns hints off."""
    if not _there(spark, path):
        return spark.createDataFrame([], "ref_text string, ref_label string")
    return load_examples(read_table(spark, path))


def load_dimension(df: DataFrame, required: list[str]) -> DataFrame:
    """All columns as text, NULL as "", with the required columns checked."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {', '.join(missing)}")
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])


def load_examples(df: DataFrame, text_col: str = "function", label_col: str = "TrueType") -> DataFrame:
    """(ref_text, ref_label); empty when one of the columns is missing, which turns hints off."""
    if text_col not in df.columns or label_col not in df.columns:
        return df.sparkSession.createDataFrame([], "ref_text string, ref_label string")
    return df.select(F.col(text_col).alias("ref_text"), F.col(label_col).alias("ref_label"))


SURE_BYTES = 16 * 1024 * 1024  # documents up to here are within the parser's limits
STRING = r'"((?:[^"\\]|\\.)*+)"'


def harvested(document: Column, key: str = "function") -> Column:
    """ARRAY<STRING>: the trimmed text values under ``key`` at any depth of a JSON text.

    Inside a JSON string quotes are escaped, so a quoted key followed by a colon and a
    quoted value is always a member, at whatever depth.  Broken JSON gives no values.  A
    document too large for the parser to tell is refused rather than taken for broken.
    """
    escaped = F.regexp_extract_all(document, F.lit(rf'(?s)"{key}"\s*:\s*{STRING}'), F.lit(1))
    quoted = F.concat(F.lit("["), F.array_join(F.transform(escaped, lambda s: F.concat(F.lit('"'), s, F.lit('"'))), ","), F.lit("]"))
    values = F.transform(F.from_json(quoted, "array<string>"), strip)
    sound = F.try_parse_json(document).isNotNull()
    too_large = ~sound & (F.octet_length(document) > SURE_BYTES)
    return F.when(too_large, F.raise_error(F.lit("JSON document too large to check"))).when(sound, F.filter(values, lambda v: v != "")).otherwise(F.array().cast("array<string>"))


def harvest(df: DataFrame, document_col: str, key: str = "function") -> DataFrame:
    """(text): distinct harvested values of all documents; sort at the sink if need be."""
    return df.select(F.explode(harvested(F.col(document_col), key)).alias("text")).distinct()
