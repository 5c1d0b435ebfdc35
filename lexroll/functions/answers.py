"""Column expressions that read and judge model answers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lexroll.functions.text import capitalise, let, strip
from lexroll.profile import LabelRules

FENCE = r"(?s)```(?:json)?\s*(\{.*\})\s*```"
OBJECT = r"(?s)\{.*\}"


def json_part(answer: Column) -> Column:
    """The fenced object if there is one, then from the first "{" to the last "}"."""

    def part(inner: Column) -> Column:
        return let(F.regexp_extract(inner, OBJECT, 0), lambda o: F.when(o != "", o).otherwise(inner))

    inner = let(F.regexp_extract(answer, FENCE, 1), lambda o: F.when(o != "", o).otherwise(strip(answer)))
    return let(inner, part)


def json_text(answer: Column, key: str, fenced: bool = False) -> Column:
    """String value under ``key`` of the object in an answer, else NULL.

    NULL stands for no object, broken JSON, no such key and a value that is no string.
    """
    body = json_part(answer) if fenced else F.regexp_extract(answer, OBJECT, 0)
    value = F.try_variant_get(F.try_parse_json(body), f"$.{key}", "variant")
    return let(value, lambda v: F.when(F.schema_of_variant(v) == "STRING", v.cast("string")))


def type_verdict(answer: Column, key: str = "verdict", rules: LabelRules = LabelRules()) -> Column:
    """The answer's label if it belongs to the set, else the undefined mark."""
    said = strip(json_text(answer, key))
    label = let(said, capitalise)
    return let(label, lambda x: F.when(x.isin(*rules.labels), x).otherwise(F.lit(rules.undefined)))


def pair_verdict(answer: Column, key: str = "verdict") -> Column:
    """REAL or FALSE, whatever the case; anything else is ERROR."""
    said = F.upper(json_text(answer, key))
    return let(said, lambda x: F.when(x.isin("REAL", "FALSE"), x).otherwise(F.lit("ERROR")))
