"""Queries that ask a model.

The stand-in model answers from a digest of the prompt, so that the answer to every prompt
can be stated in SQL as well.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from lexroll.functions import answers, text
from lexroll.operators import sections as cut
from lexroll.operators.inference import infer, infer_each
from lexroll.operators.labels import resolve_label
from lexroll.plans.catalog import query, table
from lexroll.plans.text_queries import RULES, SECTIONS, sections
from lexroll.plans.vector_queries import PAIRS, pairs_of, vectors
from lexroll.profile import TYPE_LABELS


def digest(prompt: str) -> int:
    return int(hashlib.md5(prompt.encode()).hexdigest()[:7], 16)


DIGEST = "CAST('0x' || substr(md5(prompt), 1, 7) AS BIGINT)"


class Answering:
    """Answers with one of a list, wrapped in prose, chosen by the digest of the prompt."""

    def __init__(self, key: str, choices: list[str]):
        self.key, self.choices = key, choices

    def __call__(self, prompts: list[str]) -> list[str]:
        picked = [self.choices[digest(p) % len(self.choices)] for p in prompts]
        return ["I say: " + json.dumps({self.key: p}, ensure_ascii=False) for p in picked]


def chosen(choices: list[str]) -> str:
    quoted = ", ".join(f"'{c}'" for c in choices)
    return f"([{quoted}])[{DIGEST} % {len(choices)} + 1]"


TYPES = [*TYPE_LABELS, "нечто", ""]


@query(
    f"""WITH p AS (SELECT event_id, 'Choose a type: ' || event_type || ' ' || props AS prompt FROM events), a AS (
  SELECT event_id, {chosen(TYPES)} AS said FROM p)
SELECT event_id, CASE WHEN said IN ({", ".join(f"'{x}'" for x in TYPE_LABELS)}) THEN said ELSE 'НЕОПРЕДЕЛЕНО' END AS true_type,
  'OK' AS status, 1 AS attempts FROM a"""
)
def infer_type(spark: SparkSession, folder: str) -> DataFrame:
    asked = table(spark, folder, "events").select(
        "event_id", F.concat(F.lit("Choose a type: "), "event_type", F.lit(" "), "props").alias("prompt")
    )
    answered = infer(asked, "prompt", Answering("verdict", TYPES))
    return answered.select("event_id", answers.type_verdict(F.col("raw")).alias("true_type"), "status", "attempts")


VERDICTS = ["REAL", "false", "INVALID"]


def is_verdict(answer: str) -> bool:
    return answer is not None and answer.split('"')[-2].upper() in ("REAL", "FALSE")


@query(
    f"""WITH {PAIRS}, p AS (SELECT id_a, id_b, 'Judge ' || id_a || ' and ' || id_b AS prompt FROM pairs), a AS (
  SELECT id_a, id_b, {chosen(VERDICTS)} AS said FROM p)
SELECT id_a, id_b, CASE WHEN said = 'INVALID' THEN 'ERROR' ELSE upper(said) END AS verdict,
  CASE WHEN said = 'INVALID' THEN 'INVALID' ELSE 'OK' END AS status, CASE WHEN said = 'INVALID' THEN 3 ELSE 1 END AS attempts FROM a"""
)
def infer_pair(spark: SparkSession, folder: str) -> DataFrame:
    pairs = pairs_of(vectors(spark, folder)).select("id_a", "id_b")
    prompt = F.concat(F.lit("Judge "), "id_a", F.lit(" and "), "id_b")
    answered = infer_each(pairs, prompt, Answering("verdict", VERDICTS), accept=is_verdict)
    return answered.select("id_a", "id_b", answers.pair_verdict(F.col("raw")).alias("verdict"), "status", "attempts")


NODES = ["17", "brand#3", "NO_MATCH", "7 whatever", "nowhere"]


@query(
    f"""WITH taxonomy AS (
  SELECT min(p_partkey) AS ord, replace(p_brand, 'Brand#', '') || ' ' || p_brand || ' goods' AS name FROM part GROUP BY p_brand), p AS (
  SELECT p_partkey, 'Place ' || p_name || ' ' || p_type AS prompt FROM part), a AS (SELECT p_partkey, {chosen(NODES)} AS said FROM p)
SELECT p_partkey, CASE said WHEN 'NO_MATCH' THEN 'NO_MATCH' WHEN 'nowhere' THEN 'ОШИБКА' WHEN '17' THEN '17 Brand#17 goods'
  WHEN '7 whatever' THEN '7 Brand#7 goods'
  ELSE (SELECT min_by(name, ord) FROM taxonomy WHERE contains(lower(name), 'brand#3')) END AS sphere FROM a"""
)
def infer_node(spark: SparkSession, folder: str) -> DataFrame:
    parts = table(spark, folder, "part")
    full = F.concat(F.replace("p_brand", F.lit("Brand#"), F.lit("")), F.lit(" "), "p_brand", F.lit(" goods"))
    taxonomy = parts.groupBy(full.alias("name")).agg(F.min("p_partkey").alias("ord"))
    asked = parts.select("p_partkey", F.concat(F.lit("Place "), "p_name", F.lit(" "), "p_type").alias("prompt"))
    named = infer(asked, "prompt", Answering("name", NODES)).withColumn("name", answers.json_text(F.col("raw"), "name"))
    return resolve_label(named, "name", taxonomy).select("p_partkey", "sphere")


def first_words(prompts: list[str]) -> list[str]:
    """Names the body by the first line of the section."""
    return ["```json\n" + json.dumps({"full_go_name": p.split("\n")[0].strip()}, ensure_ascii=False) + "\n```" for p in prompts]


@query(f"""WITH {SECTIONS} SELECT doc_id, section_no, arg_min(t, idx) AS full_name FROM sections GROUP BY ALL""")
def infer_name(spark: SparkSession, folder: str) -> DataFrame:
    asked = sections(spark, folder).select(
        "doc_id", F.col("section_no").cast("long").alias("section_no"), cut.context(F.col("paragraphs"), RULES).alias("prompt")
    )
    answered = infer(asked, "prompt", first_words)
    name = text.normalise(answers.json_text(F.col("raw"), "full_go_name", fenced=True))
    return answered.select("doc_id", "section_no", name.alias("full_name"))
