"""Batched model calls: any Python callable over lists of texts, run inside tasks."""

from __future__ import annotations

import hashlib
import math
import re
import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from lexroll.functions.text import strip
from lexroll.operators.lineage import cut_lineage, fits_broadcast
from lexroll.operators.pair_tiles import PAIR_BYTES, of_pairs
from lexroll.operators.skew import join_to_keys
from lexroll.operators.store import Store
from lexroll.profile import ATTEMPTS, BACKOFF_SECONDS, EMBED_BATCH

Model = Callable[[list[str]], list[str]]
Encoder = Callable[[list[str]], np.ndarray]


class TransientModelError(Exception):
    """Connection, rate and time-out errors: worth waiting for."""


def _ask(model: Model, prompt: str, accept, attempts: int, backoff: float) -> tuple[str | None, str, int]:
    """(answer, status, attempts used) for one prompt."""
    answer, wait = None, backoff
    for attempt in range(1, attempts + 1):
        try:
            answer = model([prompt])[0]
        except TransientModelError:
            if attempt < attempts:
                time.sleep(wait)
                wait *= 2
            continue
        except Exception:  # any other failure ends the attempts for this row only
            return answer, "ERROR", attempt
        if accept is None or accept(answer):
            return answer, "OK", attempt
    return answer, "ERROR" if answer is None else "INVALID", attempts


def _ask_batch(model: Model, prompts: list[str], accept, attempts: int, backoff: float):
    """A whole batch first, again after a transient error; rows it does not settle are asked one by one."""
    answers, wait, used = None, backoff, 0
    for attempt in range(1, attempts + 1):
        used = attempt
        try:
            answers = model(prompts)
            if len(answers) != len(prompts):
                raise ValueError("one answer per prompt expected")
            break
        except TransientModelError:
            answers = None
            if attempt < attempts:
                time.sleep(wait)
                wait *= 2
        except Exception:  # a row of the batch may be at fault
            return [_ask(model, p, accept, max(1, attempts - attempt + 1), backoff) for p in prompts]
    if answers is None:
        return [(None, "ERROR", used)] * len(prompts)
    settled = []
    for prompt, answer in zip(prompts, answers):
        if accept is None or accept(answer):
            settled.append((answer, "OK", used))
        elif attempts > used:
            again, status, more = _ask(model, prompt, accept, attempts - used, backoff)
            settled.append((answer if again is None else again, status, used + more))
        else:
            settled.append((answer, "INVALID", used))
    return settled


def infer(
    df: DataFrame,
    prompt_col: str,
    model: Model,
    accept: Callable[[str], bool] | None = None,
    attempts: int = ATTEMPTS,
    backoff: float = BACKOFF_SECONDS,
    batch: int = EMBED_BATCH,
    partitions: int | None = None,
    store: Store | None = None,
) -> DataFrame:
    """Add ``raw``, ``status`` and ``attempts``.

    Equal prompts are asked once, however many rows have them.  Transient errors wait, doubling; an answer that
    ``accept`` refuses is asked for again at once; any other error marks its row only.
    The answers are written down at once, so no later step asks the model again.  With a ``store``, prompts answered in
    earlier runs are not asked, good answers are added to it, and ``asked_in`` tells the run of each.
    """
    keyed = df.withColumn("_key", F.sha2(F.coalesce(prompt_col, F.lit("")), 256))
    asked = keyed.groupBy("_key").agg(F.first(F.coalesce(prompt_col, F.lit(""))).alias("prompt"), F.count("*").alias("_rows"))
    if partitions:
        asked = asked.repartition(partitions, "_key")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), batch):
                part = frame.iloc[at : at + batch]
                said = _ask_batch(model, part["prompt"].tolist(), accept, attempts, backoff)
                yield pd.DataFrame(
                    {"_key": part["_key"].to_numpy(), "_rows": part["_rows"].to_numpy(), "raw": [s[0] for s in said],
                     "status": [s[1] for s in said], "attempts": [s[2] for s in said]}
                )

    answer = lambda new: cut_lineage(new.mapInPandas(run, "_key string, _rows long, raw string, status string, attempts int"))
    answers = answer(asked) if store is None else store.through(asked, answer, "raw string, status string, attempts int", "status = 'OK'")
    return join_to_keys(keyed, answers, "_key", "_rows").drop("_key")


TASK_PROMPTS = 20_000  # that a task asks


def infer_each(
    df: DataFrame,
    prompt: Column,
    model: Model,
    accept: Callable[[str], bool] | None = None,
    attempts: int = ATTEMPTS,
    backoff: float = BACKOFF_SECONDS,
    batch: int = EMBED_BATCH,
    task_prompts: int = TASK_PROMPTS,
) -> DataFrame:
    """``infer`` for rows whose prompts mostly differ; ``prompt`` is no column of the result.

    The rows are made once and written.  Prompts are counted by their hashes alone; a row with a hash of its own is asked with
    its row, so that neither prompts nor answers are grouped, sorted or joined.  Rows that share a hash go through ``infer``,
    and so do all rows if such hashes are many.
    """
    text = F.coalesce(prompt, F.lit(""))
    rows = cut_lineage(df)
    marked = rows.withColumn("_mark", F.xxhash64(text))
    again = cut_lineage(marked.groupBy("_mark").agg(F.count("*").alias("_n")).where("_n > 1").select("_mark"))
    asked_once = lambda part: infer(part.withColumn("_prompt", text), "_prompt", model, accept, attempts, backoff, batch).select(
        *df.columns, "raw", "status", "attempts"
    )
    if not fits_broadcast(again):
        return asked_once(rows)

    def ask(prompts: pa.Array) -> pa.Array:
        texts, said = prompts.to_pylist(), []
        for at in range(0, len(texts), batch):
            said += _ask_batch(model, texts[at : at + batch], accept, attempts, backoff)
        kinds = (pa.string(), pa.string(), pa.int32())
        parts = [pa.array([s[i] for s in said], kind) for i, kind in enumerate(kinds)]
        return pa.StructArray.from_arrays(parts, names=["raw", "status", "attempts"])

    said = F.arrow_udf(ask, "raw string, status string, attempts int")(text)
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows.count() / task_prompts))
    alone = marked.join(F.broadcast(again), "_mark", "left_anti").repartition(tasks, "_mark")
    answered = cut_lineage(alone.withColumn("_said", said).select(*df.columns, "_said.*"))
    if again.isEmpty():
        return answered
    return answered.unionByName(asked_once(marked.join(F.broadcast(again), "_mark", "left_semi")))


def infer_pairs(
    pairs: DataFrame,
    records: DataFrame,
    model: Model,
    prompt: Callable[[str, str], str],
    accept: Callable[[str], bool] | None = None,
    attempts: int = ATTEMPTS,
    backoff: float = BACKOFF_SECONDS,
    batch: int = EMBED_BATCH,
    bucket_bytes: int = PAIR_BYTES,
    tile_pairs: int | None = None,
) -> DataFrame:
    """``infer`` for prompts of two records: ``pairs`` (id_a, id_b, ...) with raw, status and attempts.

    A prompt exists only where it is asked, so that no text is moved or written once a pair, and answers leave with their pair
    (``pair_tiles.of_pairs``; ``records`` is (id, record), perhaps with a block).  Pairs of equal records are asked once.
    """
    pairs = cut_lineage(pairs)
    names = pairs.columns

    def each(records: dict[int, pa.StringScalar]):
        said, last, first = (None, "ERROR", 0), None, (None, "")

        def ask(asked: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            nonlocal said, last, first
            keys = list(zip(asked.column("rep_a").to_pylist(), asked.column("rep_b").to_pylist()))
            answers, told, waiting = [said], [], []
            for key in keys:
                if key != last:
                    if key[0] != first[0]:
                        first = key[0], records[key[0]].as_py()
                    waiting.append(prompt(first[1], records[key[1]].as_py()))
                    last = key
                    if len(waiting) == batch:
                        answers += _ask_batch(model, waiting, accept, attempts, backoff)
                        waiting = []
                told.append(len(answers) + len(waiting) - 1)
            if waiting:
                answers += _ask_batch(model, waiting, accept, attempts, backoff)
            said = answers[-1]
            of_row = [answers[i] for i in told]
            kinds = (pa.string(), pa.string(), pa.int32())
            columns = [asked.column(c) for c in names] + [pa.array([x[i] for x in of_row], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "raw", "status", "attempts"])

        return ask

    said = [StructField(name, kind) for name, kind in (("raw", StringType()), ("status", StringType()), ("attempts", IntegerType()))]
    schema = StructType([*pairs.schema.fields, *said])
    return cut_lineage(of_pairs(pairs, records, each, schema, bucket_bytes, tile_pairs))


def embed(
    df: DataFrame,
    text_col: str,
    encode: Encoder,
    out: str = "embedding",
    batch: int = EMBED_BATCH,
    attempts: int = ATTEMPTS,
    wait: float = 1.0,
    partitions: int | None = None,
    store: Store | None = None,
) -> DataFrame:
    """Add the embedding of a text; equal texts are encoded once, with a ``store`` once in all runs.

    Blank and missing texts are encoded as a single blank.  A text that cannot be encoded
    gets NULL, which later operators leave out, and not a vector of zeros.
    """
    text = F.coalesce(F.when(strip(F.col(text_col)) != "", F.col(text_col)), F.lit(" "))
    keyed = df.withColumn("_key", F.sha2(text, 256))
    texts = keyed.groupBy("_key").agg(F.first(text).alias("text"), F.count("*").alias("_rows"))
    if partitions:
        texts = texts.repartition(partitions, "_key")

    def encoded(values: list[str]) -> list:
        for attempt in range(attempts):
            try:
                return list(np.asarray(encode(values), dtype=np.float32))
            except TransientModelError:
                if attempt + 1 < attempts:
                    time.sleep(wait)
            except Exception:
                break
        if len(values) == 1:
            return [None]
        return [vector for value in values for vector in encoded([value])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for at in range(0, rows.num_rows, batch):
                part = rows.slice(at, batch)
                vectors = encoded(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("_key"), part.column("_rows"), pa.array(vectors, pa.list_(pa.float32()))],
                    names=["_key", "_rows", out],
                )

    encode_all = lambda new: cut_lineage(new.mapInArrow(run, f"_key string, _rows long, {out} array<float>"))
    vectors = encode_all(texts) if store is None else store.through(texts, encode_all, f"{out} array<float>", f"{out} IS NOT NULL")
    return join_to_keys(keyed, vectors, "_key", "_rows").drop("_key")


class HashedWords:
    """Encoder that needs no model: counts of words in hashed buckets, at length one.

    The buckets of the words seen are kept while a task runs.
    """

    def __init__(self, size: int = 64):
        self.size = size
        self.buckets: dict[str, int] = {}

    def bucket(self, word: str) -> int:
        known = self.buckets.get(word)
        if known is None:
            known = int(hashlib.md5(word.encode()).hexdigest()[:7], 16) % self.size
            self.buckets[word] = known
        return known

    def __call__(self, texts: list[str]) -> np.ndarray:
        counts = np.zeros((len(texts), self.size))
        for i, text in enumerate(texts):
            places = [self.bucket(w) for w in re.split(r"\s+", text.lower()) if w]
            if places:
                counts[i] = np.bincount(places, minlength=self.size)
        length = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
        return counts / np.where(length == 0, 1.0, length)
