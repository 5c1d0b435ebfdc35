"""Helpers shared by the operators of this package."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, _parse_datatype_string

# Rows of one Arrow batch: with whole texts in it, a batch of the default 10 000 could outgrow a Python worker.
BATCH_ROWS = 512

WORD = re.compile("[^ \t-\r]+")
# Marks, digits and Latin letters that Python and the tokenizers' libraries class and fold alike.
PLAIN_LETTERS = "!-~¡«»¿À-ÖØ-öø-įı-ɏ‘’“”–—…"
PLAIN = re.compile(f"[{PLAIN_LETTERS}]*")


class Kept(dict):
    """A function's values by their keys, worked out when first asked for; at most ``most`` of them, and none of a long key."""

    def __init__(self, function: Callable[[str], Any], most: int, long: int = 64) -> None:
        super().__init__()
        self.function, self.most, self.long = function, most, long

    def __missing__(self, key: str) -> Any:
        value = self.function(key)
        if len(key) <= self.long:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value


def text_batches(spark: SparkSession) -> None:
    """Let no Arrow batch of this session hold more than ``BATCH_ROWS`` texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    held = int(spark.conf.get(key))
    if held <= 0 or held > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def per_text(function: Callable[[str | None], Any], returns: DataType | str) -> Callable[[Column], Column]:
    """A column function that applies ``function`` to each text of an Arrow batch, one text in memory at a time."""

    def column(text: Column) -> Column:
        spark_kind = _parse_datatype_string(returns) if isinstance(returns, str) else returns
        kind = to_arrow_type(spark_kind)

        def batch(texts: pa.Array) -> pa.Array:
            return pa.array((function(t.as_py()) for t in texts), type=kind)

        return F.arrow_udf(batch, spark_kind)(text)

    return column


def mark_to_join(mark: Column) -> Column:
    """A mark that a function has made and that is never null, as one that rows are joined by.

    Spark puts a filter against nulls before a join.  It would work the function out there once more, in a second
    Python worker of the same task, unless the column can't be null.
    """
    return F.coalesce(mark, F.lit(0).cast("long"))


def per_texts(
    function: Callable[[list[str | None]], list], returns: DataType | str, letters: int = 1 << 18
) -> Callable[[Column], Column]:
    """The same for a function of several texts at once: those of about ``letters`` letters together, or a longer one."""

    def column(text: Column) -> Column:
        spark_kind = _parse_datatype_string(returns) if isinstance(returns, str) else returns
        kind = to_arrow_type(spark_kind)

        def results(texts: pa.Array) -> Iterator[Any]:
            held, volume = [], 0
            for text in texts:
                held.append(text.as_py())
                volume += len(held[-1] or "")
                if volume >= letters:
                    yield from function(held)
                    held, volume = [], 0
            if held:
                yield from function(held)

        def batch(texts: pa.Array) -> pa.Array:
            found = pa.array(results(texts), type=kind)
            pa.default_memory_pool().release_unused()  # what earlier batches and stages of this worker have left
            return found

        return F.arrow_udf(batch, spark_kind)(text)

    return column


def share(spark: SparkSession, thing: Any) -> Broadcast:
    """``thing``'s parts, sent to each executor once; a Python worker keeps what they remember between its tasks."""
    return spark.sparkContext.broadcast(dict(thing.__dict__))


def shared(kind: type, parts: Broadcast) -> Any:
    """The thing of ``kind`` whose parts were shared.  The class comes with the task, the parts stay in the worker."""
    thing = object.__new__(kind)
    thing.__dict__ = parts.value
    return thing
