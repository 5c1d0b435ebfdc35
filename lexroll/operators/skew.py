"""Joins on keys that may hold any share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lexroll.operators.lineage import BROADCAST_ROWS, fits_broadcast, rows_up_to

HOT_ROWS = 1_000_000


def join_to_keys(rows: DataFrame, facts: DataFrame, key: str, size: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left join ``rows`` to ``facts``, one row for each key, where a key may hold any share of ``rows``.

    ``facts[size]`` is the number of rows of a key.  Small facts are broadcast after a check of their size.
    Otherwise keys of over ``hot_rows`` rows, few whatever the input (rows / hot_rows at most), are broadcast
    after a count, so their rows stay where they are; rows without a key stay too; and the other keys meet
    in a shuffle, no partition of which can hold a hot one.
    """
    if fits_broadcast(facts):
        return rows.join(F.broadcast(facts.drop(size)), key, "left")
    hot = facts.where(F.col(size) > hot_rows).drop(size)
    cold = facts.where(F.col(size) <= hot_rows).drop(size)
    if rows_up_to(hot, BROADCAST_ROWS) is None:
        raise ValueError("too many hot keys: raise hot_rows")
    keys = F.broadcast(hot.select(key))
    meet = rows.where(F.col(key).isNotNull())
    return (
        meet.join(keys, key, "left_anti").join(cold, key, "left")
        .unionByName(meet.join(F.broadcast(hot), key))
        .unionByName(rows.where(F.col(key).isNull()), allowMissingColumns=True)
    )
