"""Latest-wins de-duplication by key.

``groupBy(keys).agg(max_by(struct(row), struct(order)))`` is aggregated
partially on the map side, so a key holding a large share of the rows is
collapsed to one row per task before the shuffle (no window that would pull
a hot key into one task). Rows with a NULL key part are never merged (they
never match in an upsert either): they get a per-row salt in the grouping
key, so they stay in the same single pass, each as its own group, and spread
over all tasks instead of hashing into one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltstream.operators.joins import all_not_null, null_key_salt


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per non-NULL key (the greatest ``order`` tuple); NULL-key rows all kept.

    ``order`` should end in a unique column so the winner is deterministic.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    return (
        df.withColumn("_nk", null_key_salt(keys))
        .groupBy(*keys, "_nk")
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_w"))
        .select(*keys, *[F.col(f"_w.{c}").alias(c) for c in rest])
        .select(*df.columns)
    )


def earliest_by_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str] | None = None
) -> DataFrame:
    """One row per non-NULL key: ``keys`` + ``values`` (default: all other columns)
    of the row with the smallest ``order`` tuple. Order columns not listed in
    ``values`` are not carried through the shuffle."""
    keys = list(keys)
    rest = list(values) if values is not None else [c for c in df.columns if c not in keys]
    return (
        df.filter(all_not_null(keys))
        .groupBy(*keys)
        .agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_w"))
        .select(*keys, *[F.col(f"_w.{c}").alias(c) for c in rest])
    )
