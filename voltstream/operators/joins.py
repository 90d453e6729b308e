"""Join key helpers. Whether a side is broadcast is left to Spark's byte threshold and AQE."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

def any_null(cols: Sequence[str]) -> Column:
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return cond


def all_not_null(cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def null_key_salt(keys: Sequence[str], negative: bool = False, spread_by: Column | None = None) -> Column:
    """0 for rows with a full key; a per-row value for rows with a NULL key part.

    Added to grouping / join keys, it keeps NULL-key rows apart (they never
    merge or match) and spreads them over all partitions. Without
    ``spread_by`` the value is a unique row id (needed when grouping; batch
    only). For joins, where spreading is enough, ``spread_by`` (e.g. a row id
    column) is hashed instead, which is deterministic and works in streams.
    """
    uid = F.monotonically_increasing_id() if spread_by is None else F.xxhash64(spread_by)
    return F.when(any_null(keys), -1 - uid if negative else uid).otherwise(F.lit(0).cast("bigint"))
