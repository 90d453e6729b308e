"""As-of pairing of two event kinds per key, split by time buckets.

For every *right* row (e.g. a stop) find the latest *left* row (e.g. a start)
with the same key and ``left_time <= right_time`` — an inner as-of join.

A key may hold a large share of all rows, so no step groups a whole key into
one task:

1. Within-bucket pass: rows are windowed per (key, time bucket); the bucket
   width bounds what one window partition holds. The same pass yields each
   bucket's latest left row.
2. Carry-in: one summary row per (key, bucket), aggregated on the window's
   partitioning (no second shuffle of the rows). A window over these bucket
   summaries per key — at most one row per bucket, so bounded by time span /
   width, not by data volume — gives each bucket the latest left row of all
   earlier buckets.
3. A right row without an earlier left row in its bucket takes the carry-in.

Only equi-joins on (key, bucket) are used; nothing emits all pairs. Ties on
time: a left row at exactly the right row's time counts as earlier, and among
left rows with equal time the greatest ``left_order`` wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_pair(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    left_order: str,
    bucket_seconds: int = 3600,
) -> DataFrame:
    """Inner as-of join: each right row with the columns of its latest earlier left row.

    ``left`` and ``right`` must not share column names other than ``keys``;
    the two time columns must have the same type. Rows with a NULL key or
    time never pair (as in an equi-join).
    """
    keys = list(keys)
    lcols = [c for c in left.columns if c not in keys]
    rcols = [c for c in right.columns if c not in keys]

    def usable(df: DataFrame, time_col: str) -> DataFrame:
        cond = F.col(time_col).isNotNull()
        for k in keys:
            cond = cond & F.col(k).isNotNull()
        return df.filter(cond)

    def bucket(time_col: str):
        micros = F.unix_micros(F.col(time_col).cast("timestamp"))
        return F.floor(micros / F.lit(bucket_seconds * 1_000_000)).cast("bigint").alias("_b")

    lf, rf = usable(left, left_time), usable(right, right_time)
    l_type = lf.select(F.struct(*lcols)).schema[0].dataType
    r_type = rf.select(F.struct(*rcols)).schema[0].dataType
    o_type = lf.schema[left_order].dataType

    lrows = lf.select(
        *keys,
        bucket(left_time),
        # side 0 sorts before a right row (side 1) at the same time
        F.struct(F.col(left_time).alias("t"), F.lit(0).alias("side"), F.col(left_order).alias("o")).alias("_ord"),
        F.struct(*lcols).alias("_l"),
        F.lit(None).cast(r_type).alias("_r"),
    )
    rrows = rf.select(
        *keys,
        bucket(right_time),
        F.struct(F.col(right_time).alias("t"), F.lit(1).alias("side"), F.lit(None).cast(o_type).alias("o")).alias("_ord"),
        F.lit(None).cast(l_type).alias("_l"),
        F.struct(*rcols).alias("_r"),
    )
    both = lrows.unionByName(rrows)

    # 1. one window pass per (key, bucket): the latest left row up to each row,
    #    and the bucket's latest left row overall (same partitioning and order,
    #    so one shuffle of the full rows serves both)
    w = Window.partitionBy(*keys, "_b").orderBy("_ord")
    scanned = both.withColumns({
        "_in": F.last("_l", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "_bl": F.last("_l", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    })
    within = scanned.filter(F.col("_r").isNotNull()).drop("_bl")

    # 2. one summary row per (key, bucket) — grouped on the window's own
    #    partitioning, so no further shuffle of the full rows — then the latest
    #    left row of all earlier buckets, per key (bounded by span / width)
    summary = scanned.groupBy(*keys, "_b").agg(
        F.first("_bl", ignorenulls=True).alias("_bl"),
        F.max(F.col("_r").isNotNull()).alias("_has_right"),
    )
    wk = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    summary = (
        summary.withColumn("_prev", F.last("_bl", ignorenulls=True).over(wk))
        # only buckets with right rows need their carry-in; this also makes both
        # branches read the same columns, so they share one shuffle of the rows
        .filter(F.col("_has_right"))
        .select(*keys, "_b", "_prev")
    )

    # 3. in-bucket match, else the carry-in
    out = within.join(summary, [*keys, "_b"], "left").withColumn("_m", F.coalesce("_in", "_prev"))
    out = out.filter(F.col("_m").isNotNull())
    return out.select(*keys, *[F.col(f"_m.{c}").alias(c) for c in lcols], *[F.col(f"_r.{c}").alias(c) for c in rcols])
