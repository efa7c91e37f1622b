"""Stratified train and test parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from usagelens.operators.rank_select import running_counts

# Hex digits of the hash that each step narrows by, 4,096 buckets a step. After four steps a bucket
# has 1 of 2.8e14 rows, so what is left to rank in one task stays small for any table.
DIGITS, STEPS = 3, 4


def stratified_split(
    df: DataFrame, label: str, key: str, test: float = 0.3, seed: int = 42, exact: bool = True
) -> DataFrame:
    """Add ``is_test``, true for the share ``test`` of every label.

    Rows are ordered by a hash of the unique ``key`` and ``seed``, so the split does not
    depend on partitioning. ``exact`` puts ``round(test * n)`` rows of each label into the
    test part: counting by longer and longer hash prefixes locates the last such row of each
    label, and every other row is only compared with it. ``df`` is read several times and should be
    stored. Otherwise each row is decided by
    its hash alone.
    """
    digest = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    if not exact:
        share = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
        return df.withColumn("is_test", share < test)

    place = F.struct(digest.alias("digest"), F.col(key).alias("key"))
    ordered = df.select(label, place.alias("_place"))
    wanted = None
    for step in range(STEPS):
        prefix = F.substring(F.col("_place.digest"), 1, DIGITS * (step + 1))
        rows = ordered.select(label, prefix.alias("_bucket"), *([] if wanted is None else ["_want"]))
        by = [label] if wanted is None else [label, "_want"]
        counted = rows.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
        placed = running_counts(counted, [label], "_bucket")
        wanted = F.floor(F.col("_group_rows") * F.lit(float(test)) + 0.5) if wanted is None else F.col("_want")
        border = placed.filter((F.col("_before") < wanted) & (wanted <= F.col("_before") + F.col("_rows"))).select(
            label, "_bucket", (wanted - F.col("_before")).alias("_want"))
        narrowed = ordered.select(label, "_place", prefix.alias("_bucket")).join(border, [label, "_bucket"])
        ordered = narrowed.select(label, "_place", "_want")
    in_bucket = W.partitionBy(label).orderBy("_place")
    last = (
        ordered.withColumn("_rank", F.row_number().over(in_bucket))
        .filter(F.col("_rank") == F.col("_want"))
        .select(label, F.col("_place").alias("_last"))
    )
    is_test = F.coalesce(place <= F.col("_last"), F.lit(False))
    return df.join(last, label, "left").select(*df.columns, is_test.alias("is_test"))
