"""Key lookups that stay balanced when one key owns a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.session import checkpoint_root

# At most this many keys can each own more than 1/HOT_KEYS of the rows, whatever the data.
HOT_KEYS = 10_000
SPREAD = 1_000


def attach_by_key(rows: DataFrame, stats: DataFrame, key: str, weight: str, spread_by: Column) -> DataFrame:
    """Add the columns of ``stats`` (unique on ``key``) to ``rows``; keys missing there give nulls.

    ``weight`` is a column of ``stats`` that counts the rows of each key. Keys with more than
    1/HOT_KEYS of the total weight are at most HOT_KEYS in number, so that side is broadcast
    with a proven bound. All other keys are small and go through a shuffle join, in which the
    rows of hot keys are spread evenly over partitions by ``spread_by``. The stats are
    checkpointed, because three parts of the plan read them.
    """
    checkpoint_root(stats.sparkSession)
    values = [c for c in stats.columns if c != key]
    stats = stats.checkpoint()
    packed = stats.select(key, F.struct(*values).alias("_stat"), F.col(weight).alias("_weight"))
    total = stats.agg(F.sum(weight)).scalar()
    hot = packed.filter(F.col("_weight") * HOT_KEYS > total).select(key, F.col("_stat").alias("_hot"))
    cold = packed.filter(F.col("_weight") * HOT_KEYS <= total).select(
        key, F.lit(0).alias("_spread"), F.col("_stat").alias("_cold")
    )
    marked = rows.join(F.broadcast(hot), key, "left").withColumn(
        "_spread", F.when(F.col("_hot").isNotNull(), 1 + F.pmod(F.xxhash64(spread_by), F.lit(SPREAD))).otherwise(0)
    )
    joined = marked.join(cold, [key, "_spread"], "left").withColumn("_stat", F.coalesce("_hot", "_cold"))
    return joined.select(*rows.columns, *[F.col(f"_stat.{c}").alias(c) for c in values])
