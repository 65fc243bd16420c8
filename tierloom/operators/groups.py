"""Sizes of groups, whatever share of all rows one of them holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Groups that may be hot: the largest so many. Any other has at most one in so many of all rows.
HOT = 1024


def with_group_size(rows: DataFrame, key: str, name: str) -> DataFrame:
    """`rows` with the number of rows of their key; null is a key like any other.

    Sizes are partial sums. The largest groups (`HOT` of them) meet their size by broadcast; in the join that the others
    need, rows of large groups are dealt out over made-up keys, so that no key gathers more than a thousandth of all.
    """
    own, salt, hot_n, rest_n = "_group_key", "_group_join", "_group_hot", "_group_rest"
    keyed = rows.withColumn(own, F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("")))
    sizes = keyed.groupBy(own).agg(F.count("*").alias("_n"))
    hot = F.broadcast(sizes.orderBy(F.desc("_n"), own).limit(HOT).withColumnRenamed("_n", hot_n))
    rest = sizes.where("_n > 0").select(F.col(own).alias(salt), F.col("_n").alias(rest_n))
    met = keyed.join(hot, own, "left")
    made_up = F.concat(F.lit("#"), F.pmod(F.monotonically_increasing_id(), F.lit(HOT * 8)).cast("string"))
    met = met.withColumn(salt, F.when(F.col(hot_n).isNull(), F.col(own)).otherwise(made_up)).join(rest, salt, "left")
    return met.select(*[F.col(f"`{c}`") for c in rows.columns], F.coalesce(hot_n, rest_n).alias(name))
