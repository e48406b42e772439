"""User-based collaborative filtering with a weighted Pearson correlation.

pc(u, t) = min(s / 50, 1) * sum(du * dt) / (sqrt(sum du^2) * sqrt(sum dt^2))

over the s items both rated, where du, dt are deviations from each user's mean
over *all* of that user's ratings. pc is 0 when nothing is shared, when either
user gave one rating value only, or when the ratio is 0/0.

The one-against-all comparison is a left join on item with the target's ratings
(not a cross join) and one aggregate per user; users sharing nothing get pc = 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.functions.numeric import out, safe_ratio, significance_weight, stable
from affinity.session import materialize

# Neighbourhood size and length of the top-n list.
NEIGHBOURS = 30
TOP_N = 10


def target_rows(ratings: DataFrame, target: int, written: bool = True) -> DataFrame:
    """(item_id, rating) of the target, written once to the shared folder.

    Several steps read it (deviations, mean, the anti join of estimates), and
    a written table has a real size, so the planner broadcasts it when it is
    small and shuffle-joins it when the target rated very many items.
    """
    rows = ratings.where(F.col("user_id") == F.lit(target)).select("item_id", "rating")
    return materialize(rows, "target_ratings") if written else rows


def correlations(ratings: DataFrame, target: int, mine_rows: DataFrame | None = None) -> DataFrame:
    """(user_id, mean, pc, pc_raw) for every user except ``target``; pc rounded to 12 digits.

    One aggregate per user holds all that the formula needs: the count, sum and
    range of the user's ratings, and of the ratings shared with the target the
    count, sums, squares and products; deviations from the means follow by
    algebra. What is left of a square sum by rounding counts as 0.
    """
    own = target_rows(ratings, target) if mine_rows is None else mine_rows
    # The target's mean, NULL if it gave one rating value only (no correlation then).
    t_mean = own.agg(F.when(F.min("rating") != F.max("rating"), F.avg("rating"))).scalar()
    r, t = F.col("rating").cast("double"), F.col("_t").cast("double")
    both = F.col("_t").isNotNull()
    mine = own.select("item_id", F.col("rating").alias("_t"))
    sums = (ratings.where(F.col("user_id") != F.lit(target)).join(mine, "item_id", "left")
            .groupBy("user_id").agg(
                F.avg("rating").alias("mean"), (F.min("rating") == F.max("rating")).alias("flat"),
                F.count("_t").alias("s"), F.sum(F.when(both, r)).alias("r1"), F.sum(F.when(both, r * r)).alias("r2"),
                F.sum(t).alias("t1"), F.sum(t * t).alias("t2"), F.sum(r * t).alias("rt"))
            .withColumn("tm", t_mean))
    s, mean, tm = F.col("s"), F.col("mean"), F.col("tm")

    def spread_of(squares: str, total: str, middle) -> Column:
        left = F.col(squares) - 2 * middle * F.col(total) + s * middle * middle
        return F.when(left > F.col(squares) * F.lit(1e-13), left).otherwise(F.lit(0.0))

    num = F.col("rt") - mean * F.col("t1") - tm * F.col("r1") + s * mean * tm
    raw = safe_ratio(significance_weight("s") * num,
                     F.sqrt(spread_of("r2", "r1", mean)) * F.sqrt(spread_of("t2", "t1", tm)))
    pc = F.when(F.col("flat") | tm.isNull() | (s == 0), F.lit(0.0)).otherwise(F.coalesce(raw, F.lit(0.0)))
    return sums.select("user_id", "mean", stable(pc).alias("pc"), pc.alias("pc_raw"))


def neighbours(ratings: DataFrame, target: int, k: int = NEIGHBOURS,
               mine_rows: DataFrame | None = None) -> DataFrame:
    """Top-k users by pc DESC, user_id ASC: (rank, user_id, mean, pc, pc_raw).

    ORDER BY + LIMIT becomes a TakeOrderedAndProject: each task keeps its own
    top k, so only k rows per task reach the final merge.
    """
    top = (correlations(ratings, target, mine_rows)
           .orderBy(F.desc("pc"), F.asc("user_id")).limit(k))
    # Number the k rows in a second, bounded step (k rows in one window).
    w = Window.orderBy(F.desc("pc"), F.asc("user_id"))
    return top.select(F.row_number().over(w).cast("bigint").alias("rank"), "user_id", "mean",
                      "pc", "pc_raw")


def estimates(ratings: DataFrame, target: int, k: int = NEIGHBOURS,
              nb: DataFrame | None = None, mine_rows: DataFrame | None = None) -> DataFrame:
    """(item_id, estimate) for items the neighbours rated and the target did not.

    estimate = mean_t + sum((r - mean_u) * pc) / sum(|pc|); NULL when every
    weight is 0. ``nb`` (from ``neighbours``) and ``mine_rows`` (from
    ``target_rows``) may be passed in when the caller already has them.
    """
    own = target_rows(ratings, target) if mine_rows is None else mine_rows
    nb = (neighbours(ratings, target, k, own) if nb is None else nb).select("user_id", "mean", "pc")
    t_mean = own.agg(F.avg("rating")).scalar()
    mine = own.select("item_id")
    # nb holds at most k rows: a broadcast of proven size.
    marks = (ratings.join(F.broadcast(nb), "user_id")
             .join(mine, "item_id", "left_anti")
             .select("item_id", "pc",
                     ((F.col("rating") - F.col("mean")) * F.col("pc")).alias("mark")))
    return marks.groupBy("item_id").agg(
        (t_mean + safe_ratio(F.sum("mark"), F.sum(F.abs("pc")))).alias("estimate"))


def top_n(est: DataFrame, n: int = TOP_N, id_col: str = "item_id") -> DataFrame:
    """(rank, item_id, estimate): best non-NULL estimates, ties by id."""
    keep = est.where(F.col("estimate").isNotNull()).withColumn("_o", stable("estimate"))
    top = keep.orderBy(F.desc("_o"), F.asc(id_col)).limit(n)
    w = Window.orderBy(F.desc("_o"), F.asc(id_col))
    return top.select(F.row_number().over(w).cast("bigint").alias("rank"), F.col(id_col),
                      out("estimate").alias("estimate"))
