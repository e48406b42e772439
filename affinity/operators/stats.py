"""Statistics over rating tables and merged click edges.

Ratings are ``(user_id, item_id, rating)``; merged edges are
``(item1, catalog1, rating1, item2, catalog2, rating2, click)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.functions.numeric import out
from affinity.operators.skew import distinct_rows, order_statistics
from affinity.session import materialize


# -- ratings ------------------------------------------------------------------

def density(ratings: DataFrame) -> DataFrame:
    """Unrounded density statistics: ratings per user, per item, and filled share."""
    n = F.count("rating")
    users = F.count_distinct("user_id")
    items = F.count_distinct("item_id")
    return ratings.agg(
        (n / users).alias("average_user_ratings"),
        (n / items).alias("average_film_ratings"),
        (n / (users * items)).alias("completeness"))


def rating_density(ratings: DataFrame) -> DataFrame:
    """One row: average_user_ratings, average_film_ratings, completeness."""
    d = density(ratings)
    return d.select(*[out(c).alias(c) for c in d.columns])


def global_mean(ratings: DataFrame) -> DataFrame:
    """One row: avg_rating."""
    return ratings.agg(out(F.avg("rating")).alias("avg_rating"))


def user_means(ratings: DataFrame) -> DataFrame:
    """(user_id, avg_rating) for every user."""
    return ratings.groupBy("user_id").agg(out(F.avg("rating")).alias("avg_rating"))


def target_ratings(ratings: DataFrame, target: int) -> DataFrame:
    """(item_id, rating) of one user; the filter reaches the scan."""
    return ratings.where(F.col("user_id") == F.lit(target)).select("item_id", "rating")


def unwatched_items(ratings: DataFrame, target: int) -> DataFrame:
    """(item_id) of every rated item the target has not rated (anti join)."""
    all_items = ratings.select("item_id").distinct()
    mine = target_ratings(ratings, target).select("item_id")
    return all_items.join(mine, "item_id", "left_anti")


# -- items --------------------------------------------------------------------

def parents_with_siblings(items: DataFrame, min_children: int = 3) -> DataFrame:
    """(parent_id, n_items) for parents with more than ``min_children`` items.

    Counting ``parent_id`` (not rows) in the HAVING makes the NULL parent drop
    out, as in the source query.
    """
    return (items.groupBy("parent_id")
            .agg(F.count(F.lit(1)).alias("n_items"), F.count("parent_id").alias("_np"))
            .where(F.col("_np") > min_children)
            .select("parent_id", "n_items"))


# -- merged edges ---------------------------------------------------------------

def missing_catalog(merged: DataFrame) -> DataFrame:
    """Edges where either end has no catalog."""
    return merged.where(F.col("catalog1").isNull() | F.col("catalog2").isNull())


def missing_catalog_count(merged: DataFrame) -> DataFrame:
    return missing_catalog(merged).agg(F.count(F.lit(1)).alias("n_edges"))


def edges_touching(merged: DataFrame, item: int) -> DataFrame:
    """Edges with ``item`` at either end."""
    return merged.where((F.col("item1") == F.lit(item)) | (F.col("item2") == F.lit(item)))


def edges_distinct(merged: DataFrame) -> DataFrame:
    """Distinct (item1, item2) pairs."""
    return merged.select("item1", "item2").distinct()


def profile(df: DataFrame, cols: Sequence[str] = ("rating1", "rating2", "click")) -> DataFrame:
    """describe() in long, typed form: (field, n, mean, stddev, min_value, max_value).

    One aggregate pass computes all statistics of all columns; the rows are
    then unpivoted from the single result row.
    """
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(c).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__stddev"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(
        F.lit(c).alias("field"), F.col(f"{c}__count").alias("n"),
        out(f"{c}__mean").alias("mean"), out(f"{c}__stddev").alias("stddev"),
        F.col(f"{c}__min").alias("min_value"), F.col(f"{c}__max").alias("max_value"))
        for c in cols])
    return one.select(F.inline(rows))


def source_records(merged: DataFrame) -> DataFrame:
    """(item2, id, rating, catalog, click): the source of every edge.

    Missing rating / catalog of the source become 0, as the source records
    hold plain numbers.
    """
    return merged.select(
        "item2", F.col("item1").alias("id"),
        F.coalesce(F.col("rating1"), F.lit(0.0)).alias("rating"),
        F.coalesce(F.col("catalog1"), F.lit(0)).alias("catalog"),
        F.col("click"))


def reverse_adjacency_rows(merged: DataFrame) -> DataFrame:
    """Distinct source records per destination: (item2, id, rating, catalog, click)."""
    return distinct_rows(materialize(source_records(merged), "source_records"), ["item2", "id"])


def edge_quantiles(merged: DataFrame) -> DataFrame:
    """Median and upper quartile (by index n/2 and n/2 + n/4 of the sorted
    values) and the mean of clicks; the same quantiles of non-zero ratings."""
    # Three steps read the same rows: written once.
    rows = materialize(reverse_adjacency_rows(merged).select("click", "rating"), "edge_sources")
    click = F.struct(F.lit("click").alias("kind"), F.col("click").cast("double").alias("value"))
    rating = F.struct(F.lit("rating").alias("kind"), F.when(F.col("rating") != 0.0, F.col("rating")).alias("value"))
    found = order_statistics(rows.select(F.inline(F.array(click, rating))), {
        "click_p50": ("click", 0.5), "click_p75": ("click", 0.75),
        "rating_p50": ("rating", 0.5), "rating_p75": ("rating", 0.75)})
    whole = rows.agg(F.count(F.lit(1)).alias("n_clicks"), out(F.avg("click")).alias("click_mean"),
                     F.count(F.when(F.col("rating") != 0.0, 1)).alias("n_ratings"))
    # One row each, of different columns: stacked and folded into one.
    both = whole.unionByName(found, allowMissingColumns=True)
    both = both.agg(*[F.max(c).alias(c) for c in both.columns])
    return both.select("n_clicks", F.col("click_p50").cast("bigint").alias("click_p50"),
                       F.col("click_p75").cast("bigint").alias("click_p75"), "click_mean", "n_ratings",
                       "rating_p50", "rating_p75")
