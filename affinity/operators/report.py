"""The rating-recommender report: one row of eight fields (their names are fixed values of the format).

Scalars are rounded half-down to 4 digits; lists keep their rank order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.functions.numeric import half_down
from affinity.operators import item_cf, stats, user_cf
from affinity.session import materialize


def _ids_in_order(ranked: DataFrame, id_col: str):
    """A ranked frame of at most k rows -> scalar ARRAY of ids in rank order."""
    entries = F.sort_array(F.collect_list(F.struct("rank", id_col)))
    return ranked.agg(F.transform(entries, lambda e: e[id_col]).alias("ids")).scalar()


def cf_report(ratings: DataFrame, target: int, k: int = user_cf.NEIGHBOURS,
              n: int = user_cf.TOP_N) -> DataFrame:
    """average_user_ratings, average_film_ratings, completeness, average_rating,
    pearson_neighbours, pearson_top10, predicators_top10, predicators_positive_top10."""
    dens = stats.density(ratings)
    # The neighbour list feeds the report and the estimates: written once (k rows).
    own = user_cf.target_rows(ratings, target)
    neighbours = materialize(user_cf.neighbours(ratings, target, k, own), "neighbours")
    user_top = user_cf.top_n(user_cf.estimates(ratings, target, k, nb=neighbours, mine_rows=own), n)
    im, kept = item_cf.kept_pairs(ratings, target, k, near=True)
    est = item_cf.estimates_from(im, kept, target)
    est_pos = item_cf.estimates_from(im, kept, target, positive_only=True)
    item_top = user_cf.top_n(est, n)
    item_top_pos = user_cf.top_n(est_pos, n)
    return dens.select(
        half_down("average_user_ratings").alias("average_user_ratings"),
        half_down("average_film_ratings").alias("average_film_ratings"),
        half_down("completeness").alias("completeness"),
        half_down(im.items.agg(F.max("mu")).scalar()).alias("average_rating"),
        _ids_in_order(neighbours, "user_id").alias("pearson_neighbours"),
        _ids_in_order(user_top, "item_id").alias("pearson_top10"),
        _ids_in_order(item_top, "item_id").alias("predicators_top10"),
        _ids_in_order(item_top_pos, "item_id").alias("predicators_positive_top10"),
    )
