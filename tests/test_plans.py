"""Plan shape: the physical strategies the operators rely on."""

from pyspark.sql import functions as F

from affinity.operators import item_cf, stats, user_cf
from tests.conftest import INLINE


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_inline_text_split_to_fields(spark, inline_ratings):
    """Tab-separated fixture text -> integer triples, with Spark's split."""
    lines = spark.createDataFrame([("\t".join(map(str, row)),) for row in INLINE], "line string")
    f = F.split("line", "\t")
    parsed = lines.select(f[0].cast("bigint").alias("user_id"), f[1].cast("bigint").alias("item_id"),
                          f[2].cast("int").alias("rating"))
    assert sorted(map(tuple, parsed.collect())) == sorted(map(tuple, inline_ratings.collect()))


def test_item_topk_uses_group_limit(spark, inline_ratings):
    im = item_cf.fit(inline_ratings, written=False)
    kept = item_cf.top_pairs(im, item_cf.similarities(im, 3))
    kept.collect()
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_neighbours_are_a_bounded_top_k(spark, inline_ratings):
    nb = user_cf.neighbours(inline_ratings, 3)
    assert "TakeOrderedAndProject" in _plan(nb)


def test_filters_reach_the_scan(spark):
    from tests.conftest import SF_SMALL
    from affinity.sources import bindings as b

    df = stats.target_ratings(b.ratings(spark, SF_SMALL), 7)
    plan = _plan(df)
    assert "PushedFilters" in plan and "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan
