"""Baseline predictions for given cells, known or not, and shuffles of the one-pass statistics."""

import numpy as np
import pytest

from affinity.operators import baseline, stats, user_cf
from tests.brute import Dense
from tests.conftest import INLINE, TARGET


def test_cells_of_unknown_users_and_items_fall_back(spark, inline_ratings):
    d = Dense(INLINE)
    bu, bi = d.offsets()
    u, i = d.users[0], d.items[1]
    cells = [(u, i), (u, i), (u, -1), (-1, i), (-1, -1), (None, i), (None, None)]
    df = spark.createDataFrame([(*c, "x") for c in cells], "user_id long, item_id long, value string")
    got = baseline.predict(baseline.fit(inline_ratings), df).collect()
    assert len(got) == len(cells)
    for r in got:
        want = d.mu + (bu[0] if r.user_id == u else 0.0) + (bi[1] if r.item_id == i else 0.0)
        assert r.value == pytest.approx(want, abs=1e-12)
        assert (r.known_user, r.known_item) == (r.user_id == u, r.item_id == i)


def test_predictions_of_no_cells(spark, inline_ratings):
    cells = spark.createDataFrame([], "user_id long, item_id long")
    assert baseline.predictions(inline_ratings, cells).count() == 0


@pytest.mark.parametrize("scale", [1.0, 0.1])
def test_correlations_of_fractional_ratings(spark, scale):
    rng = np.random.default_rng(4)
    rows = [(u, i, scale * int(rng.integers(1, 6))) for u in range(40) for i in range(30) if rng.random() < 0.4]
    rows += [(100, i, 3 * scale) for i in range(30)]  # one value only
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating double")
    got = {r.user_id: r.pc for r in user_cf.correlations(df, 3).collect()}
    want = Dense(rows).pearson(3)
    assert got.keys() == want.keys()
    assert all(got[u] == pytest.approx(want[u], abs=1e-9) for u in want)


def shuffles(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan[:plan.index("+- == Initial Plan ==")] if "+- == Initial Plan ==" in plan else plan
    return final.count("Exchange ") - final.count("BroadcastExchange") - final.count("ReusedExchange")


def test_few_shuffles(spark, inline_ratings):
    own = user_cf.target_rows(inline_ratings, TARGET)
    assert shuffles(user_cf.correlations(inline_ratings, TARGET, own)) <= 3
    merged = spark.createDataFrame([(1, 1, 4.0, 2, 1, 3.0, k) for k in range(40)],
                                   "item1 long, catalog1 int, rating1 double, item2 long, catalog2 int, rating2 double, click long")
    assert shuffles(stats.edge_quantiles(merged)) < 8
