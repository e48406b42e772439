"""The recommenders on a small table made by a rule, against brute force."""

import pytest

from affinity.operators import baseline as bl
from affinity.operators import item_cf, report, stats, user_cf
from tests.brute import Dense, top
from tests.conftest import INLINE, TARGET, rows_to_dict

BRUTE = Dense(INLINE)


def same(got, expected):
    assert got.keys() == expected.keys()
    for k, v in expected.items():
        assert got[k] is None if v is None else got[k] == pytest.approx(v, abs=1e-6)


def test_density(inline_ratings):
    n, users, items = len(INLINE), len(BRUTE.users), len(BRUTE.items)
    r = stats.rating_density(inline_ratings).first()
    assert r["average_user_ratings"] == pytest.approx(n / users, abs=1e-6)
    assert r["average_film_ratings"] == pytest.approx(n / items, abs=1e-6)
    assert r["completeness"] == pytest.approx(n / users / items, abs=1e-6)
    assert stats.global_mean(inline_ratings).first()["avg_rating"] == pytest.approx(BRUTE.mu, abs=1e-6)


def test_pearson(inline_ratings):
    expected = BRUTE.pearson(TARGET)
    assert any(expected.values())
    same(rows_to_dict(user_cf.correlations(inline_ratings, TARGET), "user_id", "pc"), expected)
    order = [r["user_id"] for r in user_cf.neighbours(inline_ratings, TARGET).orderBy("rank").collect()]
    assert order == [u for u, _ in BRUTE.neighbours(TARGET)]


def test_user_cf_estimates(inline_ratings):
    expected = BRUTE.user_estimates(TARGET)
    est = user_cf.estimates(inline_ratings, TARGET)
    same(rows_to_dict(est, "item_id", "estimate"), expected)
    assert [r["item_id"] for r in user_cf.top_n(est).orderBy("rank").collect()] == top(expected)


def test_baseline_offsets(inline_ratings):
    bu, bi = BRUTE.offsets()
    same(rows_to_dict(bl.user_offsets(inline_ratings), "user_id", "value"), dict(zip(BRUTE.users, bu, strict=True)))
    same(rows_to_dict(bl.item_offsets(inline_ratings), "item_id", "value"), dict(zip(BRUTE.items, bi, strict=True)))


@pytest.mark.parametrize("positive", [False, True])
def test_item_cf_estimates(inline_ratings, positive):
    expected = BRUTE.item_estimates(TARGET, positive)
    assert expected
    same(rows_to_dict(item_cf.item_estimates(inline_ratings, TARGET, positive_only=positive), "item_id", "estimate"),
         expected)


def test_report(inline_ratings):
    r = report.cf_report(inline_ratings, TARGET).first()
    assert r["average_rating"] == pytest.approx(BRUTE.mu, abs=1e-4)
    assert r["pearson_neighbours"] == [u for u, _ in BRUTE.neighbours(TARGET)]
    assert r["pearson_top10"] == top(BRUTE.user_estimates(TARGET))
    assert r["predicators_top10"] == top(BRUTE.item_estimates(TARGET))
    assert r["predicators_positive_top10"] == top(BRUTE.item_estimates(TARGET, True))


def test_no_python_udf_in_plans(inline_ratings):
    for df in (user_cf.estimates(inline_ratings, TARGET),
               item_cf.item_estimates(inline_ratings, TARGET)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
    anti = stats.unwatched_items(inline_ratings, TARGET)
    assert "LeftAnti" in anti._jdf.queryExecution().executedPlan().toString()


def test_unknown_target_gives_empty_predictions(inline_ratings):
    pc = rows_to_dict(user_cf.correlations(inline_ratings, 99), "user_id", "pc")
    assert set(pc) == set(BRUTE.users) and set(pc.values()) == {0.0}
    assert user_cf.top_n(user_cf.estimates(inline_ratings, 99)).count() == 0
    assert item_cf.item_estimates(inline_ratings, 99).count() == 0
