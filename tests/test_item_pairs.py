"""Item pairs: one salted path, and the top pairs found without the pairs of heavy users."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from affinity.operators import item_cf
from affinity.operators.skew import salted_pairs
from tests.brute import Dense


def ratings(seed, users=260, items=160, each=9, heavy=2):
    """Sparse ratings, and ``heavy`` users that rated every item (about a fifth of all ratings each at most)."""
    rng = np.random.default_rng(seed)
    taste = rng.normal(size=(items, 3))
    rows = []
    for u in range(users):
        who = rng.normal(size=3)
        for i in rng.choice(items, size=each, replace=False):
            rows.append((u, int(i), int(np.clip(round(3 + 0.8 * taste[i] @ who + rng.normal() * 0.3), 1, 5))))
    for h in range(heavy):
        rows += [(1000 + h, i, int(rng.integers(1, 6))) for i in range(items)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(pd.DataFrame(rows, columns=["user_id", "item_id", "rating"]),
                                 "user_id bigint, item_id bigint, rating int")


def dense_top(rows, target, k):
    """{(m1, m2): (sim, rank)} of the positive pairs among each item's k best."""
    d = Dense(rows)
    bu, bi = d.offsets()
    left = np.where(d.rated, d.r - (bu[:, None] + bi + d.mu), 0.0)
    norm = np.sqrt((left * left).sum(axis=0))
    sim = np.round(left.T @ left / np.outer(norm, norm), 12)
    out = {}
    for m in np.flatnonzero(~d.rated[d.users.index(target)]):
        order = sorted((j for j in range(len(d.items)) if j != m), key=lambda j: (-sim[m, j], j))[:k]
        out |= {(d.items[m], d.items[j]): (sim[m, j], r + 1) for r, j in enumerate(order) if sim[m, j] != 0}
    return out


@pytest.mark.parametrize("block", [4096, 7])
def test_salted_pairs_are_all_pairs_once(spark, block):
    rows = [(g, m, m * 10, n) for g, n in ((1, 30), (2, 3), (3, 1)) for m in range(n)]
    df = spark.createDataFrame(rows, "g long, m long, x long, n long")
    got = salted_pairs(df, "g", "m", ["x"], "n", block=block).collect()
    want = [(g, a, 10 * a, b, 10 * b) for g, n in ((1, 30), (2, 3), (3, 1)) for a in range(n) for b in range(n) if a != b]
    assert sorted(map(tuple, got)) == sorted(want)
    half = salted_pairs(df, "g", "m", [], "n", block=block, unordered=True).collect()
    assert sorted((r[0], r[1], r[2]) for r in half) == sorted((g, a, b) for g, a, _, b, _ in want if a < b)


def test_a_big_group_is_dealt_over_block_pairs(spark):
    df = spark.range(4000).select(F.lit(1).alias("g"), F.col("id").alias("m"), F.lit(4000).alias("n"))
    pairs = salted_pairs(df, "g", "m", [], "n", block=250, unordered=True)
    sizes = [r[1] for r in pairs.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 4000 * 3999 // 2 and max(sizes) < 0.4 * sum(sizes)
    text = pairs._jdf.queryExecution().toString()
    assert text.count("Range (0, 4000") <= 2 * 4  # each side is read once in every form of the plan


@pytest.mark.parametrize("seed,k", [(1, 5), (2, 8), (3, 30)])
def test_pruned_top_pairs_equal_dense(spark, seed, k):
    rows = ratings(seed)
    target = 3
    im = item_cf.fit(frame(spark, rows))
    level = item_cf.heavy_level(im)
    assert level is not None and 9 < level < 160
    got = {(r.m1, r.m2): (r.sim, r["rank"]) for r in item_cf.pruned_top_pairs(im, target, level, k).collect()}
    want = dense_top(rows, target, k)
    assert got.keys() == want.keys()
    for pair, (sim, rank) in got.items():
        assert sim == pytest.approx(want[pair][0], abs=1e-9) and rank == want[pair][1]


def test_pruning_joins_at_most_half_the_pairs(spark):
    rows = ratings(4, items=300, users=500)
    im = item_cf.fit(frame(spark, rows))
    level = item_cf.heavy_level(im)
    every = salted_pairs(im.vectors, "user_id", "item_id", [], "n_u", unordered=True).count()
    light = im.vectors.where(F.col("n_u") <= level)
    some = salted_pairs(light, "user_id", "item_id", [], "n_u", unordered=True).count()
    tail = im.vectors.where(F.col("n_u") > level)
    norms = item_cf.tail_norms(tail)
    sims = item_cf.similarities(im, 3)
    top = item_cf.top_pairs(im, sims, 5)
    floors = top.where("rank = 5").select("m1", F.col("sim").alias("floor"))
    lone = item_cf.reachable_in_tail(tail, norms, floors).count()
    assert some + lone <= every / 2


def test_no_user_is_heavy_in_even_tables(spark):
    assert item_cf.heavy_level(item_cf.fit(frame(spark, ratings(5, heavy=0)))) is None


def test_estimates_rank_the_items_near_the_target_only(spark):
    # Two groups of users that rate different items: no item of the second is near user 3.
    rows = ratings(6, users=60, items=40, heavy=0)
    rows += [(u + 500, i + 500, r) for u, i, r in rows]
    df = frame(spark, rows)
    im = item_cf.fit(df)
    near = {r.m1 for r in item_cf.near_similarities(im, 3).select("m1").distinct().collect()}
    assert near and max(near) < 500
    got, want = ({r["item_id"]: r["estimate"] for r in item_cf.estimates_from(*item_cf.kept_pairs(df, 3, 5, near=n), 3).collect()}
                 for n in (True, False))
    assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i], abs=1e-12) for i in got)


def test_a_pair_is_shuffled_as_two_ids_and_a_sum(spark):
    im = item_cf.fit(frame(spark, ratings(7, users=60, items=40, heavy=0)))
    assert item_cf.pair_cosines(im.vectors).columns == ["a", "b", "sim", "sim_raw"]
    text = item_cf.pair_cosines(im.vectors)._jdf.queryExecution().optimizedPlan().toString()
    assert "norm2_1" not in text and "reach_1" not in text


@pytest.mark.parametrize(("users", "each", "k"), [(120, 9, 5), (30, 30, 12)])
def test_slices_of_items_keep_the_same_pairs(spark, monkeypatch, users, each, k):
    """Sparse ratings, and dense ones of few items, in which negative pairs can be kept; slice by slice and all at once."""
    rows = ratings(3, users=users, items=40, each=each, heavy=0)
    df = frame(spark, rows)
    whole = {(r.m1, r.m2): (r.sim, r["rank"]) for r in item_cf.kept_pairs(df, 1, k)[1].collect()}
    assert whole == {m: (pytest.approx(s), r) for m, (s, r) in dense_top(rows, 1, k).items()}
    monkeypatch.setattr(item_cf, "SLICE_PAIRS", 4000)
    im = item_cf.fit(df)
    assert item_cf.pair_slices(im) > 2
    cut = item_cf.kept_pairs(df, 1, k)[1]
    assert {(r.m1, r.m2): (r.sim, r["rank"]) for r in cut.collect()} == {m: (pytest.approx(s), r) for m, (s, r) in whole.items()}
    # The pairs are gone: what is left is the cut of each slice, written.
    assert len(cut.inputFiles()) > 2 and "Join" not in cut._jdf.queryExecution().optimizedPlan().toString()
