"""Content ranking edge cases."""

import math
import random

import numpy as np
import pytest

from affinity.operators import content


def _docs(spark, rows):
    items = spark.createDataFrame(rows, "itemid string, parent_id string, attr1 string, attr2 string")
    return content.item_documents(items)


def _cands(spark, rows):
    return spark.createDataFrame(rows, "target long, item long, rating double, catalog int, click long, level int")


def test_cosine_rules(spark):
    docs = _docs(spark, [
        ("1", "10", "red metal bolt", "x"),     # target
        ("2", "20", "red metal bolt", None),    # shares 3 terms
        ("3", "30", "red plastic cup", None),   # shares 1 term -> 0
        ("4", "40", "green cup", None),         # shares none -> 0
        ("5", None, "red metal", None),         # parent NULL -> -1
    ])
    cands = _cands(spark, [(1, i, 4.0, 0, 2, 1) for i in (2, 3, 4, 5)])
    ranked = {r["item"]: (r["cos"], r["ordered"], r["rank"])
              for r in content.rank_candidates(cands, docs, "count").collect()}
    assert ranked[2][0] == 1.0 and ranked[5][0] == 1.0
    assert ranked[3][0] == 0.0 and ranked[4][0] == 0.0
    assert ranked[2][1] == 108.0
    assert [i for i, _ in sorted(ranked.items(), key=lambda kv: kv[1][2])] == [2, 5, 3, 4]


def test_tfidf_zero_idf_terms_give_zero(spark):
    # Every document holds the two shared terms: idf = ln((m+1)/(df+1)) = 0, cos 0/0 -> 0.
    docs = _docs(spark, [("1", "1", "alpha beta", "t1"), ("2", "2", "alpha beta", "t2"),
                         ("3", "3", "alpha beta gamma", None)])
    cands = _cands(spark, [(1, 2, 1.0, 0, 1, 1), (1, 3, 1.0, 0, 1, 1)])
    cos = {r["item"]: r["cos"] for r in content.rank_candidates(cands, docs, "tfidf").collect()}
    assert cos == {2: 0.0, 3: 0.0}
    w = {r["term"]: (r["df"], r["m"]) for r in content.tfidf_weights(cands, docs).collect()}
    assert w["alpha"] == (3, 3) and w["gamma"] == (1, 3)


def test_siblings_and_null_parents_excluded(spark):
    docs = _docs(spark, [("1", None, "a1 b1", None), ("2", None, "a1 b1", None),
                         ("3", "7", "a1 b1", None)])
    cands = _cands(spark, [(1, 2, 1.0, 0, 1, 1), (1, 3, 1.0, 0, 1, 1)])
    items = [r["item"] for r in content.rank_candidates(cands, docs, "tfidf").collect()]
    assert items == [3]


def test_documents_and_overlap(spark):
    docs = _docs(spark, [("1", "1", "aa bb cc", None), ("2", "2", "aa bb", None),
                         ("3", "3", "aa cc", None)])
    cands = _cands(spark, [(1, 2, 2.5, 0, 3, 1), (1, 3, 1.0, 0, 9, 2)])
    ranked = content.rank_candidates(cands, docs, "tfidf")
    doc = content.recommendation_documents(ranked).first()
    assert doc["item"] == "1" and doc["recoms"] == {"2": 107, "3": 109}
    ov = content.overlap(content.rank_candidates(cands, docs, "count"), ranked).first()
    assert ov["overlap"] == 1.0


def test_sparse_cosine_of_unequal_weights_equals_numpy(spark):
    rng = random.Random(1)
    vectors = {("a", k): {t: rng.choice([0.0, 1.5, -2.0, 0.25, None]) for t in rng.sample(range(12), rng.randrange(7))}
               for k in range(25)}
    own = {t: rng.choice([0.0, 3.0, -1.0, 0.5]) for t in range(9)}
    one = spark.createDataFrame([("a", t, w) for t, w in own.items()] + [("b", 1, 1.0)], "g string, term int, w double")
    other = spark.createDataFrame([(g, i, t, w) for (g, i), v in vectors.items() for t, w in v.items()],
                                  "g string, item int, term int, w double")
    got = {r["item"]: (r.shared, r.cos) for r in content.sparse_cosine(one, other, ["g"], ["item"]).collect()}
    for (_, i), v in vectors.items():
        shared = sorted(set(v) & set(own))
        if not shared:
            assert i not in got
            continue
        x, y = np.array([own[t] for t in shared]), np.array([v[t] or 0.0 for t in shared])
        norm = np.sqrt((x * x).sum()) * np.sqrt((y * y).sum())
        want = 0.0 if len(shared) < 2 or norm == 0 else (x * y).sum() / norm
        assert got[i][0] == len(shared) and got[i][1] == pytest.approx(want, abs=1e-12)
    # Norms over all terms instead of the shared ones would be wrong for some.
    assert any(0.01 < abs(c) < 0.99 for _, c in got.values())


def test_hashed_ranking_counts_collisions(spark):
    rng = random.Random(2)
    texts = {i: " ".join(f"w{rng.randrange(40)}" for _ in range(14)) for i in range(1, 21)}
    docs = _docs(spark, [(str(i), str(100 + i), t, None) for i, t in texts.items()])
    cands = _cands(spark, [(t, i, 1.0, 0, 1, 1) for t in (1, 2) for i in texts if i != t])
    words = content.item_words(docs)
    features = 16
    vectors = {r["item"]: dict(zip(r.buckets, r.tf, strict=True))
               for r in content.hashed_vectors(words, features).collect()}
    assert {i: sum(v.values()) for i, v in vectors.items()} == {i: len(set(t.split())) for i, t in texts.items()}
    assert sum(n > 1 for v in vectors.values() for n in v.values()) > 20  # words that share a bucket
    got = {(r.target, r["item"]): r.cos for r in content.hashed_scores(cands, docs, features).collect()}
    for t in (1, 2):
        shared = {i: set(vectors[t]) & set(vectors[i]) for i in texts if i != t}
        df = {k: 1 + sum(k in s for s in shared.values()) for k in vectors[t]}
        idf = {k: math.log((len(texts) + 1) / (n + 1)) for k, n in df.items()}
        for i, keys in shared.items():
            x = np.array([vectors[t][k] * idf[k] for k in sorted(keys)])
            y = np.array([vectors[i][k] * idf[k] for k in sorted(keys)])
            norm = np.sqrt((x * x).sum()) * np.sqrt((y * y).sum())
            want = 0.0 if len(keys) < 2 or norm == 0 else (x * y).sum() / norm
            assert got.get((t, i), 0.0) == pytest.approx(want, abs=1e-12)
    assert len({round(c, 6) for c in got.values()}) > 10
    ranked = content.rank_candidates(cands, docs, "hashed", num_features=features).where("target = 1").collect()
    assert [r["item"] for r in sorted(ranked, key=lambda r: r["rank"])] == [
        i for i in sorted((i for i in texts if i != 1), key=lambda i: (-round(got.get((1, i), 0.0), 12), i))]


def test_rare_term_candidates(spark):
    docs = _docs(spark, [("1", "1", "common rare1 lone1", None), ("2", "2", "common rare1", None),
                         ("3", "3", "common other", None), ("4", "4", "common other", None), ("5", "5", "solo", None)])
    targets = docs.where("item in (1, 5)").select("item")
    pairs = {tuple(r) for r in content.rare_term_candidates(docs, targets, prefix=1).collect()}
    assert pairs == {(1, 2)}
    pairs = {tuple(r) for r in content.rare_term_candidates(docs, targets, prefix=2).collect()}
    assert pairs == {(1, 2), (1, 3), (1, 4)}


@pytest.mark.parametrize("weighting", ["tfidf", "hashed"])
def test_a_pair_is_scored_in_its_row(spark, weighting):
    docs = _docs(spark, [("1", "10", "red metal bolt", "x1"), ("2", "20", "red metal bolt", None), ("3", "30", "red cup", None)])
    cands = _cands(spark, [(1, i, 4.0, 0, 2, 1) for i in (2, 3)])
    scores = content.cosine_scores(cands, docs) if weighting == "tfidf" else content.hashed_scores(cands, docs)
    assert {r["item"]: pytest.approx(r.cos) for r in scores.collect()} == {2: 1.0, 3: 0.0}
    # Rows are made of shared terms once, for the document frequencies; no weight is joined to them.
    assert scores._jdf.queryExecution().optimizedPlan().toString().count("Generate explode") == 1
    # A candidate that is listed twice counts its terms twice, as before, in one row.
    twice = content.cosine_scores(cands.unionAll(cands.where("item = 3")), docs)
    assert sorted(r["item"] for r in twice.collect()) == [2, 3]


def test_words_travel_as_hashes_only_if_no_two_share_one(spark, monkeypatch):
    words = spark.createDataFrame([(1, ["red", "cup"]), (2, ["red"]), (3, [])], "item long, words array<string>")
    assert dict(content._keyed(words).dtypes)["words"] == "array<bigint>"
    monkeypatch.setattr(content.F, "xxhash64", lambda *c: content.F.length(*c))  # red and cup clash
    assert content._keyed(words) is words


@pytest.mark.parametrize("weighting", ["tfidf", "hashed"])
def test_scores_in_blocks_of_targets_are_the_same(spark, monkeypatch, weighting):
    """The words of a pair are looked up block by block; nothing a block shuffled stays."""
    rng = random.Random(5)
    docs = _docs(spark, [(str(i), str(i % 7), " ".join(rng.choices([f"w{k}" for k in range(40)], k=rng.randrange(1, 15))), None)
                         for i in range(40)])
    pairs = [(t, i, 0.0, 0, 0, 1) for t in range(0, 40, 4) for i in rng.sample(range(45), 12)]
    cands = _cands(spark, pairs + pairs[:9])
    whole = sorted(content.rank_candidates(cands, docs, weighting, num_features=16).collect())
    monkeypatch.setattr(content, "BLOCK_TERMS", 20)
    shuffles = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    before = set(shuffles.keySet().mkString(",").split(","))
    scores = (content.hashed_scores(cands, docs, 16) if weighting == "hashed" else content.cosine_scores(cands, docs))
    assert set(shuffles.keySet().mkString(",").split(",")) - before <= {""}
    assert len(scores.inputFiles()) > 3
    assert sorted(content.rank_candidates(cands, docs, weighting, num_features=16).collect()) == whole
    assert {r.cos for r in scores.collect()} > {0.0}
