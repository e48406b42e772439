"""Toxicity and quality rules: figures against brute force, held-out accuracy, edges; the whole pipeline."""

import math
from collections import Counter
from zlib import crc32

import corpus_pipeline
import numpy as np
import pytest
from affinity.llm import near_dup, quality, toxicity
from affinity.llm.queries import QUERIES
from tests.conftest import SF_MID, SF_SMALL
from tests.llm.helpers import docs, table, words


def labels(spark, rows):
    return spark.createDataFrame([(i, q, t, "x") for i, q, t in rows], "doc_id long, quality int, toxic int, text string")


# -- toxicity

def test_held_out_accuracy(spark):
    told = {r["doc_id"]: r["toxic"] for r in table(f"{SF_MID}/labels.parquet")}
    rows = QUERIES["op2_toxicity"](spark, SF_MID).collect()
    assert len(rows) == 1000 and all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    judged = [(r.predicted, told[r.doc_id]) for r in rows if r.held_out and r.doc_id in told]
    assert sum(p == t for p, t in judged) / len(judged) > 0.93


def toxic_table(spark):
    rng = np.random.default_rng(4)
    plain = [f"word{k}" for k in range(200)]
    texts, rows = [], []
    for k in range(240):
        w = list(rng.choice(plain, rng.integers(5, 60)))
        if k % 4 == 0:
            w[rng.integers(len(w))] = rng.choice(["vile!", "VILE", "rotten", "rottenest"])
        texts.append(" ".join(w))
        rows.append((k, 1, int(k % 4 == 0)))
    return texts, rows


def test_nearest_is_exact():
    rng = np.random.default_rng(8)
    n, m = 300, 20
    dense = np.where(rng.random((n, m)) < 0.15, rng.integers(1, 4, (n, m)), 0) * 1.0
    dense[:, -1] = 1
    dense[50:60] = dense[40:50]  # ties
    dense /= np.sqrt((dense * dense).sum(axis=1, keepdims=True))
    index = toxicity.Index({f"t{k}": k for k in range(m - 1)}, rng.random(m) + 1, dense.copy(), np.zeros(n), np.ones(n),
                           np.arange(n), k=7, block=16)
    for _ in range(200):
        counts = {int(t): int(rng.integers(1, 5)) for t in rng.choice(m - 1, rng.integers(0, 6), replace=False)}
        terms, w = index.vector(counts)
        assert math.isclose((w * w).sum(), 1)
        score = dense[:, terms] @ w
        best = sorted(score, reverse=True)[:7]
        assert np.allclose([c for c, _ in index.nearest(terms, w)], best)


def test_toxicity_edges(spark):
    texts, rows = toxic_table(spark)
    rows += [(None, 1, 1), (3, None, None), (9999, 0, 1), (3, 1, 0), (3, 1, 0)]
    index = toxicity.train(docs(spark, texts), labels(spark, rows))
    odd = [None, "", "vile", "Vile, rottenest!", "word1 " * 20_000, "word1", "é"]
    got = toxicity.score(docs(spark, odd, [0, 1, 2, 3, 4, None, 5]), index).collect()
    by = {r.doc_id: r for r in got}
    assert by[2].predicted == by[3].predicted == 1 and by[2].evidence[0].toxic > 0.5
    assert by[0].score == by[1].score == by[5].score and by[0].predicted == 0 and by[4].predicted == 0
    assert toxicity.train(docs(spark, texts), labels(spark, [])) is None
    assert {r.score for r in toxicity.score(docs(spark, odd), None).collect()} == {0.0}
    assert toxicity.train(docs(spark, []), labels(spark, rows)) is None
    assert toxicity.score(docs(spark, []), index).collect() == []
    only = toxicity.train(docs(spark, texts), labels(spark, [(k, 1, 0) for k in range(50)]))
    assert all(r.predicted == 0 for r in toxicity.score(docs(spark, odd), only).collect())


def test_copies_of_toxic_examples_without_a_listed_term(spark):
    texts, rows = toxic_table(spark)
    rng = np.random.default_rng(12)
    lone = [" ".join(f"plainly{k}" for k in rng.integers(0, 400, 40)) for _ in range(3)]
    rows += [(1000 + k, 1, int(k < 2)) for k in range(3)]
    index = toxicity.train(docs(spark, texts + lone, [*range(len(texts)), 1000, 1001, 1002]), labels(spark, rows))
    assert not any(t.startswith("plainly") for t in index.terms)
    odd = [lone[0], lone[1].upper() + " word3", lone[2], " ".join(words(lone[0])[:20]), lone[0] + " " + lone[2]]
    by = {r.doc_id: r for r in toxicity.score(docs(spark, odd), index).collect()}
    assert [by[k].predicted for k in range(5)] == [1, 1, 0, 0, 0]
    assert by[0].evidence[0].doc_id == 1000 and math.isclose(by[0].evidence[0].cosine, 1)
    assert by[1].evidence[0].doc_id == 1001


def test_copies_are_found_exactly():
    rng = np.random.default_rng(2)
    texts = []
    for _ in range(30):
        base = rng.integers(0, 300, rng.integers(1, 60))
        for _ in range(4):
            texts.append(np.where(rng.random(len(base)) < 0.05, rng.integers(0, 320, len(base)), base))
    pairs = [np.unique(x.astype(np.uint64), return_counts=True) for x in texts]
    copies = toxicity.Copies.of([(i, 0, w.tobytes(), n.astype(np.int64).tobytes()) for i, (w, n) in
                                 enumerate(pairs[::2])], 0.8)
    dense = np.zeros((len(copies.example), len(copies.words)))
    for e in range(len(dense)):
        part = slice(copies.starts[e], copies.starts[e + 1])
        dense[e, copies.terms[part]] = copies.weights[part]
    found = 0
    for w, n in pairs:
        at = copies.numbers(w)
        q = (1 + np.log(n)) * np.where(at >= 0, copies.idf[at], copies.unseen)
        cos = dense[:, at[at >= 0]] @ (q / np.sqrt((q * q).sum()))[at >= 0]
        got = copies.near(at, n)
        assert {e for _, e in got} == set(np.flatnonzero(cos >= 0.8).tolist())
        assert np.allclose([c for c, _ in got], [cos[e] for _, e in got])
        found += len(got)
    assert found > len(pairs)


# -- quality rules

def figures(text):
    text = text or ""
    w = words(text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if words(line):
            again += line in seen
            seen.add(line)
    windows = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
    covered = {k + o for k in range(len(w) - 4) if windows[tuple(w[k:k + 5])] > 1 for o in range(5)}
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), again, len(covered), failed


def check_figures(rows, texts):
    for r in rows:
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == figures(texts[r.doc_id])
        assert r.kept == (not r.base_failed and r.content_share >= 0.5)


def test_figures_and_labels_of_documents(spark):
    rows = QUERIES["op7_quality"](spark, SF_MID).collect()
    check_figures(rows, {r["doc_id"]: r["text"] for r in table(f"{SF_MID}/documents.parquet")})
    told = {r["doc_id"]: r["quality"] for r in table(f"{SF_MID}/labels.parquet")}
    judged = [(r.kept, told[r.doc_id], r.base_failed) for r in rows if r.doc_id in told]
    good = [k for k, q, failed in judged if q and not failed]
    bad = [k for k, q, _ in judged if not q]
    assert sum(good) / len(good) > 0.98 and sum(bad) / len(bad) < 0.1


def test_quality_edges(spark):
    texts = [None, "", "\n\n \t", "a b c", "a b c d e f g h i j", "x\n" * 3000, "same line here\n" * 9 + "é ü",
             "one two three four five " * 2, "w" * 9 + " " + " ".join(f"v{k}" for k in range(4000)), "\r\n a\x0bb \x0c c#|"]
    field = quality.train(docs(spark, texts), labels(spark, [(4, 1, 0), (5, 0, 0), (6, None, 0), (None, 1, 0), (77, 1, 0)]))
    check_figures(quality.assess(docs(spark, texts), field).collect(), dict(enumerate(texts)))
    # Without two kinds of labels everything is content.
    field = quality.train(docs(spark, texts), labels(spark, []))
    rows = quality.assess(docs(spark, texts), field).collect()
    assert all(r.content_share == (r.n_words > 0) for r in rows)
    assert quality.assess(docs(spark, []), field).collect() == []


def test_repeated_rows_of_a_labelled_document_fit_once(spark):
    texts = [prose(20), "# # ! !\n* * $ $", prose(21) + "!", "% % & &\n< <"]
    told = labels(spark, [(0, 1, 0), (1, 0, 0), (2, 1, 0), (3, 0, 0)])
    once = quality.train(docs(spark, texts), told)
    often = quality.train(docs(spark, texts + [texts[1]] * 30, [0, 1, 2, 3] + [1] * 30), told)
    assert np.array_equal(once.weights, often.weights) and np.array_equal(once.pairs, often.pairs)


def test_lines_of_the_fit_are_drawn_from_the_whole_text():
    assert quality.drawn(200, np.uint64(5), 256).tolist() == list(range(200))
    places = [quality.drawn(10_000, np.uint64(s), 256) for s in range(40)]
    assert all(0 < len(p) <= 256 and (np.diff(p) > 0).all() and p[-1] < 10_000 for p in places)
    assert all(p[k] % 32 == 0 and p[k + 31] == p[k] + 31 for p in places for k in range(0, len(p) - 31, 32))
    assert np.mean(np.concatenate(places)) == pytest.approx(5000, rel=0.1)


def test_decoding_is_the_best_of_all_labellings():
    rng = np.random.default_rng(0)
    width = len(quality.FEATURES)
    field = quality.LineField(rng.normal(size=width), rng.normal(size=(2, 2)))
    doc = np.repeat([0, 1, 4, 5], [1, 7, 3, 6])
    x = rng.normal(size=(len(doc), width))
    got = field.decode(x, doc)
    for d in set(doc.tolist()):
        at = np.flatnonzero(doc == d)

        def total(y, at=at):
            return sum(x[i] @ field.weights * v for i, v in zip(at, y, strict=True)) + sum(
                field.pairs[a, b] for a, b in zip(y, y[1:], strict=False))
        every = [[n >> k & 1 for k in range(len(at))] for n in range(2 ** len(at))]
        assert math.isclose(total(got[at].tolist()), max(map(total, every)))
    assert len(field.decode(x[:0], doc[:0])) == 0


# -- pipeline

def test_pipeline_stages_take_effect(spark):
    frame = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    before, kept = frame, []
    for _, stage in corpus_pipeline.STAGES[:4]:
        after = corpus_pipeline.written(stage(spark, before, SF_SMALL), "test-stage")
        assert after.columns == frame.columns
        kept.append([r.doc_id for r in after.select("doc_id").collect()])
        before = after
    field = quality.train(frame, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    good = quality.assess(frame, field).where("kept")
    assert Counter(kept[0]) == Counter(r.doc_id for r in good.collect())
    some = frame.join(good.select("doc_id"), "doc_id", "left_semi")
    first = {r.doc_id for r in near_dup.near_duplicates(some).where("kept").collect()}
    assert set(kept[1]) == first
    assert set(kept[2]) <= first and set(kept[3]) <= set(kept[2]) and max(Counter(kept[3]).values()) <= 2
    rows = corpus_pipeline.run(spark, SF_SMALL).orderBy("start").collect()
    assert Counter(r.doc_id for r in rows) == Counter(kept[3])
    assert [r.start for r in rows] == np.cumsum([0, *[r.n_tokens for r in rows[:-1]]]).tolist()


def rows_left(stage, spark, frame):
    return Counter((r.doc_id, r.text) for r in stage(spark, frame, SF_SMALL).collect())


def prose(seed, n=40):
    rng = np.random.default_rng(seed)
    return " ".join(f"plain{k}" for k in rng.integers(0, 3000, n))


def test_quality_stage_drops_judged_rows_only(spark):
    # One text fails the rules by its length, the others by nothing.
    good = [r["text"] for r in table(f"{SF_SMALL}/documents.parquet") if r["doc_id"] in {
        k["doc_id"] for k in table(f"{SF_SMALL}/labels.parquet") if k["quality"] == 1}][:40]
    ids = [None if k % 3 == 0 else 1 if k % 3 == 1 else k for k in range(len(good))]
    frame = docs(spark, [*good, "too short", "too short", None], [*ids, None, 1, 1])
    field = quality.train(frame, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    judged = quality.assess(frame, field, id_col="text").where("kept").collect()
    fine = {r.doc_id for r in judged}
    got = rows_left(corpus_pipeline.quality_stage, spark, frame)
    assert got == Counter((i, t) for i, t in zip(ids, good, strict=True) if t in fine)
    assert sum(n for (i, _), n in got.items() if i is None) and sum(n for (i, _), n in got.items() if i == 1)


def test_decontamination_stage_drops_judged_rows_only(spark):
    leak = next(r["text"] for r in table(f"{SF_SMALL}/benchmark.parquet") if len(words(r["text"])) > 20)
    texts = [prose(1), leak, prose(2), prose(3), prose(4) + " " + leak, prose(5), None]
    ids = [None, None, None, 1, 1, 1, 1]
    assert rows_left(corpus_pipeline.decontamination_stage, spark, docs(spark, texts, ids)) == Counter(
        (i, t) for k, (i, t) in enumerate(zip(ids, texts, strict=True)) if k not in (1, 4))


def test_near_duplicate_stage_leaves_one_row_of_each_component(spark):
    a, b, c = prose(6), prose(7), prose(8)
    near = a.replace(a.split()[20], "other", 1)  # similar in 31 of 41 shingles: not linked
    rows = [(4, a), (4, a), (None, a), (None, b), (None, b), (3, a.upper()), (None, near), (None, c), (None, ""),
            (None, None), (4, b + " end")]
    frame = docs(spark, [t for _, t in rows], [i for i, _ in rows]).repartition(3)
    got = rows_left(corpus_pipeline.near_duplicate_stage, spark, frame)
    assert got == Counter([(3, a.upper()), (4, b + " end"), (None, near), (None, c), (None, ""), (None, None)])
    same = docs(spark, [c] * 5, [None] * 5).repartition(3)
    assert rows_left(corpus_pipeline.near_duplicate_stage, spark, same) == Counter([(None, c)])


def test_decontamination_stage_finds_passages_beside_the_centred_window(spark):
    # 13 words of an item, two replaced: only windows at other offsets of the seed hold enough equal words.
    items = [words(r["text"]) for r in table(f"{SF_SMALL}/benchmark.parquet")]
    item = next(w for w in items if len(w) >= 30 and len(set(w)) == len(w))
    texts = []
    for p in range(13):
        for q in range(p):
            part = item[8:21]
            part[p] = part[q] = "replaced"
            texts.append(prose(100 + p) + " " + " ".join(part) + " " + prose(200 + q))
    frame = docs(spark, texts)
    assert sum(rows_left(corpus_pipeline.decontamination_stage, spark, frame).values()) <= 2
