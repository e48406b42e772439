"""Fill-in-middle, source divergence and nearest neighbours against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from affinity.llm import divergence, fim, vp_search
from affinity.llm.queries import FACTOR

from .helpers import docs

# -- 11: fill-in-middle ----------------------------------------------------------

TEXTS = ["", None, "a", "\n", "\n\n", "é", "naïve\nçà\n😀 x\n", "no newline at end 😀", "one\ntwo\nthree", "has <P> mark\nx",
         "x\n" * 50 + "ü", "𝄞\n𝄞𝄞\n\n€", "<\n>P<\nS>", "long " * 40_000 + "\nend", "same\ntext", "same\ntext", "nul\x00byte\r\nß"]


def _brute_fim(doc_id, text, unit):
    text = text or ""
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "line" else list(text)
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return len(units), "plain", None, None, text
    if h[3] % 100 < 50:
        return len(units), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return len(units), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.mark.parametrize("unit", ["line", "char"])
def test_fill_in_middle(spark, unit):
    ids = [*range(len(TEXTS) - 3), 14, 14, None]
    texts = TEXTS * 4
    ids = [None if i is None else i + 100 * r for r in range(4) for i in ids]
    rows = fim.transform(docs(spark, texts, ids), unit=unit)
    got = rows.withColumn("back", fim.restored(F.col("form"), F.col("output"))).collect()
    want = [(i, *_brute_fim(i, t, unit), t or "") for i, t in zip(ids, texts, strict=True)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_fill_in_middle_rates_and_empty_table(spark):
    table = docs(spark, [f"a\nb{i}\nc" for i in range(300)])
    forms = [r.form for r in fim.transform(table, fim_percent=50, spm_percent=0).collect()]
    assert "spm" not in forms and 100 < forms.count("plain") < 200
    assert fim.transform(table.where("false")).count() == 0
    with pytest.raises(ValueError, match="unit"):
        fim.transform(table, unit="word")


def test_exception_index_is_sparse_and_goes_both_ways():
    text = "abc" * 100 + "é" + "x" * 50 + "😀€"
    index = fim.ExceptionIndex(np.frombuffer(text.encode(), np.uint8))
    assert len(index.at) == 3
    points = np.arange(len(text) + 1)
    at = np.array([len(text[:k].encode()) for k in points])
    assert index.bytes(points).tolist() == at.tolist() and index.points(at).tolist() == points.tolist()


def test_cut_of_a_slice_that_starts_inside_its_buffer():
    rows = pa.array(["zz\nz", "é\nb\n", "c"])
    whole, part = fim.cut(rows, np.array([1, 1, 1]), np.array([2, 2, 1])), fim.cut(rows[1:], np.array([1, 1]), np.array([2, 1]))
    assert whole["prefix"].tolist() == [3, 2, 1] and part["prefix"].tolist() == [2, 1] and part["middle"].tolist() == [2, 0]


# -- 12: source divergence -------------------------------------------------------

def _brute_divergence(rows, min_df, top):
    rows = [((x or "") for x in r) for r in rows]
    rows = [(lang, source, re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub(
        "[A-Z]", lambda m: m.group().lower(), text))) for lang, source, text in rows]
    out = []
    for lang in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == lang]
        df: dict = {}
        for _, _, words in own:
            for w in set(words):
                df[w] = df.get(w, 0) + 1
        vocabulary = [w for w, n in df.items() if n >= min_df]

        def chances(group, vocabulary=vocabulary):
            words = [w for _, _, ws in group for w in ws]
            count = {w: words.count(w) for w in vocabulary}
            n = sum(count.values())
            return count, {w: 1 + 1_000_000_000 * (count[w] + 1) // (n + len(vocabulary)) for w in vocabulary}

        _, q = chances(own)
        groups = {s: chances([r for r in own if r[1] == s]) for s in {r[1] for r in own}}
        for source, (count, p) in groups.items():
            pairs = [(sum((p[w] - o[w]) ** 2 // o[w] for w in vocabulary), s) for s, (_, o) in groups.items() if s != source]
            terms = [((p[w] - q[w]) ** 2 // q[w], w) for w in vocabulary if count[w] and p[w] > q[w]]
            for part, found in (("pair", pairs), ("term", sorted(terms, key=lambda x: (-x[0], x[1].encode()))[:top])):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, source, part, w, v, k + 1) for k, (v, w) in enumerate(found)]
    return out


@pytest.mark.parametrize("block_terms", [10**6, 60])
def test_divergence(spark, block_terms):
    rng = random.Random(5)
    words = ["alpha", "Beta", "ÉTÉ", "été", "naïve", "x", "zz", "日本", "o'clock", "mc2", "rare", "😀"]
    rows = []
    for i in range(120):
        lang = rng.choice(["en", "fr", None, "", "solo\x00odd"] if i % 3 else ["en"])
        text = " ".join(rng.choices(words, [9, 7, 5, 3, 2, 9, 1, 2, 3, 1, 0.1, 2], k=rng.randrange(0, 40)))
        rows.append((lang, rng.choice(["web", "Web", None, "été", "b"]), text if i % 11 else None))
    rows += [("one", "only", "word word word"), ("none", "a", ""), ("none", "b", None), ("en", "web", "hot " * 5000)]
    rows += [rows[0], rows[0]]
    table = spark.createDataFrame([(*r, None, "x") for r in rows], "lang string, source string, text string, g long, term string")
    got = divergence.audit(table, top_terms=4, block_terms=block_terms).collect()
    assert sorted(map(tuple, got)) == sorted(_brute_divergence(rows, 3, 4))
    assert {r.item for r in got if r.lang == "none" and r.part == "pair" and r.value == 0} == {"a", "b"}


def test_divergence_of_empty_tables(spark):
    table = docs(spark, ["a b", None])
    assert divergence.audit(table.where("false")).count() == 0
    assert {r.part for r in divergence.audit(table).collect()} <= {"pair"}


# -- 13: nearest neighbours ------------------------------------------------------

def _inner(x, y):
    out = 0.0  # not sum(), which corrects its rounding
    for a, b in zip(x, y, strict=True):
        out += a * b
    return out


def _brute_nearest(rows, queries, k):
    out = []
    rows, queries = dict.fromkeys(rows), dict.fromkeys(queries)
    for q, x in queries:
        found = sorted((-_inner(x, y), i) for i, y in rows
                       if (i, y) != (q, x) and len(x) == len(y))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


def _vectors(n, dim, seed, clusters=12):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(clusters, dim)) * 3
    x = middle[rng.integers(clusters, size=n)] + rng.normal(size=(n, dim)) * rng.uniform(0.2, 2, (n, 1))
    return [(i, tuple(float(v) for v in row)) for i, row in enumerate(x)]


SCHEMA = "vec_id long, embedding array<double>, query long, score double, dim int"


def _table(spark, rows):
    return spark.createDataFrame([(i, None if x is None else list(x), None, None, None) for i, x in rows], SCHEMA)


def test_factor_one_is_exact(spark):
    rows = _vectors(700, 6, 1)
    hot = rows[40][1]
    rows += [(1000 + i, hot) for i in range(300)]  # a third of all rows are one vector
    rows += [rows[3], rows[3], (4, rows[9][1]), (5000, (1.0, 2.0)), (5020, (2.0, 1.0)), (5040, (0.5,))]
    bad = [(2000, None), (2020, (0.0,) * 6), (2040, (1.0, None, 1.0, 1.0, 1.0, 1.0)), (2060, (float("nan"),) * 6),
           (2080, (float("inf"), *(1.0,) * 5)), (None, rows[5][1]), (2100, ())]
    table = _table(spark, rows + bad)
    queries = [r for r in rows if r[0] % 20 == 0]
    got = vp_search.nearest(table, table.where(F.col("vec_id") % 20 == 0), k=7, shard_rows=100)
    assert sorted(map(tuple, got.collect())) == _brute_nearest(rows, queries, 7)


def test_few_and_no_rows(spark):
    rows = _vectors(5, 4, 2)
    table = _table(spark, rows)
    assert sorted(map(tuple, vp_search.nearest(table, table).collect())) == _brute_nearest(rows, rows, 20)
    assert vp_search.nearest(table.where("false"), table).count() == 0
    assert vp_search.nearest(table, table.where("false")).count() == 0
    with pytest.raises(ValueError, match="factor"):
        vp_search.nearest(table, table, factor=0.5)


def test_recall_of_the_registered_factor(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, tuple(r.embedding)) for r in table.select("vec_id", "embedding").collect()]
    queries = [r for r in rows if r[0] % 20 == 0]
    got = vp_search.nearest(table, table.where(F.col("vec_id") % 20 == 0), k=20, factor=FACTOR, shard_rows=64).collect()
    want = _brute_nearest(rows, queries, 20)
    assert len(got) == len(want)
    found = {(r.query_id, r.vec_id) for r in got}
    assert sum((q, i) in found for q, _, i, _ in want) >= 0.98 * len(want)


def test_pruning_leaves_out_regions_of_clustered_rows():
    rows = np.array([x for _, x in _vectors(4000, 8, 3, clusters=40)])
    longest = (rows * rows).sum(axis=1).max()
    tree = vp_search.VpTree.fit(vp_search._lifted(rows, longest), 5)
    query = vp_search._query(rows[:50])
    far = tree.distances(query)
    kth = np.sort(rows[:50] @ rows.T, axis=1)[:, -20]
    reach = vp_search._reach(query, kth, longest)[:, None]
    skipped = [(tree.bounds(far) * f > reach).mean() for f in (1, 2, 4)]
    assert skipped[0] < skipped[1] < skipped[2] and skipped[2] > 0.1


# -- the pipeline ----------------------------------------------------------------

def test_pipeline_keeps_columns_of_any_name_and_takes_empty_tables(spark):
    import corpus_pipeline

    texts = [" ".join(f"plain{(7 * k + i) % 900}" for i in range(40)) for k in range(3)]
    frame = docs(spark, texts).select("*", *[F.lit(k).alias(name) for k, name in enumerate(
        ("_row", "_row_", "place", "_order", "bands", "edits"))])
    for _, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, frame, "/root/testdata/sf0.001")
        assert out.columns == frame.columns
        assert {(r._row, r._row_, r.place, r._order, r.bands, r.edits) for r in out.collect()} == {(0, 1, 2, 3, 4, 5)}
    for _, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, frame.where("false"), "/root/testdata/sf0.001").collect() == []


def test_plain_texts_part_at_all_that_is_no_term(spark):
    import re

    import pyarrow as pa

    ascii_ = "".join(map(chr, range(128)))
    texts = ["", "Ab, cD--e", ascii_, "É Çéǅ ß\U0001f600Z", "a\x00B\n\x7fc", "", "XYZ"]
    want = [re.sub("[A-Z]", lambda m: m.group().lower(), re.sub(r"[\x00-\x40\x5B-\x60\x7B-\x7F]", " ", t)) for t in texts]
    for kind in (pa.string(), pa.large_string()):
        rows = pa.array(["before", *texts, "after"], kind)
        assert divergence.plain(rows.slice(1, len(texts))).to_pylist() == want  # a slice's own bytes only
        assert divergence.plain(rows.slice(0, 0)).to_pylist() == []
    table = spark.createDataFrame([(t, "xy"[k % 2], None) for k, t in enumerate(texts)], "text string, lang string, source string")
    rows = divergence._plain_texts(table.na.fill("")).collect()
    assert sorted((r.lang, r.text) for r in rows) == sorted(("xy"[k % 2], t) for k, t in enumerate(want))
    assert len({(r.lang, r.part) for r in rows}) == 2


def test_bags_hold_every_text_of_their_group_and_no_empty_terms(spark):
    rng = random.Random(9)
    texts = [", ".join(rng.choices(["Ab", "c--d", "été", "", " x"], k=rng.randrange(9))) + rng.choice(["", "!?", "z"]) for _ in range(300)]
    rows = [(rng.choice(["en", "fr", ""]), rng.choice(["web", "w\x00", ""]), t) for t in texts] + [("en", "web", "long " * 200)]

    def words(text):
        return [w for w in divergence.plain(pa.array([text])).to_pylist()[0].split(" ") if w]

    want = sorted((a, b, words(t)) for a, b, t in rows)
    for kind in (pa.string(), pa.large_string()):
        batch = pa.RecordBatch.from_arrays([pa.array(c, kind) for c in zip(*[("en", "web", "before "), *rows, ("fr", "", " after")], strict=True)],
                                           ["lang", "source", "text"]).slice(1, len(rows))
        out = divergence.bags(batch, 200).to_pylist()
        assert sorted((r["lang"], r["source"], t.split()) for r in out for t in r["texts"]) == want
        assert all("  " not in t and not t.startswith(" ") for r in out for t in r["texts"])
        assert 9 < len(out) < len(rows) / 3 and max(len(r["texts"]) for r in out) > 5
        # One text may reach over the limit, and a text that is longer has company of less than the limit.
        assert all(sum(len(t.encode()) for t in r["texts"][:-1]) <= 200 for r in out)
    table = spark.createDataFrame(rows, "lang string, source string, text string").coalesce(2)
    found = divergence._bags(table, 200)
    assert sorted((r.lang, r.source, t.split()) for r in found.collect() for t in r.texts) == want
    assert found.count() < len(rows) / 3


def test_divergence_counts_documents_of_one_bag_apart(spark):
    # "twice" is in two documents of one bag, "thrice" in three, "often" many times in one.
    texts = ["twice thrice", "twice thrice", "thrice", "often " * 9]
    table = docs(spark, texts).select("text", F.lit("a").alias("lang"), F.lit("s").alias("source")).coalesce(1)
    counts, words = divergence.group_counts(table)[1:]
    assert [(r.term, r["count"]) for r in counts.join(words, "id").collect()] == [("thrice", 3)]
    assert divergence._bags(table).count() == 1


def test_digest_tells_counts_and_documents_by_fewer_terms(spark):
    from collections import Counter

    rng = random.Random(4)
    rows = [(rng.choice(["en", "fr", ""]), rng.choice(["web", "w\x00", ""]), " ".join(rng.choices(
        ["ab", "", "été", "日本", "often", *map(str.lower, "KLMNOP")], [9, 5, 4, 1, 90, 3, 2, 1, 1, 0.1, 0.1], k=rng.randrange(60)))) for _ in range(300)]
    rows += [("en", "web", "often " * 5000), ("solo", "s", "once"), ("none", "s", ""), ("none", "s", "  ")]
    counts = Counter((a, b, w) for a, b, t in rows for w in t.split())
    held = Counter((a, w) for a, _, t in rows for w in set(t.split()))

    def check(out):
        told, learnt = Counter(), Counter()
        for r in out:
            assert r["terms"] and len(r["terms"]) == len(set(r["terms"])) and (r["source"] is None) == (r["weight"] == 0)
            for w in r["terms"]:
                told[r["lang"], r["source"], w] += r["weight"]
                learnt[r["lang"], w] += r["weight"] == 0
        assert {k: n for k, n in told.items() if n} == counts
        return {k: n for k, n in learnt.items()}

    for kind in (pa.string(), pa.large_string()):
        batch = pa.RecordBatch.from_arrays([pa.array(c, kind) for c in zip(*[("en", "web", "before"), *rows, ("fr", "", "after")], strict=True)],
                                           ["lang", "source", "text"])
        for row_bytes in (20, 1 << 20):
            out = divergence.digest(batch.slice(1, len(rows)), 3, row_bytes).to_pylist()
            assert check(out) == {k: min(n, 3) for k, n in held.items()}
            # A term begins below the limit.
            assert all(sum(len(w.encode()) + 1 for w in r["terms"][:-1]) <= row_bytes for r in out)
        assert divergence.digest(batch.slice(0, 0), 3).num_rows == divergence.digest(batch.slice(len(rows) - 1, 2), 3).num_rows == 0

    # What the model learns from and counts is far less than the texts, whatever the slices that were told apart.
    table = spark.createDataFrame(rows, "lang string, source string, text string").coalesce(1)
    for limit, least in ((1 << 20, 30), (3000, 3)):
        out = divergence._digests(divergence._bags(table), 3, limit).collect()
        assert all(min(n, 3) <= dict(check([r.asDict() for r in out]))[k] <= n for k, n in held.items())
        assert sum(len(r.terms) for r in out) * least < sum(counts.values())
