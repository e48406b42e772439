"""Decontamination, mixing and secret scans against brute force on small tables."""

import hashlib
import itertools
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from affinity.llm import decontam, mixing, secrets
from tests.conftest import SF_SMALL
from tests.llm.helpers import docs, table, words


# -- decontamination

def overlaps(texts, items, window=13, percent=80):
    """Every window of every item against every place of every text, without seeds."""
    split = lambda t: words((t or "").lower())
    out = {}
    for item, body in items:
        b = split(body)
        n = min(window, len(b))
        if n < 5:
            continue
        for doc, text in texts:
            w = split(text)
            if n >= 10 and len(w) < 10:
                continue
            places = {x: [i for i, y in enumerate(w) if y == x] for x in set(b)}
            for shift in {i - j for j, x in enumerate(b) for i in places[x]}:
                equal = [0 <= shift + j < len(w) and w[shift + j] == x for j, x in enumerate(b)]
                for a in range(len(b) - n + 1):
                    same = sum(equal[a:a + n])
                    if same * 100 >= n * (percent if n >= 10 else 100):
                        key = (n, same, -max(0, shift + a))
                        out[doc, item] = max(out.get((doc, item), key), key)
    return sorted((*k, n, same, -back) for k, (n, same, back) in out.items())


def bench(spark, rows):
    return spark.createDataFrame([(i, t, 0, "c", 1) for i, t in rows],
                                 "item_id long, text string, doc_id int, w string, h int")


def test_overlaps_with_replaced_words(spark):
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(60)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(n))) for k, n in enumerate((9, 10, 12, 20, 40))]
    items += [(5, None), (6, ""), (7, items[3][1]), (7, items[3][1])]
    texts = []
    for k in range(60):
        w = [rng.choice(vocabulary) for _ in range(rng.randrange(60))]
        part = words(items[k % 5][1])
        for _ in range(k % 6):
            part[rng.randrange(len(part))] = "other"
        at = rng.randrange(len(w) + 1)
        texts.append((k, " ".join(w[:at] + part + w[at:]).upper() if k % 3 else "\t".join(part)))
    texts += [(60, None), (61, ""), (62, "a " * 3000), (63, items[4][1] + " x" * 20_000)]
    frame = docs(spark, [t for _, t in texts], [i for i, _ in texts])
    expected = overlaps(texts, {x for x in items if x[1]})
    assert len({d for d, *_ in expected}) > 20
    assert any(n < 10 for _, _, n, *_ in expected) and any(same < n for _, _, n, same, _ in expected)
    got = sorted(map(tuple, decontam.find_overlaps(frame, bench(spark, items)).collect()))
    assert {x[:2] for x in got} <= {x[:2] for x in expected}
    assert len(set(got) & set(expected)) >= 0.97 * len(expected)
    shuffled = decontam.find_overlaps(frame, bench(spark, items), broadcast_seeds=0)
    assert sorted(map(tuple, shuffled.collect())) == got
    assert decontam.find_overlaps(frame, bench(spark, [])).collect() == []
    assert decontam.find_overlaps(docs(spark, []), bench(spark, items)).collect() == []


def test_recall_of_replaced_words(spark):
    """Passages of 13 words and more, every choice of replaced words that leaves 80 % equal."""
    item = [f"w{k}" for k in range(40)]
    texts = []
    for n, replaced in ((13, 1), (13, 2), (15, 3), (20, 3)):
        for places in itertools.combinations(range(n), replaced):
            part = [f"x{k}" if k in places else item[7 + k] for k in range(n)]
            texts.append((len(texts), " ".join(["before", *part, "after"])))
    frame = docs(spark, [t for _, t in texts], [i for i, _ in texts])
    found = {r.doc_id for r in decontam.find_overlaps(frame, bench(spark, [(1, " ".join(item))])).collect()}
    wanted = {d for d, *_ in overlaps(texts, [(1, " ".join(item))])}
    assert len(wanted) > 1200 and found <= wanted
    assert len(found) >= 0.995 * len(wanted)


def test_overlaps_of_null_and_repeated_ids(spark):
    rng = random.Random(11)
    line = lambda n: " ".join(f"w{rng.randrange(500)}" for _ in range(n))
    items = [(None, line(20)), (None, line(25)), (1, line(20)), (1, line(30))]
    texts = [(None, line(30)), (None, line(5) + " " + items[0][1]), (2, line(50)), (2, line(9) + " " + items[3][1]),
             (2, items[1][1] + " " + line(3)), (None, items[2][1]), (None, items[2][1]), (3, items[0][1])]
    frame = docs(spark, [t for _, t in texts], [i for i, _ in texts])
    # overlaps() sorts its rows, so null ids go in as -1.
    number = lambda rows: [(-1 if i is None else i, t) for i, t in rows]
    null = lambda i: None if i == -1 else i
    expected = {(null(d), null(i)): tuple(x) for d, i, *x in overlaps(number(texts), number(items))}
    assert {(None, None), (2, None), (None, 1), (2, 1), (3, None)} == set(expected)
    for seeds in (decontam.BROADCAST_SEEDS, 0):
        got = {(r.doc_id, r.item_id): (r.n_words, r.n_equal, r.start)
               for r in decontam.find_overlaps(frame, bench(spark, items), broadcast_seeds=seeds).collect()}
        assert got == expected


def test_item_ids_of_one_text_are_broadcast_up_to_the_bound_only(spark):
    """The seeds bound the texts of items, not the ids of items that share one."""
    line = " ".join(f"w{k}" for k in range(20))
    frame, items = docs(spark, [line, "x " + line]), bench(spark, [(k, line) for k in range(60)])
    hinted = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("strategy=broadcast")
    # The text has 33 seeds.
    many, few = (decontam.find_overlaps(frame, items, broadcast_seeds=n) for n in (40, 100))
    assert (hinted(many), hinted(few)) == (2, 3)
    assert sorted(many.collect()) == sorted(few.collect()) and many.count() == 120


# -- mixing

def targets(sizes, percent=150):
    """The contract's targets, by resharing what is above a limit until nothing is."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, open_, out = sum(sizes.values()) * percent / 100, set(sizes), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not above:
            return out | share
        for s in above:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= above
    return out


def check_mix(spark, frame, rows):
    size = Counter()
    for _, text, source in rows:
        size[source] += len(words(text))
    goal = targets(size)
    got = mixing.plan(frame, keep=["source"], block_rows=7).collect()
    again = mixing.plan(frame.repartition(3), keep=["source"], block_rows=7).collect()
    assert Counter(map(str, got)) == Counter(map(str, again))
    assert Counter((r.doc_id, r.size, r.keep_source) for r in got) == Counter((i, len(words(t)), s) for i, t, s in rows)
    taken, largest = Counter(), Counter()
    for r in got:
        assert r.source_size == size[r.keep_source] and r.target == pytest.approx(goal[r.keep_source])
        assert r.taken == r.size * len(r.positions) and r.taken <= 2 * r.size
        assert all(0 <= p <= 1 for p in r.positions) and r.positions == sorted(r.positions)
        taken[r.keep_source] += r.taken
        largest[r.keep_source] = max(largest[r.keep_source], r.size)
    for s in size:
        assert abs(taken[s] - goal[s]) <= largest[s] / 2 + 1e-6
    return got


def test_mix_of_documents(spark):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in table(f"{SF_SMALL}/documents.parquet")]
    got = check_mix(spark, spark.read.parquet(f"{SF_SMALL}/documents.parquet"), rows)
    frame = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    mixed = mixing.mix(frame)
    assert mixed.columns == frame.columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({r.doc_id: len(r.positions) for r in got if r.positions})


def test_mix_edges_and_schedules(spark):
    rng = random.Random(1)
    rows = [(k if k % 5 else None, "x " * rng.choice((0, 1, 30, 3000)), rng.choice(("b", "a", None, "ß", "Z")))
            for k in range(200)] + [(7, None, "a"), (7, None, "a"), (8, "w " * 50_000, "hot"), (9, "", "nothing")]
    frame = spark.createDataFrame([(*r, 1, 2.0) for r in rows],
                                  "doc_id long, text string, source string, size int, target double")
    got = check_mix(spark, frame, rows)
    # The demand up to a position, integrated anew, is what stands before the document.
    first, last = mixing.SCHEDULES[0]
    a = sorted((p, r.size) for r in got for p in r.positions if r.keep_source == "Z")
    goal = next(r.target for r in got if r.keep_source == "Z")
    before = 0
    for p, n in a:
        demand = goal * (first * p + (last - first) * p * p / 2) / ((first + last) / 2)
        assert demand == pytest.approx(before + n / 2, abs=1e-6 * goal + 1e-6)
        before += n
    assert mixing.plan(frame.limit(0)).collect() == [] and mixing.mix(frame.limit(0)).collect() == []


def test_mix_of_ids_that_overfill_a_block(spark):
    """A third of the rows without an id, one id over many rows: dealt over slices, whatever the partitions."""
    rng = random.Random(3)
    rows = [(None if k % 3 == 0 else 5 if k % 7 == 0 else k, "x " * rng.choice((0, 2, 9)), "hot" if k % 4 else None)
            for k in range(3000)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, source string, at string, "
                                                                "part int").repartition(5)
    check_mix(spark, frame, rows)
    placed = frame.select("doc_id", mixing.text_size(F.col("text")).alias("size"), "source",
                          F.lit(0.25).alias("at"), F.monotonically_increasing_id().alias("deal"), F.lit(0).alias("block"))
    sliced, slices = mixing._sliced(mixing.written(placed, "placed"), 7)
    counts = [r["count"] for r in sliced.groupBy("source", *slices).count().collect()]
    assert sum(counts) == 3000 and max(counts) < 30


# -- secrets

PATTERNS = {"assign": re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                                 re.I | re.A), "access": re.compile("AKIA[A-Z0-9]+"), "hex": re.compile("[0-9a-f]+")}


def base_spans(text):
    out = []
    for k, (kind, p) in enumerate(PATTERNS.items()):
        for m in p.finditer(text or ""):
            if len(m[2] if kind == "assign" else m[0]) >= (8, 16, 32)[k]:
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [s for *_, s in sorted(out)]


def check_spans(frame, texts):
    rows = secrets.scan(frame).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = base_spans(texts[r.doc_id])
        kinds = Counter(s.split(":")[0] for s in spans)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(kinds[k] for k in PATTERNS)
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        listed = r.spans.split(",") if r.spans else []
        assert [s for s in listed if not s.startswith("markov")] == spans and len(listed) - len(spans) == r.n_markov
        assert listed == sorted(listed, key=lambda s: int(s.split(":")[1])) or len(listed) > 1
    return {r.doc_id: r for r in rows}


def test_spans_of_documents(spark):
    texts = {r["doc_id"]: r["text"] for r in table(f"{SF_SMALL}/documents.parquet")}
    check_spans(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), texts)


def test_span_edges_and_models(spark):
    rng = random.Random(9)
    key = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    texts = [None, "", "é password='" + key(20) + "' ü", "token: abc token=secret:abcdefghij", "AKIA" * 6, "AKIAX AKIAY",
             key(31), key(32) * 3, "PassWD = " + key(9) + "\npassword=" + key(7), "api_key:" + key(8) + "apikey=" + key(8),
             "api\U0001F600token=" + "a" * 8, "x" * 50_000, "plain words and generalidentifiername only",
             "noise " + key(24) + " here", "number 4785380592391139"]
    texts += [f"password={key(18)} AKIA{key(16).upper()} token={key(40)}" for _ in range(60)]
    texts += ["understandably considerations internationally extraordinarily " + str(rng.randrange(10 ** 15, 10 ** 16))
              for _ in range(60)]
    got = check_spans(docs(spark, texts), dict(enumerate(texts)))
    assert got[13].n_markov == 1 and got[13].spans == "markov:6:30"
    assert got[6].n_markov == 1  # random, though too short for the pattern
    assert not any(got[k].n_markov for k in (0, 1, 14, *range(75, 135)))
    assert secrets.scan(docs(spark, [])).collect() == []
    nothing = secrets.train(docs(spark, []).select("text", "h").withColumnRenamed("h", "is_random"))
    assert set(nothing) == {0.0}
    assert secrets.scan(docs(spark, ["a" * 40]), table=nothing).first().n_markov == 0
