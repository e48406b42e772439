import random

from affinity.llm import near_dup
from tests.conftest import SF_SMALL
from tests.llm.helpers import docs, lower, table, words


def brute(rows, width, percent=80):
    """(doc_id, n, component) by comparing every pair of distinct sets."""
    sets = []
    for i, text in rows:
        w = words(lower(text))
        n = min(width, len(w))
        sets.append((i, frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if n else frozenset()))
    kinds = sorted({s for _, s in sets if s}, key=len)
    root = {s: s for s in kinds}

    def find(s):
        while root[s] is not s:
            s = root[s]
        return s
    for k, a in enumerate(kinds):
        for b in kinds[k + 1:]:
            if 100 * len(a) < percent * len(b):
                break
            both = len(a & b)
            if 100 * both >= percent * (len(a) + len(b) - both):
                root[find(a)] = find(b)
    low = {}
    for i, s in sets:
        if s and i is not None:
            low[find(s)] = min(low.get(find(s), i), i)
    return sorted((i, len(s), low.get(find(s)) if s else i) for i, s in sets)


def got(df):
    rows = df.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows if r.component_id is not None)
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows)


def test_brute_force_on_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(f"{SF_SMALL}/documents.parquet")]
    frame = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for width in (2, 5):
        assert got(near_dup.near_duplicates(frame, width=width)) == brute(rows, width)


def test_chains_families_and_copies(spark):
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = []
    for _family in range(6):
        base = [rng.choice(vocabulary) for _ in range(60)]
        for step in range(25):  # each member drifts a little from one before: chains around the threshold
            text = list(base)
            for _ in range(rng.randrange(7)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            if step % 5 == 0:
                base = text
            rows.append((" ".join(text)))
    rows += [rows[3]] * 20 + [rows[40].upper()] * 10
    ids = list(range(1000, 1000 + len(rows)))
    rng.shuffle(ids)
    frame = docs(spark, rows, ids)
    for width in (1, 2):
        expected = brute(list(zip(ids, rows, strict=True)), width)
        assert got(near_dup.near_duplicates(frame, width=width)) == expected
        # The same without broadcasting the ids.
        assert got(near_dup.near_duplicates(frame, width=width, broadcast_nodes=0)) == expected


def test_edges(spark):
    texts = [None, "", " \t\n", "one", "ONE", "one two", "Two  one", "é É", "x " * 5000, "x " * 5000, "x"]
    frame = docs(spark, texts, [5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15])
    assert got(near_dup.near_duplicates(frame, width=2)) == [
        (5, 0, 5), (6, 0, 6), (7, 0, 7), (8, 1, 8), (9, 1, 8), (10, 1, 10), (11, 1, 11), (12, 1, 12), (13, 1, 13),
        (14, 1, 13), (15, 1, 15)]
    nulls = docs(spark, ["a b c", "a b c", "q r s", "q r s", "a b c"], [None, 4, None, None, 4])
    rows = near_dup.near_duplicates(nulls, width=2).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in rows) == [
        ("4", "4", True), ("4", "4", True), ("None", "4", False), ("None", "None", True), ("None", "None", True)]
    assert near_dup.near_duplicates(docs(spark, [])).collect() == []


def test_leader_of_a_bucket_meets_most_nodes(spark):
    # Node 2 shares a bucket with each of the others, which share none: one star around it, not one around node 1.
    rows = [(1, [1, 100]), (2, [1, 2, 3]), (3, [2, 200]), (4, [3, 300]), (5, [400])]
    nodes = spark.createDataFrame(rows, "uid long, bands array<long>")
    assert sorted(map(tuple, near_dup._stars(nodes).collect())) == [(1, 2), (3, 2), (4, 2)]


def test_far_copies_are_not_paired_with_all(spark, monkeypatch):
    rng = random.Random(11)
    base = [f"b{k}" for k in range(120)]
    rows = []
    for i in range(240):  # copies with up to 24 own words, the farthest first
        text = list(base)
        for k in rng.sample(range(120), 24 - i // 10):
            text[k] = f"o{i}x{k}"
        rows.append((i, " ".join(text)))
    met = []

    def counted(df, name, plain=near_dup.written):
        out = plain(df, name)
        if name == "met":
            met.append(out.count())
        return out
    monkeypatch.setattr(near_dup, "written", counted)
    frame = docs(spark, [text for _, text in rows], [i for i, _ in rows])
    assert got(near_dup.near_duplicates(frame, width=5)) == brute(rows, 5)
    assert met[0] < 2 * len(rows)
