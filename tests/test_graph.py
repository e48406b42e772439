"""Graph operators, exact quantiles and the skew helpers."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from affinity.operators import graph, stats
from affinity.operators.skew import (chunked_lists, distinct_rows, order_statistics, pair_tasks, rank_within, salted_pairs,
                                     task_count)


def _index(values, share):
    n = len(values)
    return sorted(values)[n // 2 + (n // 4 if share == 0.75 else 0)] if n else None


def test_order_statistics(spark):
    rng = random.Random(3)
    lists = {"few": [5.0], "odd": [3.0, 1.0, 2.0], "ties": [1.0] * 50 + [2.0] * 3, "none": [],
             "even": [rng.random() for _ in range(2000)], "hot": [7.0] * 900 + [rng.gauss(0, 9) for _ in range(1100)]}
    df = spark.createDataFrame([(k, v) for k, vs in lists.items() for v in [*vs, None]], "kind string, value double")
    wanted = {f"{k}{int(100 * s)}": (k, s) for k in lists for s in (0.5, 0.75)}
    for accuracy in (100_000, 1000):  # all values inside the bounds, and the sketch's bounds
        row = order_statistics(df, wanted, accuracy=accuracy).first()
        assert {k: row[k] for k in wanted} == {k: _index(lists[of], s) for k, (of, s) in wanted.items()}
    assert order_statistics(df.where("false"), {"p": ("few", 0.5)}).first().p is None


def test_salted_pairs_hot_group_equals_plain(spark):
    rows = [(1, i, float(i)) for i in range(40)] + [(2, i, 1.0) for i in range(5)]
    df = spark.createDataFrame(rows, "g long, m long, x double")
    df = df.join(df.groupBy("g").agg(F.count(F.lit(1)).alias("n")), "g")
    salted = salted_pairs(df, "g", "m", ["x"], "n", block=6)   # group 1 takes the hot path
    plain = (df.alias("a").join(df.alias("b"), "g").where(F.col("a.m") != F.col("b.m"))
             .select("g", F.col("a.m").alias("m_1"), F.col("b.m").alias("m_2")))
    got = sorted(tuple(r) for r in salted.select("g", "m_1", "m_2").collect())
    want = sorted(tuple(r) for r in plain.collect())
    assert got == want and len(got) == 40 * 39 + 5 * 4
    unordered = salted_pairs(df, "g", "m", ["x"], "n", block=6, unordered=True)
    assert unordered.count() == len(want) // 2


def test_chunked_lists_split_and_cover(spark):
    rows = [(1, i) for i in range(100)] + [(2, 7)]
    df = spark.createDataFrame(rows, "k long, v long")
    out = chunked_lists(df, "k", "v", F.col("v"), chunk_size=16).collect()
    chunks = [r for r in out if r["k"] == 1]
    assert len(chunks) > 1 and max(len(r["entries"]) for r in chunks) < 100
    assert sorted(v for r in chunks for v in r["entries"]) == list(range(100))
    assert all(r["n"] == 100 for r in chunks)


def test_rank_within_matches_window(spark):
    rows = [(1, i, float(i % 7)) for i in range(300)] + [(2, i, 1.0) for i in range(3)]
    df = spark.createDataFrame(rows, "g long, item long, s double")
    order = [F.desc("s"), F.asc("item")]
    got = {(r["g"], r["item"]): r["rank"] for r in rank_within(df, "g", order, partitions=5).collect()}
    w = Window.partitionBy("g").orderBy(*order)
    want = {(r["g"], r["item"]): r["rn"]
            for r in df.withColumn("rn", F.row_number().over(w)).collect()}
    assert got == want


def _small_graph(spark):
    # Edges source -> destination with clicks; catalogs; one target (item 1, catalog 11).
    edges = spark.createDataFrame(
        [(2, 1, 5), (3, 1, 2), (4, 2, 7), (5, 2, 1), (6, 3, 9), (4, 3, 3), (1, 4, 8), (7, 1, 1)],
        "item1 long, item2 long, click long")
    catalogs = spark.createDataFrame(
        [(1, 11), (2, 21), (3, 11), (4, 21), (5, 99), (6, 11), (7, 99)], "item long, catalog int")
    ratings = spark.createDataFrame([(2, 4.0), (4, 3.5)], "itemid long, rating double")
    brothers = spark.createDataFrame([(11, [11, 21]), (21, [11, 21]), (99, [99])],
                                     "catalog int, brothers array<int>")
    targets = spark.createDataFrame([(1,)], "item long")
    merged = graph.merge_edges(edges, catalogs, ratings)
    return merged, graph.target_catalogs(targets, catalogs), brothers


def test_merge_edges_left_joins(spark):
    merged, _, _ = _small_graph(spark)
    row = merged.where("item1 = 2 AND item2 = 1").first()
    assert (row["catalog1"], row["rating1"], row["catalog2"], row["rating2"]) == (21, 4.0, 11, None)
    assert merged.count() == 8
    assert stats.missing_catalog_count(merged).first()["n_edges"] == 0


def test_candidates_rule(spark):
    merged, tcat, brothers = _small_graph(spark)
    got = {r["item"]: (r["level"], r["click"], r["catalog"])
           for r in graph.candidates(merged, tcat, brothers).collect()}
    # level 1: 2 (catalog 21) and 3 (11) kept, 7 (99) dropped; level 2: sources of 2 and 3:
    # 4 (kept, best click 7 via 2), 5 (99, dropped), 6 (11, kept); the target never appears.
    assert got == {2: (1, 5, 21), 3: (1, 2, 11), 4: (2, 7, 21), 6: (2, 9, 11)}
    lvl1 = {r["item"] for r in graph.candidates_level1(merged, tcat, brothers).collect()}
    assert lvl1 == {2, 3}


def test_adjacency(spark):
    merged, _, _ = _small_graph(spark)
    out = {r["item1"]: r["neighbours"] for r in graph.adjacency_out(merged).collect()}
    assert out[4] == [2, 3]
    inn = {r["item2"]: r["sources"] for r in graph.adjacency_in(merged).collect()}
    assert [s["id"] for s in inn[1]] == [2, 3, 7]
    assert inn[1][0]["rating"] == 4.0 and inn[1][2]["catalog"] == 99


def test_candidates_deeper_levels(spark):
    # Chain 4 -> 3 -> 2 -> 1 (target 1), plus a shortcut 4 -> 2: item 4 is level 2, not 3.
    edges = spark.createDataFrame([(2, 1, 1), (3, 2, 2), (4, 3, 3), (4, 2, 9), (5, 4, 4)],
                                  "item1 long, item2 long, click long")
    catalogs = spark.createDataFrame([(i, 11) for i in range(1, 6)], "item long, catalog int")
    ratings = spark.createDataFrame([(1, 1.0)], "itemid long, rating double")
    brothers = spark.createDataFrame([(11, [11])], "catalog int, brothers array<int>")
    merged = graph.merge_edges(edges, catalogs, ratings)
    tcat = graph.target_catalogs(spark.createDataFrame([(1,)], "item long"), catalogs)
    got = {r["item"]: (r["level"], r["click"]) for r in
           graph.candidates(merged, tcat, brothers, max_level=4).collect()}
    assert got == {2: (1, 1), 3: (2, 2), 4: (2, 9), 5: (3, 4)}
    assert {r["item"] for r in graph.candidates(merged, tcat, brothers, max_level=2).collect()} == {2, 3, 4}


def test_levels_read_the_adjacency_in_place(spark):
    """No exchange between the bucketed adjacency and the join, however the other side is joined."""
    rev = spark.createDataFrame([(i % 7, i, 1.0, 1, i) for i in range(500)] + [(3, 1000 + i, 1.0, 1, 1) for i in range(900)],
                                "item2 long, id long, rating double, catalog int, click long")
    adjacency = graph.lay_out(rev, block=100, buckets=4)
    sizes = {r.item2: r.parts for r in adjacency.parts.collect()}
    assert sizes[3] == -(-(900 + 71) // 100) and sizes[0] == 1
    frontier = spark.createDataFrame([(50, 3), (50, 0), (51, 3), (51, -1)], "target long, item long")
    allowed = spark.createDataFrame([(50, 1), (51, 1)], "target long, catalog int")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        step = graph._sources(frontier, adjacency, allowed, 1)
        got = {tuple(r) for r in step.select("target", "item").collect()}
        plan = step._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    want = {r["id"] for r in rev.where("item2 = 3").collect()}
    assert got == {(50, i) for i in want | {r["id"] for r in rev.where("item2 = 0").collect()}} | {(51, i) for i in want}
    final = plan.split("Initial Plan")[0]
    lines = final.splitlines()
    scan = next(k for k, line in enumerate(lines) if "FileScan parquet" in line and "part#" in line and "Bucketed: true" in line)
    # Walk up the plan from the scan to the first join.
    depth = lambda line: len(line) - len(line.lstrip(" :+-*|"))
    above, at = [], depth(lines[scan])
    for line in reversed(lines[:scan]):
        if depth(line) < at:
            at = depth(line)
            above.append(line)
            if "Join" in line:
                break
    assert "Join" in above[-1] and not any("Exchange" in line for line in above)


def test_tasks_grow_with_the_rows(spark):
    session = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = spark.range(6000).select(F.lit(1).alias("g"), F.col("id").alias("m"), F.lit(6000).alias("n"))
    assert pair_tasks(df, "n") == 18 > session  # 36 million pairs, two million a task
    assert task_count(spark, None) == task_count(spark, 5) == session
    text = salted_pairs(df, "g", "m", [], "n")._jdf.queryExecution().analyzed().toString()
    assert text.count(", 18") == 2
    rows = spark.createDataFrame([(1, 2, 3), (1, 2, 3), (1, 2, 4), (None, 2, 3), (None, 2, 3)], "a int, b int, c int")
    got = distinct_rows(rows, ["a", "b"])
    assert sorted(map(str, got.collect())) == sorted(map(str, rows.distinct().collect()))
    assert "RepartitionByExpression [a" in got._jdf.queryExecution().analyzed().toString()


def test_one_level_writes_the_lists_of_the_targets_only(spark, monkeypatch):
    merged = spark.createDataFrame([(1, 5, 1.0, 2, 3), (2, 5, 2.0, 2, 1), (3, 5, 2.0, 4, 1), (None, 5, 1.0, None, 1)],
                                   "item1 long, catalog1 int, rating1 double, item2 long, click long")
    tcat = spark.createDataFrame([(2, 5), (2, 5)], "item long, catalog int")
    brothers = spark.createDataFrame([(5, [5])], "catalog int, brothers array<int>")
    written = {}
    monkeypatch.setattr(graph, "materialize", lambda df, name: written.setdefault(name, df))
    got = sorted(map(tuple, graph.candidates_level1(merged, tcat, brothers).select("target", "item", "click").collect()))
    assert got == [(2, 1, 3)]
    assert {r.item2 for r in written["source_records"].collect()} == {2}


def test_merge_of_one_end_gives_the_same_source_records(spark):
    edges = spark.createDataFrame([(1, 2, 3), (2, 1, 1), (4, 1, 2)], "item1 long, item2 long, click long")
    catalogs = spark.createDataFrame([(1, 7), (2, None), (2, 8)], "item long, catalog int")
    ratings = spark.createDataFrame([(1, 2.5)], "itemid long, rating double")
    half, full = (graph.merge_edges(edges, catalogs, ratings, both) for both in (False, True))
    assert "catalog2" not in half.columns
    one, two = (sorted(map(tuple, stats.reverse_adjacency_rows(m).collect())) for m in (half, full))
    assert one == two and len(one) == 4


def test_walkable_edges_give_the_same_candidates(spark):
    rng = random.Random(8)
    catalog = {i: rng.choice([None, 11, 12, 21, 22, 31, 0]) for i in range(60)}
    edges = spark.createDataFrame([(rng.randrange(64), rng.randrange(64), rng.randrange(1, 9)) for _ in range(900)],
                                  "item1 long, item2 long, click long")
    cats = spark.createDataFrame([*catalog.items(), (5, 12), (5, 22)], "item long, catalog int")
    rated = spark.createDataFrame([(i, float(i % 5)) for i in range(50)], "itemid long, rating double")
    # Relations that overlap, one over two rows, one that lacks its own catalog, one with the 0 of missing ones.
    brothers = spark.createDataFrame([(11, [11, 21]), (11, [31]), (12, [12, 22]), (22, [12, 22]), (21, [31]), (31, [0, 11])],
                                     "catalog int, brothers array<int>")
    tcat = graph.target_catalogs(spark.createDataFrame([(i,) for i in range(0, 60, 4)], "item long"), cats)
    one, both = (graph.merge_edges(edges, cats, rated, b) for b in (False, True))
    want = sorted(map(tuple, graph.candidates(one, tcat, brothers, 3).collect()))
    assert sorted(map(tuple, graph.candidates(both, tcat, brothers, 3).collect())) == want and want
    kept = graph.walkable(both, tcat, brothers)
    assert kept.columns == both.columns and 0 < kept.count() < both.count()
    assert graph.walkable(both, tcat.where("false"), brothers).count() == 0
