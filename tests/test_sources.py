"""Readers of the source formats and round trips through the sinks."""

import json
import os
import tempfile

import pytest

from affinity.sources import readers, sinks
from tests.brute import Dense
from tests.conftest import INLINE, TARGET


def _write_lines(lines):
    d = tempfile.mkdtemp(prefix="affinity-src-")
    p = os.path.join(d, "part-0.json")
    with open(p, "w") as f:
        f.write("\n".join(lines) + "\n")
    return d


def test_train_edges_drop_empty_item(spark):
    d = _write_lines([json.dumps({"item": "1", "true_recoms": {"2": 3, "4": 5}}),
                      json.dumps({"item": "", "true_recoms": {"9": 1}})])
    got = sorted(tuple(r) for r in readers.read_train_edges(spark, d).collect())
    assert got == [(1, 2, 3), (1, 4, 5)]


def test_catalogs_and_paths(spark):
    d = _write_lines([json.dumps({"itemid": "1", "catalogid": "11"}),
                      json.dumps({"itemid": "2", "catalogid": "21"}),
                      json.dumps({"itemid": "x", "catalogid": "31"})])
    assert sorted(tuple(r) for r in readers.read_catalogs(spark, d).collect()) == [(1, 11), (2, 21)]
    p = _write_lines([json.dumps({"catalogid": "11",
                                  "catalogpath": [{"11": "a"}, {"21": "b", "31": "c"}]})])
    row = readers.read_catalog_path(spark, p).first()
    assert row["catalog"] == 11 and sorted(row["brothers"]) == [11, 21, 31]


def test_item_ratings_and_test_items(spark):
    d = _write_lines([json.dumps({"itemid": 1, "rating": 4.5})])
    assert [tuple(r) for r in readers.read_item_ratings(spark, d).collect()] == [(1, 4.5)]
    t = _write_lines([json.dumps({"item": "28", "recoms": 3}), json.dumps({"item": "bad", "recoms": 1})])
    assert [r["item"] for r in readers.read_test_items(spark, t).collect()] == [28]


def _tsv(text):
    d = tempfile.mkdtemp(prefix="affinity-tsv-")
    with open(os.path.join(d, "u.data"), "w") as f:
        f.write(text)
    return d


def test_ratings_tsv_header_and_dedupe(spark):
    d = _tsv("user_id\titem_id\trating\ttimestamp\n1\t10\t3\t100\n1\t10\t5\t200\n2\t10\t4\t50\n")
    got = sorted(tuple(r) for r in readers.read_ratings_tsv(spark, d, header=True).collect())
    assert got == [(1, 10, 5.0), (2, 10, 4.0)]
    # Without the header flag the header line is no rating; it is told, not lost.
    got = sorted(tuple(r) for r in readers.read_ratings_tsv(spark, d, header=False).collect())
    assert got == [(1, 10, 5.0), (2, 10, 4.0)]
    assert [r.line for r in readers.rejected_ratings(spark, d).collect()] == ["user_id\titem_id\trating\ttimestamp"]
    assert readers.rejected_ratings(spark, d, header=True).count() == 0


def test_ratings_tsv_three_columns_and_fractions(spark):
    d = _tsv("1\t10\t3.5\n1\t11\t4.0\n2\t10\t4\n2\tx\t4\n\t5\t5\n")
    for dedupe in (True, False):
        got = sorted(tuple(r) for r in readers.read_ratings_tsv(spark, d, dedupe=dedupe).collect())
        assert got == [(1, 10, 3.5), (1, 11, 4.0), (2, 10, 4.0)]
    assert sorted(r.line for r in readers.rejected_ratings(spark, d).collect()) == ["\t5\t5", "2\tx\t4"]


def test_train_edges_keep_large_clicks_and_good_neighbours(spark):
    d = _write_lines([json.dumps({"item": "1", "true_recoms": {"2": 3_000_000_000, "3": 5, "x": 1}}),
                      json.dumps({"item": "y", "true_recoms": {"2": 7}})])
    got = sorted(tuple(r) for r in readers.read_train_edges(spark, d).collect())
    assert got == [(1, 2, 3_000_000_000), (1, 3, 5)]
    bad = sorted(tuple(r) for r in readers.rejected_edges(spark, d).collect())
    assert bad == [("1", "x", "1"), ("y", "2", "7")]


def test_item_ratings_with_string_ids(spark):
    d = _write_lines([json.dumps({"itemid": 1, "rating": 4.5}), json.dumps({"itemid": "2", "rating": 3}),
                      json.dumps({"itemid": "z", "rating": 3})])
    assert sorted(tuple(r) for r in readers.read_item_ratings(spark, d).collect()) == [(1, 4.5), (2, 3.0)]


def test_round_trips(spark, inline_ratings):
    from affinity.session import scratch_path

    p = sinks.write_parquet(inline_ratings, scratch_path(spark, "t"))
    assert readers.read_parquet(spark, p).count() == len(INLINE)
    sinks.write_if_absent(inline_ratings.limit(1), p)  # already there: left alone
    assert readers.read_parquet(spark, p).count() == len(INLINE)
    tsv = sinks.write_ratings_tsv(inline_ratings, scratch_path(spark, "tsv"))
    assert readers.read_ratings_tsv(spark, tsv).count() == len(INLINE)
    edges = spark.createDataFrame([(1, 2, 3), (1, 4, 5), (2, 4, 1)], "item1 long, item2 long, click long")
    tj = sinks.write_train_json(edges, scratch_path(spark, "train"))
    assert sorted(tuple(r) for r in readers.read_train_edges(spark, tj).collect()) == [
        (1, 2, 3), (1, 4, 5), (2, 4, 1)]
    assert spark.read.json(tj).count() == 2  # no line that stands for no edge


def test_report_and_documents_json(spark, inline_ratings):
    from affinity.operators import report
    from affinity.session import scratch_path

    p = sinks.write_report(report.cf_report(inline_ratings, TARGET), scratch_path(spark, "report"))
    docs = [json.loads(line) for f in os.listdir(p.replace("file:", "")) if f.endswith(".json")
            for line in open(os.path.join(p.replace("file:", ""), f))]
    assert len(docs) == 1 and docs[0]["pearson_neighbours"] == [u for u, _ in Dense(INLINE).neighbours(TARGET)]


def test_managed_table_created_once(spark, inline_ratings):
    import uuid

    name = f"ratings_{uuid.uuid4().hex[:8]}"
    assert sinks.save_table_if_absent(inline_ratings, name) is True
    assert sinks.save_table_if_absent(inline_ratings.limit(1), name) is False
    assert spark.table(name).count() == len(INLINE)
    spark.sql(f"DROP TABLE {name}")


def test_train_json_chunks_hot_items(spark):
    from affinity.session import scratch_path

    edges = spark.createDataFrame([(1, j, j % 7 + 1) for j in range(2, 60)] + [(2, 1, 4)],
                                  "item1 long, item2 long, click long")
    p = sinks.write_train_json(edges, scratch_path(spark, "train_chunks"), chunk_size=10)
    raw = spark.read.json(p)
    assert raw.where("item = '1'").count() > 1          # item 1 split over several lines
    got = sorted(tuple(r) for r in readers.read_train_edges(spark, p).collect())
    assert got == sorted(tuple(r) for r in edges.collect())


def test_configured_checkpoint_folder_is_kept(spark):
    from affinity.session import ensure_checkpoint_dir, scratch_path

    current = spark.sparkContext.getCheckpointDir()
    assert ensure_checkpoint_dir(spark, fallback="/tmp/somewhere-else") == current
    assert scratch_path(spark, "x").startswith(current.rstrip("/") + "/tables/x-")


def test_rejects_of_every_json_source_come_back(spark, tmp_path):
    files = {
        "train": ['{"item":"1","true_recoms":{"2":3,"x":1}}', '{"item":"","true_recoms":{"9":1}}', "not json", "",
                  '{"true_recoms":{"1":1}}'],
        "catalogs": ['{"itemid":"1","catalogid":"11"}', '{"itemid":"2"}', '{"itemid":"x","catalogid":"1"}',
                     '{"itemid":"3","catalogid":"y"}', '{"itemid":'],
        "catalog_path": ['{"catalogid":"11","catalogpath":[{"11":"a"},{"z":"b"}]}', '{"catalogid":"q"}', "[]",
                         '{"catalogid":"12"}'],
        "item_ratings": ['{"itemid":1,"rating":4.5}', '{"itemid":"2"}', '{"itemid":3,"rating":"bad"}', "{}"],
        "test_items": ['{"item":"1","recoms":0}', '{"item":"one"}', "7"],
    }
    want = {
        "train": {'{"item":"1","k":"x","v":"1"}', "not json", '{"true_recoms":{"1":1}}'},
        "catalogs": {'{"itemid":"x","catalogid":"1"}', '{"itemid":"3","catalogid":"y"}', '{"itemid":'},
        "catalog_path": {'{"catalogid":"11","catalogpath":[{"11":"a"},{"z":"b"}]}', '{"catalogid":"q"}', "[]"},
        "item_ratings": {'{"itemid":3,"rating":"bad"}', "{}"},
        "test_items": {'{"item":"one"}', "7"},
    }
    paths = {}
    for name, lines in files.items():
        folder = tmp_path / name
        folder.mkdir()
        (folder / "part-0.json").write_text("\n".join(lines) + "\n")
        paths[name] = str(folder)
        assert {r.line for r in readers.rejected(spark, name, paths[name]).collect()} == want[name]
    assert {tuple(r) for r in readers.read_catalogs(spark, paths["catalogs"]).collect()} == {(1, 11), (2, None)}
    assert {tuple(r) for r in readers.read_item_ratings(spark, paths["item_ratings"]).collect()} == {(1, 4.5), (2, None)}
    assert {(r.catalog, tuple(r.brothers)) for r in readers.read_catalog_path(spark, paths["catalog_path"]).collect()} == {
        (11, (11,)), (12, ())}
    assert [tuple(r) for r in readers.read_train_edges(spark, paths["train"]).collect()] == [(1, 2, 3)]
    assert [r["item"] for r in readers.read_test_items(spark, paths["test_items"]).collect()] == [1]


def test_scope_removes_what_a_job_wrote(spark):
    import os

    from affinity.session import materialize, scope, scratch_path

    paths = []

    @scope
    def inner(spark):
        paths.append(scratch_path(spark, "inner"))
        spark.range(3).write.parquet(paths[-1])
        return spark.read.parquet(paths[-1])

    @scope
    def outer(spark, fail):
        n = inner(spark).count()  # the inner job's tables live as long as the outer one
        materialize(spark.range(2), "outer")
        if fail:
            raise KeyError("job")
        return n

    assert outer(spark, False) == 3
    with pytest.raises(KeyError):
        outer(spark, True)
    assert not any(os.path.exists(p.removeprefix("file:")) for p in paths)
    kept = materialize(spark.range(2), "kept")  # outside of a scope nothing is removed
    assert kept.count() == 2
