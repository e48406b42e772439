"""The end-to-end jobs on small files in the source formats."""

import json
import os

from affinity.plans import jobs
from affinity.session import scratch_path
from affinity.sources import sinks
from tests.brute import Dense
from tests.conftest import INLINE, TARGET


def _lines(path, rows):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part-0.json"), "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows) + "\n")
    return path


def test_rating_report_job(spark, inline_ratings):
    tsv = sinks.write_ratings_tsv(inline_ratings, scratch_path(spark, "job_tsv"))
    out = jobs.rating_report_job(spark, tsv, TARGET, scratch_path(spark, "job_report"))
    row = out.first()
    assert abs(row["average_rating"] - Dense(INLINE).mu) < 1e-4
    assert row["pearson_neighbours"] == [u for u, _ in Dense(INLINE).neighbours(TARGET)]


def test_graph_and_recommend_jobs(spark, tmp_path):
    d = str(tmp_path)
    train = _lines(f"{d}/train", [
        {"item": "2", "true_recoms": {"1": 5}}, {"item": "3", "true_recoms": {"1": 2}},
        {"item": "4", "true_recoms": {"2": 7, "3": 3}}, {"item": "6", "true_recoms": {"3": 9}},
        {"item": "", "true_recoms": {"9": 1}}])
    cats = _lines(f"{d}/catalogs", [{"itemid": str(i), "catalogid": str(c)} for i, c in
                                    [(1, 11), (2, 21), (3, 11), (4, 21), (6, 11)]])
    rats = _lines(f"{d}/ratings", [{"itemid": 2, "rating": 4.0}, {"itemid": 4, "rating": 3.5}])
    path = _lines(f"{d}/catalog_path", [
        {"catalogid": "11", "catalogpath": [{"11": "a"}, {"21": "b"}]},
        {"catalogid": "21", "catalogpath": [{"11": "a"}, {"21": "b"}]}])
    test = _lines(f"{d}/test", [{"item": "1", "recoms": 0}])
    items = spark.createDataFrame(
        [("1", "10", "red metal bolt"), ("2", "20", "red metal nut"), ("3", "30", "red cup"),
         ("4", "40", "metal red bolt"), ("6", "60", "blue bolt")],
        "itemid string, parent_id string, attr1 string")
    items_path = sinks.write_parquet(items, f"{d}/items")
    written = jobs.graph_ingest_job(spark, train, cats, rats, path, items_path, f"{d}/out")
    # A later ingest into the same folder has lookups of its own.
    other = jobs.graph_ingest_job(spark, _lines(f"{d}/train2", [{"item": "2", "true_recoms": {"1": 5}}]), cats, rats,
                                  path, items_path, f"{d}/out")
    assert spark.read.parquet(other["adjacency_in"]).count() == 1
    assert spark.read.parquet(written["adjacency_in"]).count() == 3
    assert spark.read.parquet(written["merged"]).count() == 5
    recs = jobs.recommend_job(spark, written["merged"], cats, written["catalog_brothers"],
                              items_path, test, f"{d}/rec", adjacency_path=written["adjacency_in"])
    docs = spark.read.json(recs["tfidf"]).collect()
    assert len(docs) == 1 and docs[0]["item"] == "1"
    assert set(docs[0]["recoms"].asDict()) == {"2", "3", "4", "6"}
