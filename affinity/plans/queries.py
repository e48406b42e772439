"""Registered queries: one per operator key of the survey inventory.

Each callable takes (spark, sf_dir) and returns a DataFrame over whole tables.
Outputs are shaped for comparison with the SQL oracle: doubles rounded to 6
digits, ranks as BIGINT, nested values as strings.

Spark does not share one computation of a subtree between consumers that
prune it differently (the executed plans show no exchange reuse), so a
binding read by several steps of one query is written once (``_written``);
single-consumer queries read the binding lazily.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.functions.numeric import out
from affinity.functions.shape import joined, joined_in_order
from affinity.operators import baseline as bl
from affinity.operators import content, graph, item_cf, report, stats, user_cf
from affinity.operators.skew import chunked_lists
from affinity.session import materialize, scratch_path
from affinity.sources import bindings as b
from affinity.sources import readers, sinks

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

TARGET_USER = b.TARGET_USER
LOOKUP_ITEM = b.LOOKUP_ITEM
#: Buckets of the hashed ranking of parts: few enough that words of one document collide.
HASHED_FEATURES = 64


def _written(spark, d):
    """The ratings binding written once, for queries with several consumers."""
    return materialize(b.ratings(spark, d), "ratings")


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


# -- ratings: sources and statistics ------------------------------------------------

@query("ratings_load")
def q_ratings_load(spark, d):
    path = sinks.write_ratings_tsv(b.ratings(spark, d), scratch_path(spark, "ratings_tsv"))
    # The binding's ratings are whole numbers; the key returns them as such.
    return readers.read_ratings_tsv(spark, path).withColumn("rating", F.col("rating").cast("int"))


@query("rating_density")
def q_rating_density(spark, d):
    return stats.rating_density(b.ratings(spark, d))


@query("global_mean")
def q_global_mean(spark, d):
    return stats.global_mean(b.ratings(spark, d))


@query("user_means")
def q_user_means(spark, d):
    return stats.user_means(b.ratings(spark, d))


@query("target_ratings")
def q_target_ratings(spark, d):
    return stats.target_ratings(b.ratings(spark, d), TARGET_USER)


@query("unwatched_items")
def q_unwatched_items(spark, d):
    return stats.unwatched_items(_written(spark, d), TARGET_USER)


@query("user_rating_maps")
def q_user_rating_maps(spark, d):
    r = _written(spark, d)
    lists = chunked_lists(r, "user_id", "item_id",
                          F.struct(F.col("item_id"), F.col("rating")), out="entries")
    text = F.array_join(F.transform(
        "entries", lambda e: F.concat_ws(":", e["item_id"].cast("string"),
                                         e["rating"].cast("string"))), ",")
    return lists.select("user_id", "chunk", "n", text.alias("ratings"))


# -- baselines ------------------------------------------------------------------

@query("user_baseline")
def q_user_baseline(spark, d):
    return bl.user_offsets(_written(spark, d))


@query("item_baseline")
def q_item_baseline(spark, d):
    return bl.item_offsets(_written(spark, d))


@query("baseline_grid")
def q_baseline_grid(spark, d):
    return bl.baseline_row(_written(spark, d), TARGET_USER)


@query("baseline_predict")
def q_baseline_predict(spark, d):
    return bl.predictions(_written(spark, d), b.cells(spark, d))


@query("residuals_dense")
def q_residuals_dense(spark, d):
    return bl.residual_table(_written(spark, d))


# -- user CF ----------------------------------------------------------------------

@query("pearson_neighbours")
def q_pearson_neighbours(spark, d):
    nb = user_cf.neighbours(_written(spark, d), TARGET_USER)
    return nb.select("rank", "user_id", out("pc_raw").alias("pc"))


@query("user_cf_estimates")
def q_user_cf_estimates(spark, d):
    est = user_cf.estimates(_written(spark, d), TARGET_USER)
    return est.select("item_id", out("estimate").alias("estimate"))


@query("user_cf_top10")
def q_user_cf_top10(spark, d):
    return user_cf.top_n(user_cf.estimates(_written(spark, d), TARGET_USER))


# -- item CF ----------------------------------------------------------------------

@query("item_similarity")
def q_item_similarity(spark, d):
    return item_cf.item_similarity(_written(spark, d), TARGET_USER)


@query("item_topk")
def q_item_topk(spark, d):
    return item_cf.item_topk(_written(spark, d), TARGET_USER)


@query("item_cf_estimates")
def q_item_cf_estimates(spark, d):
    est = item_cf.item_estimates(_written(spark, d), TARGET_USER)
    return est.select("item_id", out("estimate").alias("estimate"))


@query("item_cf_top10")
def q_item_cf_top10(spark, d):
    return item_cf.item_top_n(_written(spark, d), TARGET_USER)


@query("item_cf_top10_positive")
def q_item_cf_top10_positive(spark, d):
    return item_cf.item_top_n(_written(spark, d), TARGET_USER, positive_only=True)


@query("cf_report")
def q_cf_report(spark, d):
    rep = report.cf_report(_written(spark, d), TARGET_USER)
    lists = ["pearson_neighbours", "pearson_top10", "predicators_top10",
             "predicators_positive_top10"]
    return rep.select(*[joined_in_order(c).alias(c) if c in lists else F.col(c)
                        for c in rep.columns])


# -- click graph: sources --------------------------------------------------------------

def _merged(spark, d, both: bool = True):
    return graph.merge_edges(b.edges(spark, d), b.catalogs(spark, d), b.item_ratings(spark, d), both)


@query("edges_explode")
def q_edges_explode(spark, d):
    path = sinks.write_train_json(b.edges(spark, d), scratch_path(spark, "train_json"))
    return readers.read_train_edges(spark, path)


@query("catalogs_load")
def q_catalogs_load(spark, d):
    path = sinks.write_catalogs_json(b.catalogs(spark, d), scratch_path(spark, "catalogs_json"))
    return readers.read_catalogs(spark, path).withColumn("catalog", F.col("catalog").cast("double"))


@query("catalog_brothers")
def q_catalog_brothers(spark, d):
    path = sinks.write_catalog_path_json(b.brothers(spark, d),
                                         scratch_path(spark, "catalog_path_json"))
    br = readers.read_catalog_path(spark, path)
    return br.select("catalog", joined("brothers").alias("brothers"))


# -- click graph: merge, inspection, adjacency -------------------------------------------

def _comparable(merged):
    """Catalogs are nullable integers; in pandas, Spark turns them into float64
    and DuckDB into nullable Int32. Both sides emit them as DOUBLE so any
    comparison sees the same values and dtypes (the operators keep INT)."""
    return merged.withColumn("catalog1", F.col("catalog1").cast("double")).withColumn(
        "catalog2", F.col("catalog2").cast("double"))


@query("edges_merged")
def q_edges_merged(spark, d):
    return _comparable(_merged(spark, d))


@query("edges_distinct")
def q_edges_distinct(spark, d):
    return stats.edges_distinct(_merged(spark, d))


@query("edges_missing_catalog")
def q_edges_missing_catalog(spark, d):
    return _comparable(stats.missing_catalog(_merged(spark, d)))


@query("edges_missing_catalog_count")
def q_edges_missing_catalog_count(spark, d):
    return stats.missing_catalog_count(_merged(spark, d))


@query("edges_touching_item")
def q_edges_touching_item(spark, d):
    return _comparable(stats.edges_touching(_merged(spark, d), LOOKUP_ITEM))


@query("edge_profile")
def q_edge_profile(spark, d):
    return stats.profile(_merged(spark, d))


@query("edge_quantiles")
def q_edge_quantiles(spark, d):
    return stats.edge_quantiles(_merged(spark, d, both=False))


@query("parents_with_siblings")
def q_parents_with_siblings(spark, d):
    return stats.parents_with_siblings(b.items(spark, d))


@query("adjacency_out")
def q_adjacency_out(spark, d):
    adj = graph.adjacency_out(_merged(spark, d))
    return adj.select("item1", "chunk", "n", joined("neighbours").alias("neighbours"))


@query("adjacency_in")
def q_adjacency_in(spark, d):
    adj = graph.adjacency_in(_merged(spark, d, both=False))
    text = F.array_join(F.transform("sources", lambda s: F.concat_ws(
        ":", s["id"].cast("string"), s["rating"].cast("string"),
        s["catalog"].cast("string"), s["click"].cast("string"))), ",")
    return adj.select("item2", "chunk", "n", text.alias("sources"))


# -- candidates ------------------------------------------------------------------------------

def _target_catalogs(spark, d, via_json: bool = False):
    t = b.targets(spark, d)
    if via_json:
        t = readers.read_test_items(
            spark, sinks.write_test_items_json(t, scratch_path(spark, "test_items_json")))
    return graph.target_catalogs(t, b.catalogs(spark, d))


@query("target_catalogs")
def q_target_catalogs(spark, d):
    return _target_catalogs(spark, d, via_json=True)


@query("candidates_level1")
def q_candidates_level1(spark, d):
    return graph.candidates_level1(_merged(spark, d, both=False), _target_catalogs(spark, d),
                                   b.brothers(spark, d))


@query("candidates")
def q_candidates(spark, d):
    return graph.candidates(_merged(spark, d), _target_catalogs(spark, d), b.brothers(spark, d))


# -- content ranking -------------------------------------------------------------------------

def _part_docs(spark, d):
    return content.item_documents(b.items(spark, d))


def _part_cands(spark, d):
    # The candidate table feeds several branches of the ranking (document
    # sets, term statistics, the ranked pool): written once, read by all.
    cands = graph.candidates(_merged(spark, d), _target_catalogs(spark, d), b.brothers(spark, d))
    return materialize(cands, "candidates")


def _ranked_out(ranked):
    return ranked.select("target", "item", out("cos").alias("cos"),
                         out("ordered").alias("ordered"), "rank")


@query("item_sentences")
def q_item_sentences(spark, d):
    return content.candidate_documents(_part_cands(spark, d), _part_docs(spark, d))


@query("item_words")
def q_item_words(spark, d):
    words = content.item_words(_part_docs(spark, d))
    return words.select("item", joined("words").alias("words"))


@query("tfidf_weights")
def q_tfidf_weights(spark, d):
    w = content.tfidf_weights(_part_cands(spark, d), _part_docs(spark, d))
    return w.select("target", "term", "df", "m", out("idf").alias("idf"))


@query("count_rank")
def q_count_rank(spark, d):
    return _ranked_out(content.rank_candidates(_part_cands(spark, d), _part_docs(spark, d),
                                               "count"))


@query("tfidf_rank")
def q_tfidf_rank(spark, d):
    return _ranked_out(content.rank_candidates(_part_cands(spark, d), _part_docs(spark, d),
                                               "tfidf"))


@query("hashed_tfidf_rank")
def q_hashed_tfidf_rank(spark, d):
    return _ranked_out(content.rank_candidates(_part_cands(spark, d), _part_docs(spark, d),
                                               "hashed", num_features=HASHED_FEATURES))


def _document_cands(spark, d):
    docs = materialize(content.item_documents(b.documents(spark, d)), "item_documents")
    words = content.document_words(docs)
    return materialize(b.document_candidates(spark, d, docs, words), "document_candidates"), docs, words


@query("tfidf_rank_docs")
def q_tfidf_rank_docs(spark, d):
    cands, docs, words = _document_cands(spark, d)
    return _ranked_out(content.rank_candidates(cands, docs, "tfidf", words))


@query("hashed_tfidf_rank_docs")
def q_hashed_tfidf_rank_docs(spark, d):
    cands, docs, words = _document_cands(spark, d)
    return _ranked_out(content.rank_candidates(cands, docs, "hashed", words))


@query("hashing_tfidf_ml")
def q_hashing_tfidf_ml(spark, d):
    rows = content.hashing_tfidf(_part_docs(spark, d))
    pairs = F.transform(F.arrays_zip("buckets", "weights"), lambda x: F.concat_ws(
        ":", x["buckets"].cast("string"), F.format_number(x["weights"], 4)))
    return rows.select("item", F.array_join(pairs, ",").alias("features"))


@query("ranking_overlap")
def q_ranking_overlap(spark, d):
    cands, docs = _part_cands(spark, d), _part_docs(spark, d)
    words = content.member_words(cands, docs)
    ov = content.overlap(content.rank_candidates(cands, docs, "count", words),
                         content.rank_candidates(cands, docs, "tfidf", words))
    return ov.select("target", out("overlap").alias("overlap"))


@query("rec_documents")
def q_rec_documents(spark, d):
    ranked = content.rank_candidates(_part_cands(spark, d), _part_docs(spark, d), "tfidf")
    docs = content.recommendation_documents(ranked)
    text = F.array_join(F.transform(F.array_sort(F.map_entries("recoms")), lambda e: F.concat_ws(
        ":", e["key"], e["value"].cast("string"))), ",")
    return docs.select("item", "chunk", text.alias("recoms"))
