"""Content ranking of candidates by the text of their attributes.

Per target, its document set is the target plus its candidates. A document is
the lower-cased, trimmed attributes of an item joined by blanks; its terms are
the distinct tokens. Three weightings:

* count: every present term weighs 1 (binary term counts);
* tf-idf: weight = tf * ln((m + 1) / (df + 1)), m and df counted *within the
  target's document set* (statistics are per target, not per corpus);
* hashed: the same over hash buckets, in which colliding words add up.

Similarity is a cosine over the *shared* terms only (norms too); 0 when fewer
than two terms are shared or when the ratio is 0/0. Candidates are ranked per
target by cosine DESC, then 100 + click * rating DESC, then item.

Everything is joins and aggregates over (target, item, term) rows restricted to
the target's own terms, which arrays are intersected for first, in blocks of
targets; no per-target loop.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.functions.numeric import safe_ratio, stable
from affinity.functions.text import distinct_tokens, sentence
from affinity.operators.skew import checked_broadcast, chunked_lists, rank_within
from affinity.session import bucketed, materialize, scratch_path, shuffles_let_go

# Fixed value: the score offset of the output documents.
SCORE_BASE = 100
#: Terms of the targets that are broadcast at once (with their weights some 100 bytes each).
BLOCK_TERMS = 500_000


def attribute_columns(items: DataFrame) -> list[str]:
    """attr1..attrN in numeric order."""
    cols = [c for c in items.columns if c.startswith("attr") and c[4:].isdigit()]
    return sorted(cols, key=lambda c: int(c[4:]))


def item_documents(items: DataFrame, attrs: Sequence[str] | None = None) -> DataFrame:
    """(item, parent, sentence): one document per item.

    ``itemid`` and ``parent_id`` may be strings or numbers; a missing parent
    becomes -1, so two parentless items count as siblings.  Of several rows of
    an item the one with the smallest parent, then sentence, stands.
    """
    attrs = list(attrs) if attrs else attribute_columns(items)
    rows = items.select(
        F.col("itemid").try_cast("bigint").alias("item"),
        F.coalesce(F.col("parent_id").try_cast("bigint"), F.lit(-1).cast("bigint")).alias("parent"),
        sentence(attrs).alias("sentence")).where(F.col("item").isNotNull())
    first = F.min(F.struct("parent", "sentence")).alias("first")
    return rows.groupBy("item").agg(first).select("item", "first.parent", "first.sentence")


def item_words(docs: DataFrame) -> DataFrame:
    """(item, words): distinct tokens of each document."""
    return docs.select("item", distinct_tokens("sentence").alias("words"))


def document_set(cands: DataFrame) -> DataFrame:
    """(target, item, level, click, rating): candidates plus the target itself
    (level 1, click 0, rating 0.0)."""
    c = cands.select("target", "item", "level", "click", "rating")
    own = (cands.select("target").distinct()
           .select("target", F.col("target").alias("item"), F.lit(1).alias("level"),
                   F.lit(0).cast("bigint").alias("click"), F.lit(0.0).alias("rating")))
    return c.unionByName(own)


def candidate_documents(cands: DataFrame, docs: DataFrame) -> DataFrame:
    """(target, item, parent, level, click, rating, sentence) for each document set."""
    return document_set(cands).join(docs, "item").select(
        "target", "item", "parent", "level", "click", "rating", "sentence")


def by_item(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` as a table laid out by item: no join on the item shuffles it."""
    return bucketed(rows, name, ["item"], int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), distinct=False)


def document_words(docs: DataFrame) -> DataFrame:
    """(item, words) of all documents, written once by item: terms are read from it, not from the texts again."""
    return by_item(item_words(docs), "document_words")


def member_words(cands: DataFrame, docs: DataFrame, written: bool = True) -> DataFrame:
    """(item, words) for every document that is in some target's document set.

    Only member documents are tokenised (a semi join on the member ids), and
    only once: the words are read by several later steps, so they are written to
    the shared checkpoint folder.
    """
    ids = document_set(cands).select("item").distinct()
    words = item_words(docs.join(ids, "item", "left_semi"))
    return materialize(words, "member_words") if written else words


def rare_term_candidates(docs: DataFrame, targets: DataFrame, prefix: int = 3,
                         words: DataFrame | None = None) -> DataFrame:
    """(target, item): the other documents that hold one of the ``prefix`` rarest shared terms of a target.

    A term is shared if another document holds it. An inverted index of those terms only: document frequencies order the terms
    of each target (ties by term), and the documents of its first ones meet it
    on the term. So the rows joined are the sum of the lists of rare terms, and
    no list of a common one is read unless a target has nothing rarer. Terms are
    counted before they are shuffled, and a bounded number of rare ones is
    broadcast, so the terms of all documents are not laid out by term.
    """
    words = document_words(docs) if words is None else words
    terms = words.select("item", F.explode("words").alias("term"))
    own = terms.join(checked_broadcast(targets.select("item").distinct()), "item", "left_semi")
    df = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    order = Window.partitionBy("item").orderBy("df", "term")
    rare = materialize(own.join(df, "term").withColumn("_rn", F.row_number().over(order))
                       .where(F.col("_rn") <= prefix).select(F.col("item").alias("target"), "term"), "rare_terms")
    return (terms.join(checked_broadcast(rare), "term").where(F.col("item") != F.col("target"))
            .select("target", "item").distinct())


def _known(cands: DataFrame, docs: DataFrame) -> DataFrame:
    """The document set of each target, members with a document only."""
    return document_set(cands).join(docs.select("item"), "item", "left_semi")


def tfidf_weights(cands: DataFrame, docs: DataFrame) -> DataFrame:
    """(target, term, df, m, idf) for every term of every target's document set."""
    members = _known(cands, docs)
    rows = members.select("target", "item").join(
        member_words(cands, docs).select("item", F.explode("words").alias("term")), "item")
    m = members.groupBy("target").agg(F.count(F.lit(1)).alias("m"))
    df = rows.groupBy("target", "term").agg(F.count(F.lit(1)).alias("df"))
    return df.join(m, "target").withColumn(
        "idf", F.log((F.col("m") + 1) / (F.col("df") + 1)))


def sparse_cosine(one: DataFrame, other: DataFrame, on: Sequence[str], item: Sequence[str],
                  term: str = "term", weight: str = "w", min_shared: int = 2) -> DataFrame:
    """(on, item, shared, cos) of sparse vectors: cosine over the terms that both hold, norms over these too.

    ``one`` has rows (on, term, weight), ``other`` rows (on, item, term, weight);
    the vectors of equal ``on`` are compared. A row of weight 0 is an entry and
    counts as held; a null weight is 0. cos is 0 with fewer than ``min_shared``
    shared terms and when a norm is 0; vectors that share no term give no row.
    """
    a = one.select(*on, term, F.coalesce(weight, F.lit(0.0)).alias("_wa"))
    b = other.select(*on, *item, term, F.coalesce(weight, F.lit(0.0)).alias("_wb"))
    sums = b.join(a, [*on, term]).groupBy(*on, *item).agg(
        F.count(F.lit(1)).alias("shared"), F.sum(F.col("_wa") * F.col("_wb")).alias("_num"),
        F.sum(F.col("_wa") * F.col("_wa")).alias("_da"), F.sum(F.col("_wb") * F.col("_wb")).alias("_db"))
    return sums.select(*on, *item, "shared", _cosine(min_shared).alias("cos"))


def _cosine(min_shared: int = 2) -> Column:
    """The cosine from its sums: shared, _num, _da, _db."""
    ratio = F.coalesce(safe_ratio("_num", F.sqrt("_da") * F.sqrt("_db")), F.lit(0.0))
    return F.when(F.col("shared") < min_shared, F.lit(0.0)).otherwise(ratio)


def _idf_maps(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """(target, idf MAP): idf = ln((m + 1) / (df + 1)) of the target's terms that ``pairs`` (target, shared ARRAY) hold."""
    m = members.groupBy("target").agg(F.count(F.lit(1)).alias("m"))
    df = pairs.select("target", F.explode("shared").alias("term")).groupBy("target", "term").agg(
        (F.count(F.lit(1)) + 1).alias("df"))
    idf = df.join(m, "target").select("target", F.struct("term", F.log((F.col("m") + 1) / (F.col("df") + 1)).alias("w")).alias("e"))
    # A map is as long as the target's document has terms.
    return idf.groupBy("target").agg(F.map_from_entries(F.collect_list("e")).alias("idf"))


def _looked_up(table: str) -> Column:
    """What a column of maps holds for each of the shared terms."""
    return F.transform("shared", lambda x: F.try_element_at(table, x))


def _array_cosine(pairs: DataFrame, one: Column, other: Column) -> DataFrame:
    """(target, item, cos) of ``pairs`` with the weights of their shared terms as two arrays, term by term.

    Only sums leave a pair: no row is made of a shared term.
    """
    def dot(x: str, y: str) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)

    arrays = pairs.select("target", "item", one.alias("_a"), other.alias("_b"))
    sums = arrays.select("target", "item", F.size("_a").alias("_k"), dot("_a", "_b").alias("_num"),
                         dot("_a", "_a").alias("_da"), dot("_b", "_b").alias("_db"))
    # A candidate that is listed twice counts its terms twice.
    sums = sums.groupBy("target", "item").agg(F.sum("_k").alias("shared"), *[F.sum(c).alias(c) for c in ("_num", "_da", "_db")])
    return sums.select("target", "item", _cosine().alias("cos"))


def _target_blocks(cands: DataFrame, vectors: DataFrame, terms: str) -> int:
    """In how many blocks of some ``BLOCK_TERMS`` terms (the column ``terms`` of ``vectors``) the targets are scored."""
    own = vectors.join(checked_broadcast(cands.select(F.col("target").alias("item")).distinct()), "item", "left_semi")
    return max(1, -(-(own.agg(F.sum(F.size(terms))).first()[0] or 0) // BLOCK_TERMS))


def _block_scores(cands: DataFrame, docs: DataFrame, vectors: DataFrame, blocks: int) -> DataFrame:
    """(target, item, cos) by idf = ln((m + 1) / (df + 1)) of the terms that ``vectors`` (item, terms ARRAY, more MAP) share.

    ``more`` has the counts of terms that a document holds more than once. Terms
    never travel with a pair: pairs go to the documents that they name, and the
    targets' terms, then their weights, are broadcast, for one of ``blocks``
    blocks of targets after the other. Each block's terms are intersected twice,
    for the document frequencies and for the scores; what a block shuffles is
    gone before the next one begins. A candidate that is listed twice counts its
    terms twice.
    """
    spark = cands.sparkSession
    own = materialize(vectors.join(checked_broadcast(cands.select(F.col("target").alias("item")).distinct()), "item", "left_semi")
                      .select(F.col("item").alias("target"), F.col("terms").alias("own"), F.col("more").alias("own_more")), "target_terms")
    m = materialize(_known(cands, docs).groupBy("target").agg(F.count(F.lit(1)).alias("m")), "document_set_sizes")
    paths = []
    for block in range(blocks):
        here = F.pmod(F.xxhash64("target"), F.lit(blocks)) == block
        pairs = cands.select("target", "item").where((F.col("item") != F.col("target")) & here)
        # A block's terms are a bounded number: broadcast.
        met = (pairs.join(vectors, "item").join(F.broadcast(own.where(here)), "target")
               .select("target", "item", "own_more", "more", F.explode(F.array_intersect("own", "terms")).alias("term")))
        df = met.groupBy("target", "term").agg((F.count(F.lit(1)) + 1).alias("df"))
        idf = materialize(df.join(m, "target").select("target", "term", F.log((F.col("m") + 1) / (F.col("df") + 1)).alias("idf")), "idf")
        one, other = (F.col("idf") * F.coalesce(F.try_element_at(c, "term"), F.lit(1)) for c in ("own_more", "more"))
        sums = met.join(F.broadcast(idf), ["target", "term"]).select("target", "item", one.alias("_a"), other.alias("_b")).groupBy("target", "item").agg(
            F.count(F.lit(1)).alias("shared"), F.sum(F.col("_a") * F.col("_b")).alias("_num"),
            F.sum(F.col("_a") * F.col("_a")).alias("_da"), F.sum(F.col("_b") * F.col("_b")).alias("_db"))
        paths.append(scratch_path(spark, "scores"))
        with shuffles_let_go(spark):
            sums.select("target", "item", _cosine().alias("cos")).write.parquet(paths[-1])
    schema = cands.select("target", "item", F.lit(0.0).alias("cos")).schema
    return spark.read.schema(schema).parquet(*paths)


def shared_words(cands: DataFrame, words: DataFrame, few: bool = False) -> DataFrame:
    """(target, item, shared ARRAY): the terms of a candidate that its target has too, before anything is exploded.

    With ``few``, the targets' terms fit into one block: they are broadcast.
    """
    mine = words.select(F.col("item").alias("target"), F.col("words").alias("own"))
    if few:
        mine = F.broadcast(mine.join(cands.select("target").distinct(), "target", "left_semi"))
    return (cands.select("target", "item").where(F.col("item") != F.col("target")).join(words, "item")
            .join(mine, "target").select("target", "item", F.array_intersect("own", "words").alias("shared")))


def _keyed(words: DataFrame) -> DataFrame:
    """``words`` (item, words) with 64-bit hashes for words if no two words share one, else as they are.

    Every pair carries the words of a document, hashes of which are a fraction
    as long.
    """
    terms = words.select(F.explode("words").alias("term")).distinct()
    if not terms.groupBy(F.xxhash64("term").alias("key")).count().where("count > 1").isEmpty():
        return words
    return words.select("item", F.transform("words", lambda w: F.xxhash64(w)).alias("words"))


def cosine_scores(cands: DataFrame, docs: DataFrame, weighting: str = "tfidf",
                  words: DataFrame | None = None) -> DataFrame:
    """(target, item, cos) for candidates sharing at least one term with their target."""
    if weighting not in ("tfidf", "count"):
        raise ValueError(f"unknown weighting {weighting!r}")
    words = _keyed(member_words(cands, docs) if words is None else words)
    blocks = 1 if weighting == "count" else _target_blocks(cands, words, "words")
    if blocks > 1:
        # Word sets: a document holds each of its terms once.
        kind = dict(words.dtypes)["words"].removeprefix("array<").removesuffix(">")
        once = F.lit(None).cast(f"map<{kind},int>")
        return _block_scores(cands, docs, words.select("item", F.col("words").alias("terms"), once.alias("more")), blocks)
    # Read by the document frequencies and by the scores: written once.
    shared = materialize(shared_words(cands, words, weighting != "count").where(F.size("shared") > 0), "shared_words")
    if weighting == "count":
        # Every weight is 1, so any two shared terms make the cosine 1.
        return shared.select("target", "item", F.when(F.size("shared") < 2, 0.0).otherwise(1.0).alias("cos"))
    # Word sets: a term weighs the same in the target and in the candidate.
    both = shared.join(_idf_maps(shared, _known(cands, docs)), "target")
    return _array_cosine(both, _looked_up("idf"), _looked_up("idf"))


# -- hashed features ----------------------------------------------------------------

def _stored_vectors(df: DataFrame, col: str) -> DataFrame:
    """(item, indices, values) of a column of sparse vectors.

    They are written and read back as the structs they are stored as, which
    gives their parts without a Python function.
    """
    path = scratch_path(df.sparkSession, "sparse_vectors")
    df.select(F.col("item").cast("bigint").alias("item"), F.col(col).alias("v")).write.parquet(path)
    stored = "item bigint, v struct<type: tinyint, size: int, indices: array<int>, values: array<double>>"
    return df.sparkSession.read.schema(stored).parquet(path).select("item", "v.indices", "v.values")


def hashed_vectors(words: DataFrame, num_features: int = 1 << 18) -> DataFrame:
    """(item, buckets ARRAY<INT>, tf ARRAY<DOUBLE>): words counted by hash bucket, as ``HashingTF`` does."""
    from pyspark.ml.feature import HashingTF

    tf = HashingTF(inputCol="words", outputCol="tf", numFeatures=num_features).transform(words)
    return _stored_vectors(tf, "tf").toDF("item", "buckets", "tf")


def hashed_scores(cands: DataFrame, docs: DataFrame, num_features: int = 1 << 18,
                  words: DataFrame | None = None) -> DataFrame:
    """(target, item, cos) by hashed TF-IDF, idf = ln((m + 1) / (df + 1)) of each bucket within a target's document set.

    Words of one bucket add up, so weights of the target and a candidate differ
    where they hold different ones. Buckets that the target lacks are in no
    product: the arrays of buckets are intersected before rows are made of them.
    """
    vectors = hashed_vectors(member_words(cands, docs) if words is None else words, num_features)
    blocks = _target_blocks(cands, vectors, "buckets")
    if blocks > 1:
        counts = F.map_from_entries(F.filter(F.arrays_zip("buckets", F.col("tf").cast("array<int>").alias("tf")), lambda e: e["tf"] > 1))
        vectors = by_item(vectors.select("item", F.col("buckets").alias("terms"), counts.alias("more")), "hashed_documents")
        return _block_scores(cands, docs, vectors, blocks)
    # Counts are whole numbers; arrays travel with a pair, maps are made of them where they are read.
    counts = vectors.select("item", "buckets", F.col("tf").cast("array<int>").alias("tf"))
    mine = counts.toDF("target", "own", "own_tf")
    pairs = (cands.select("target", "item").where(F.col("item") != F.col("target")).join(counts, "item").join(mine, "target")
             .withColumn("shared", F.array_intersect("own", "buckets")).where(F.size("shared") > 0)
             .select("target", "item", "shared", F.map_from_arrays("own", "own_tf").alias("own_tf"),
                     F.map_from_arrays("buckets", "tf").alias("tf")))
    # Read by the document frequencies and by the scores: written once.
    pairs = materialize(pairs.select("target", "item", "shared", _looked_up("own_tf").alias("own_tf"),
                                     _looked_up("tf").alias("tf")), "shared_buckets")
    both = pairs.join(_idf_maps(pairs, _known(cands, docs)), "target")
    return _array_cosine(both, *[F.zip_with(c, _looked_up("idf"), lambda n, w: n * w) for c in ("own_tf", "tf")])


def rank_candidates(cands: DataFrame, docs: DataFrame, weighting: str = "tfidf",
                    words: DataFrame | None = None, num_features: int = 1 << 18) -> DataFrame:
    """(target, item, cos, ordered, rank) per target; ``weighting`` is count, tfidf or hashed.

    Candidates with a document, not the target, and not the target's sibling
    (same parent); cos is 0 for candidates sharing fewer than two terms.
    """
    parents = docs.select("item", "parent")
    tparent = parents.select(F.col("item").alias("target"), F.col("parent").alias("tparent"))
    pool = (cands.select("target", "item", "click", "rating")
            .join(parents, "item").join(tparent, "target")
            .where((F.col("item") != F.col("target")) & (F.col("parent") != F.col("tparent"))))
    scores = (hashed_scores(cands, docs, num_features, words) if weighting == "hashed"
              else cosine_scores(cands, docs, weighting, words))
    scored = (pool.join(scores, ["target", "item"], "left")
              .select("target", "item",
                      stable(F.coalesce(F.col("cos"), F.lit(0.0))).alias("cos"),
                      (F.lit(SCORE_BASE) + F.col("click") * F.col("rating")).alias("ordered")))
    return rank_within(scored, "target",
                       [F.desc("cos"), F.desc("ordered"), F.asc("item")])


def recommendation_documents(ranked: DataFrame, chunk_size: int = 4096) -> DataFrame:
    """(item, chunk, recoms MAP<STRING, BIGINT>): one JSON-ready document per target
    (big targets split into chunks); score = ordered truncated to BIGINT."""
    entry = F.struct(F.col("item").cast("string").alias("k"),
                     F.col("ordered").cast("bigint").alias("v"))
    lists = chunked_lists(ranked, "target", "item", entry, chunk_size, out="entries")
    return lists.select(F.col("target").cast("string").alias("item"), "chunk",
                        F.map_from_entries("entries").alias("recoms"))


def overlap(a: DataFrame, b: DataFrame, k: int | None = None) -> DataFrame:
    """(target, overlap): share of b's items that are also in a's list (with ``k``: of the top k of both)."""
    first = F.lit(True) if k is None else F.col("rank") <= k
    ta = a.where(first).select("target", "item")
    tb = b.where(first).select("target", "item")
    both = tb.join(ta, ["target", "item"], "left_semi").groupBy("target").agg(
        F.count(F.lit(1)).alias("_n"))
    size_b = tb.groupBy("target").agg(F.count(F.lit(1)).alias("_m"))
    return (size_b.join(both, "target", "left")
            .select("target", (F.coalesce(F.col("_n"), F.lit(0)) / F.col("_m")).alias("overlap")))


def hashing_tfidf(docs: DataFrame, num_features: int = 1 << 18) -> DataFrame:
    """ML form: HashingTF + IDF fitted once over the whole corpus.

    Returns (item, buckets ARRAY<INT>, weights ARRAY<DOUBLE>). Words can collide
    in a hash bucket; the per-target form is ``hashed_scores``, the exact one
    ``cosine_scores``.
    """
    from pyspark.ml.feature import IDF, HashingTF

    words = item_words(docs)
    tf = HashingTF(inputCol="words", outputCol="tf", numFeatures=num_features).transform(words)
    model = IDF(inputCol="tf", outputCol="features").fit(tf)
    return _stored_vectors(model.transform(tf), "features").toDF("item", "buckets", "weights")
