"""Source divergence audit: how far the words of each source are from its language's other sources.

A ``CountVectorizer`` for each language, with minDF and the largest vocabulary,
is fitted to its documents and counts their terms exactly.  The distinct terms
of a language are estimated first and, if they are many, cut by a hash into
blocks with a model each, so that no model, which the driver and every worker
hold, outgrows ``block_terms`` however large the corpus is; a term's counts do
not depend on its block.  Languages are few; the texts, with one blank for all
that separates two terms, are written once by the hash of their language, which
a filter prunes.  They are written in bags: runs of texts of one group, at most
some ``BAG_BYTES`` unless one text is longer.

The model does not meet every word of every text.  The texts of a language that
a task has at once are told by rows of few words first, as a combiner does
before a shuffle (``digest``): rows to learn from, of which as many hold a term
as documents do, up to the number that keeps it, and rows to count, which hold
a term for each binary digit 1 of its count in a group and weigh as the digit does.

The sparse vectors of these rows are summed by group, times their weights, as
``Summarizer`` does, but by index, since its dense buffers would be as long as
the vocabulary.  Most terms are missing from most groups, and all missing ones
of a group have one probability.  A sum over the whole vocabulary therefore is a
closed form for terms that neither group has, plus sums over each group's own
terms (by distinct probability), plus a correction for the terms that both have:
only that one is a join, on the term.

All arithmetic is on integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.llm.common import SLICE_BYTES, map_slices, written
from affinity.session import scratch_path

#: What each byte of a text becomes: A-Z their small letters, the rest of ASCII, which separates terms, blanks.
_PLAIN = bytes(b if b > 127 or chr(b) in "abcdefghijklmnopqrstuvwxyz" else b + 32 if 65 <= b <= 90 else 32
               for b in range(256))
#: Parts that the plain texts are written in, by the hash of their language.
LANGUAGE_PARTS = 64
#: Bytes of texts that are counted as one, if they are of one group.
BAG_BYTES = 128 << 10
#: Bytes of a row group of bags, which bound what a reader holds of them at once.
ROW_GROUP_BYTES = 32 << 20
#: Probabilities are whole multiples of one billionth.
SCALE = 1_000_000_000
#: The largest vocabulary size that CountVectorizer takes.
MAX_VOCABULARY = 2**31 - 1
#: Distinct terms (those of too few documents included) that one model counts at most, by an estimate from above.
BLOCK_TERMS = 4_000_000
#: The estimate takes one in so many documents: all of them have at most as many times the terms of these.
SAMPLE = 16


def plain(text: pa.Array) -> pa.Array:
    """Texts (none null) with small letters for A-Z and a blank for every ASCII character that is no letter."""
    _, offsets, data = text.buffers()
    if not len(text) or data is None:
        return text
    wide = np.int64 if pa.types.is_large_string(text.type) else np.int32
    places = np.frombuffer(offsets, wide)[text.offset:text.offset + len(text) + 1]
    data = data[int(places[0]):int(places[-1])].to_pybytes().translate(_PLAIN)
    return pa.Array.from_buffers(text.type, len(text), [None, pa.py_buffer(places - places[0]), pa.py_buffer(data)])


def squeezed(text: pa.Array) -> pa.Array:
    """Plain texts without the blanks that follow a blank or begin a text."""
    _, offsets, data = text.buffers()
    if not len(text) or data is None:
        return text
    wide = np.int64 if pa.types.is_large_string(text.type) else np.int32
    places = np.frombuffer(offsets, wide)[text.offset:text.offset + len(text) + 1]
    data = np.frombuffer(data, np.uint8)[int(places[0]):int(places[-1])]
    places = places - places[0]
    blank = data == 32
    drop = blank.copy()
    drop[1:] &= blank[:-1]
    starts = places[:-1][places[:-1] < places[1:]]
    drop[starts] = blank[starts]
    places = (places - np.searchsorted(np.flatnonzero(drop), places)).astype(wide)
    return pa.Array.from_buffers(text.type, len(text), [None, pa.py_buffer(places), pa.py_buffer(data[~drop])])


def bags(rows: pa.RecordBatch, bag_bytes: int = BAG_BYTES) -> pa.RecordBatch:
    """(lang, source, texts): the rows' squeezed plain texts, those of one group together up to some ``bag_bytes``."""
    lang, source = (rows.column(name).dictionary_encode() for name in ("lang", "source"))
    key = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
    order = np.argsort(key, kind="stable")
    key = key[order]
    text = squeezed(plain(rows.column("text"))).take(pa.array(order))
    size = pc.binary_length(text).to_numpy().astype(np.int64)
    before = np.cumsum(size) - size
    part = (before - before[np.searchsorted(key, key)]) // bag_bytes
    starts = np.concatenate(([0], np.flatnonzero((np.diff(key) != 0) | (np.diff(part) != 0)) + 1))
    texts = pa.ListArray.from_arrays(pa.array([*starts.tolist(), len(text)], pa.int32()), text)
    first = pa.array(order[starts])
    return pa.RecordBatch.from_arrays([rows.column("lang").take(first), rows.column("source").take(first), texts],
                                      ["lang", "source", "texts"])


def words(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(The terms of plain texts in order, how many each text has)."""
    _, offsets, data = text.buffers()
    if not len(text) or data is None:
        return pa.array([], text.type), np.zeros(len(text), np.int64)
    wide = np.int64 if pa.types.is_large_string(text.type) else np.int32
    places = np.frombuffer(offsets, wide)[text.offset:text.offset + len(text) + 1]
    data = np.frombuffer(data, np.uint8)[int(places[0]):int(places[-1])]
    places = places - places[0]
    letter = data != 32
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    starts = places[:-1][places[:-1] < places[1:]]
    first[starts] = letter[starts]
    at, data = np.flatnonzero(first), data[letter]
    ends = np.append(np.cumsum(letter, dtype=wide)[at] - wide(1), wide(len(data)))
    terms = pa.Array.from_buffers(text.type, len(at), [None, pa.py_buffer(ends), pa.py_buffer(data)])
    return terms, np.diff(np.searchsorted(at, places))


def digest(rows: pa.RecordBatch, min_df: int, row_bytes: int = BAG_BYTES) -> pa.RecordBatch:
    """(lang, source, weight, terms): the rows' plain texts, told by rows of fewer terms.

    Rows of weight 0, whose source is null, stand for the documents of a
    language: a term is in as many of them as documents have it, or in
    ``min_df`` if more have it.  The weights of the other rows that have a term
    sum up to its occurrences in the texts of that language and source.  A row
    has a term once and at most some ``row_bytes``.
    """
    lang, source = (rows.column(name).dictionary_encode() for name in ("lang", "source"))
    tongue = lang.indices.to_numpy().astype(np.int64)
    group = tongue * len(source.dictionary) + source.indices.to_numpy()
    terms, many = words(rows.column("text"))
    terms = terms.dictionary_encode()
    code, terms, n = terms.indices.to_numpy().astype(np.int64), terms.dictionary, max(1, len(terms.dictionary))
    size = pc.binary_length(terms).to_numpy().astype(np.int64) + 1
    out: list[tuple[np.ndarray, np.ndarray, int]] = []  # (group, code, weight) of each term of each row

    held = np.sort(np.repeat(np.arange(len(many)), many) * n + code)
    held = held[np.diff(held, prepend=-1) != 0]  # a document's terms once
    key, times = np.unique(tongue[held // n] * n + held % n, return_counts=True)
    for k in range(max(1, min_df)):
        some = key[times > k]
        out.append((some // n, some % n, 0))
    key, times = np.unique(np.repeat(group, many) * n + code, return_counts=True)
    weight = 1
    while times.any():
        some = key[times % 2 == 1]
        out.append((some // n, some % n, weight))
        times, weight = times // 2, weight * 2

    found = []
    for of, own, weight in out:
        if not len(own):
            continue
        before = np.cumsum(size[own]) - size[own]
        part = (before - before[np.searchsorted(of, of)]) // row_bytes
        starts = np.concatenate(([0], np.flatnonzero((np.diff(of) != 0) | (np.diff(part) != 0)) + 1))
        tongues, sources = np.divmod(of[starts], len(source.dictionary)) if weight else (of[starts], np.zeros(len(starts), np.int64))
        found.append((lang.dictionary.take(pa.array(tongues)), source.dictionary.take(pa.array(sources, mask=np.full(len(starts), not weight))),
                      pa.array(np.full(len(starts), weight)),
                      pa.ListArray.from_arrays(pa.array([*starts.tolist(), len(own)], pa.int32()), terms.take(pa.array(own)))))
    names = ["lang", "source", "weight", "terms"]
    if not found:
        return pa.RecordBatch.from_arrays([rows.column("lang").slice(0, 0), rows.column("source").slice(0, 0), pa.array([], pa.int64()),
                                           pa.array([], pa.list_(terms.type))], names)
    return pa.RecordBatch.from_arrays([pa.concat_arrays(x) for x in zip(*found, strict=True)], names)


def _by_language(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with their part, written once and laid out by it: no pass over a language reads other parts."""
    path = scratch_path(rows.sparkSession, name)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("lang"), F.lit(LANGUAGE_PARTS)).cast("int"))
    rows.write.partitionBy("part").option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _plain_texts(docs: DataFrame) -> DataFrame:
    """(lang, source, text, part): the documents with plain texts, laid out by language."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("source"), plain(batch.column("text"))],
                                          ["lang", "source", "text"])

    return _by_language(map_slices(docs, run, "lang string, source string, text string"), "plain-texts")


def _bags(docs: DataFrame, bag_bytes: int = BAG_BYTES) -> DataFrame:
    """(lang, source, texts, part): the documents in bags, laid out by language."""
    rows = map_slices(docs, lambda batch: bags(batch, bag_bytes), "lang string, source string, texts array<string>",
                      limit=max(SLICE_BYTES, bag_bytes))
    return _by_language(rows, "bags")


def _digests(bags: DataFrame, min_df: int, limit: int = SLICE_BYTES) -> DataFrame:
    """(lang, source, weight, terms, part): the texts of bags by rows of fewer terms, laid out by language."""
    rows = bags.select("lang", "source", F.explode("texts").alias("text"))
    return _by_language(map_slices(rows, lambda batch: digest(batch, min_df), "lang string, source string, weight long, terms array<string>",
                                   limit=limit), "digests")


def _terms(text: Column) -> Column:
    """The terms of a plain text in order (and empty ones between blanks and at an end that has none)."""
    return F.split(text, " ")


def _languages(docs: DataFrame, groups: DataFrame) -> list[tuple[str, int, int]]:
    """(language, its part, an upper estimate of its distinct terms); texts that are not sampled are only hashed."""
    some = _plain_texts(docs.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0))
    terms = some.select("lang", F.explode(_terms(F.col("text"))).alias("term"))
    found = dict(terms.groupBy("lang").agg(F.approx_count_distinct("term", 0.02)).collect())
    return [(lang, part, int(found.get(lang, 0) * 1.1) * SAMPLE) for lang, part in groups.select("lang", "part").distinct().collect()]


def digest_vectors(digests: DataFrame, min_df: int, block: tuple[int, int] = (0, 1)) -> tuple[DataFrame, DataFrame]:
    """((source, weight, indices) of each row to count, (index, term) of the kept terms) of one language's digests.

    The values of a row's vector are all 1, since it has a term once.
    ``block`` (b, n): of the terms, those whose hash modulo n is b.
    """
    spark, (b, n) = digests.sparkSession, block
    if n > 1:
        digests = digests.withColumn("terms", F.filter("terms", lambda x: F.pmod(F.xxhash64(x), F.lit(n)) == b))
    # Rows of an empty term keep the vocabulary from being empty, which the estimator refuses.
    guard = spark.range(min_df).select(F.array(F.lit("")).alias("terms"))
    model = CountVectorizer(inputCol="terms", outputCol="vector", minDF=float(min_df), vocabSize=MAX_VOCABULARY).fit(
        digests.where("weight = 0").select("terms").unionAll(guard))
    # The vocabulary goes from the model to a table by its own writer, not through Python.
    path = scratch_path(spark, "count-vectorizer")
    model.save(path)
    kept = spark.read.parquet(f"{path}/data").select(F.posexplode("vocabulary").alias("index", "term"))
    vectors = model.transform(digests.where("weight > 0")).select("source", "weight", F.unwrap_udt("vector").alias("vector"))
    return vectors.select("source", "weight", "vector.indices"), kept.where("term != ''")


def group_counts(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                 min_df: int = 3, block_terms: int = BLOCK_TERMS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """((lang, source) groups, (lang, source, id, count) of kept terms, (id, lang, term) vocabulary)."""
    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    docs = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))
    rows = _bags(docs)
    groups = written(rows.select("lang", "source", "part").distinct(), "groups-found")
    digests = _digests(rows, min_df)
    none = docs.sparkSession.createDataFrame
    counts, words, base = none([], "lang string, source string, id long, count long"), none([], "id long, lang string, term string"), 0
    for lang, part, most in sorted(_languages(docs, groups)):
        own = digests.where((F.col("part") == part) & (F.col("lang") == lang)).select("source", "weight", "terms")
        n = max(1, -(-most // block_terms))
        for b in range(n):
            vectors, kept = digest_vectors(own, min_df, (b, n))
            term_id = (F.lit(base).cast("long") + F.col("index")).alias("id")
            # An empty term, the guard's, has no row in the vocabulary: its counts go with the join on it.
            kept = written(kept.select(term_id, F.lit(lang).alias("lang"), "term"), "vocabulary")
            one = vectors.select("source", "weight", F.explode("indices").alias("index"))
            one = one.groupBy("source", "index").agg(F.sum("weight").alias("count")).select("source", term_id, "count")
            one = one.join(kept.select("id"), "id", "left_semi").select(F.lit(lang).alias("lang"), "source", "id", "count")
            counts, words, base = counts.unionAll(written(one, "group-counts")), words.unionAll(kept), base + MAX_VOCABULARY
            del vectors, one  # their plans hold the model, which the driver need not keep beside the next one
    return groups.select("lang", "source"), counts, words


def _probability(count: Column | str, total: Column | str) -> Column:
    """1 + floor(SCALE * (count + 1) / total), exact."""
    up = (F.col(count) if isinstance(count, str) else count).cast("decimal(19,0)") + F.lit(1)
    return F.lit(1) + F.call_function("div", up * F.lit(SCALE), (F.col(total) if isinstance(total, str) else total)
                                      .cast("decimal(20,0)"))


def _distance(p: str, q: str) -> Column:
    """floor((p - q)^2 / q), exact."""
    gap = F.col(p) - F.col(q)
    return F.call_function("div", gap * gap, F.col(q))


def audit(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_df: int = 3, top_terms: int = 200, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank).

    Part ``pair``: every other source of the language with the divergence from
    it, summed over all kept terms.  Part ``term``: the ``top_terms`` terms that
    the group uses more than its language does.  Ranks go by value, largest
    first, then by item.

    Null texts, languages and sources are empty; a text of any length is counted
    whole, and repeated rows count each.  A group without kept terms still has
    its pairs (a language without kept terms has pairs of value 0), an only
    source none.  An empty table gives no rows.
    """
    groups, counts, words = group_counts(docs, text_col=text_col, lang_col=lang_col, source_col=source_col,
                                         min_df=min_df, block_terms=block_terms)
    size = words.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    total = counts.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    groups = groups.join(total, ["lang", "source"], "left").join(size, "lang", "left").select(
        "lang", "source", F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("n", F.lit(0)).alias("n"))
    m = F.col("n") + F.col("v")
    # Without kept terms no sum below has a term, so any probability does.
    absent = F.when(m > 0, _probability(F.lit(0), F.greatest(m, F.lit(1)))).otherwise(F.lit(1))
    groups = written(groups.select("lang", "source", "v", m.alias("m"), absent.alias("p0"),
                                   F.monotonically_increasing_id().alias("g")), "groups")
    own = counts.join(groups, ["lang", "source"]).select("lang", "source", "g", "id", "count", "p0",
                                                         _probability("count", "m").alias("p"))
    own = written(own, "group-terms")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    # Apart, so that every task cuts its terms to the first ones before they are shuffled.
    terms = _top_terms(own, groups, words, counts).withColumn("rank", rank).where(F.col("rank") <= top_terms)
    return _pairs(own, groups).withColumn("rank", rank).unionAll(terms).select(
        "lang", "source", "part", "item", "value", "rank")


def _pairs(own: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, part, item, value) of every two sources of a language, both ways."""
    some = own.groupBy("lang", "g", "p", "p0").agg(F.count(F.lit(1)).alias("k"))
    left = groups.select("lang", F.col("g").alias("a"), F.col("p0").alias("a0"), "v", "source")
    right = groups.select("lang", F.col("g").alias("b"), F.col("p0").alias("b0"), F.col("source").alias("item"))
    every = left.join(right, "lang").where("a != b").withColumn("f0", _distance("a0", "b0"))
    # What a's own terms add where b has none, and b's where a has none.
    mine = some.select(F.col("g").alias("a"), F.col("lang"), F.col("p"), "k", F.col("p0").alias("a0")).join(
        right.select("lang", "b", "b0"), "lang").where("a != b").withColumn(
        "add", F.col("k") * (_distance("p", "b0") - _distance("a0", "b0")))
    other = some.select(F.col("g").alias("b"), F.col("lang"), F.col("p").alias("q"), "k", F.col("p0").alias("b0")).join(
        left.select("lang", "a", "a0"), "lang").where("a != b").withColumn(
        "add", F.col("k") * (_distance("a0", "q") - _distance("a0", "b0")))
    x = own.select("id", F.col("g").alias("a"), "p", F.col("p0").alias("a0"))
    y = own.select("id", F.col("g").alias("b"), F.col("p").alias("q"), F.col("p0").alias("b0"))

    def both(p: str, q: str, a0: str, b0: str) -> Column:
        return F.sum(_distance(p, q) - _distance(p, b0) - _distance(a0, q) + _distance(a0, b0))

    # Every two sources meet once; both ways are summed at once.
    shared = x.join(y, "id").where("a < b").groupBy("a", "b").agg(
        both("p", "q", "a0", "b0").alias("there"), both("q", "p", "b0", "a0").alias("back"))
    shared = shared.select(F.inline(F.array(F.struct("a", "b", F.col("there").alias("add")),
                                            F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.col("back").alias("add")))))
    added = mine.select("a", "b", "add").unionAll(other.select("a", "b", "add")).unionAll(shared)
    added = added.groupBy("a", "b").agg(F.sum("add").alias("add"))
    value = F.col("v") * F.col("f0") + F.coalesce("add", F.lit(0))
    return every.join(added, ["a", "b"], "left").select("lang", "source", F.lit("pair").alias("part"), "item",
                                                        value.cast("long").alias("value"))


def _top_terms(own: DataFrame, groups: DataFrame, words: DataFrame, counts: DataFrame) -> DataFrame:
    """(lang, source, part, item, value) of the terms that a group uses more than its language."""
    whole = counts.groupBy("lang", "id").agg(F.sum("count").alias("c"))
    sizes = groups.groupBy("lang").agg((F.sum(F.col("m") - F.col("v")) + F.max("v")).alias("m"))
    whole = whole.join(sizes, "lang").select("id", _probability("c", "m").alias("q"))
    rows = own.join(whole, "id").where("p > q").withColumn("value", _distance("p", "q"))
    return rows.join(words.select("id", "term"), "id").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.col("value"))
