"""Interpolated modified Kneser-Ney bigram model, counted in Spark, mapped by workers.

Counting: tasks count words and word pairs of their slices; Spark shuffles,
sorts and sums them.  The model is sorted arrays in a shared folder: the hashes
of the words, whose rank is a word's id, with counts and smoothed chances, and
the pair keys (id before, id) with their counts.  Workers map the files and
look sorted, distinct keys up, so a lookup touches each page about once.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import hashes, map_slices, shared_folder, tokenise, written

#: Words, pairs of a file.
FILE_WORDS, FILE_PAIRS = 1 << 18, 1 << 21
_SLICE = 12 << 20
#: The hash that stands for the end of a text (no word is empty).
END = int(hashes(pa.array([""]))[0])


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def _sequences(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct hashes, index of each token in them, token offsets of texts); texts end in END."""
    codes, offsets, words = tokenise(text, lower=True)
    known, place = np.unique(_signed(np.append(hashes(words), np.uint64(END))), return_inverse=True)
    tokens = place[np.insert(codes, offsets[1:], len(words))]
    return known, tokens, offsets + np.arange(len(offsets))


@dataclass
class SortedFiles:
    """Sorted keys over several files, each with columns of values; mapped when first used."""

    paths: list[str]
    firsts: np.ndarray  # first key of each file
    sizes: np.ndarray
    columns: dict[str, str]

    def find(self, keys: np.ndarray) -> list[tuple[slice, np.ndarray, np.ndarray, int]]:
        """For sorted keys: (their slice, places in a file, found or not, the file)."""
        out = []
        cuts = np.searchsorted(keys, self.firsts[1:]) if len(self.firsts) else np.empty(0, np.int64)
        cuts = [0, *cuts.tolist(), len(keys)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if a < b and k < len(self.paths):
                stored = self.map(k, "key", "<i8")
                at = np.minimum(np.searchsorted(stored, keys[a:b]), len(stored) - 1)
                out.append((slice(a, b), at, stored[at] == keys[a:b], k))
        return out

    def map(self, k: int, column: str, kind: str) -> np.ndarray:
        return _mapped(f"{self.paths[k]}.{column}", kind)

    def values(self, keys: np.ndarray, column: str, missing) -> np.ndarray:
        kind = self.columns[column]
        out = np.full(len(keys), missing, kind)
        for where, at, found, k in self.find(keys):
            out[where] = np.where(found, self.map(k, column, kind)[at], missing)
        return out

    def values_of(self, keys: np.ndarray, column: str, missing: float) -> np.ndarray:
        """Values of keys in any order."""
        order = np.argsort(keys, kind="stable")
        out = np.empty(len(keys), np.float64)
        out[order] = self.values(keys[order], column, missing)
        return out

    def ranks(self, keys: np.ndarray) -> np.ndarray:
        """Places of sorted keys among all, -1 if absent."""
        base = np.cumsum(self.sizes) - self.sizes
        out = np.full(len(keys), -1, np.int64)
        for where, at, found, k in self.find(keys):
            out[where] = np.where(found, at + base[k], -1)
        return out


_MAPS: dict[str, np.ndarray] = {}


def _mapped(path: str, kind: str) -> np.ndarray:
    if path not in _MAPS:
        if len(_MAPS) > 4096:
            _MAPS.clear()
        _MAPS[path] = np.memmap(path, kind, "r")
    return _MAPS[path]


def _save(path: str, **columns: np.ndarray) -> None:
    for name, values in columns.items():
        passing = f"{path}.{name}.{os.getpid()}"
        values.tofile(passing)
        os.replace(passing, f"{path}.{name}")


def _store(rows: DataFrame, folder: str, kinds: dict[str, str], emit=None, emit_schema: str | None = None):
    """Write sorted rows (key, ...) of each partition as arrays.

    Returns a written table of (path, part, first, size) and, if ``emit`` is
    given, the rows that it makes of each file's arrays.  Repeated keys, which
    lie in one partition and follow each other, are summed.
    """
    names = list(kinds)
    limit = FILE_PAIRS

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        held, n = [], 0

        def flush(keep_last: bool):
            nonlocal held, n, number
            cols = [np.concatenate([h[i] for h in held]) for i in range(len(names))]
            starts = np.flatnonzero(np.concatenate(([True], cols[0][1:] != cols[0][:-1])))
            tail = []
            if keep_last:  # the last key may go on in the next batch
                tail = [[c[starts[-1]:] for c in cols]]
                cols, starts = [c[:starts[-1]] for c in cols], starts[:-1]
            held, n = tail, len(tail[0][0]) if tail else 0
            if not len(starts):
                return None
            arrays = {names[0]: cols[0][starts].astype("<i8")}
            for name, c in zip(names[1:], cols[1:], strict=True):
                arrays[name] = np.add.reduceat(c, starts).astype(kinds[name])
            path = f"{folder}/{part:06d}-{number:06d}"
            _save(path, **arrays)
            number += 1
            return path, arrays

        def told(got):
            path, arrays = got
            row = {"path": [path], "part": pa.array([part], pa.int64()), "first": pa.array(arrays["key"][:1], pa.int64()),
                   "size": pa.array([len(arrays["key"])], pa.int64())}
            if emit is None:
                return pa.RecordBatch.from_pydict(row)
            more = emit(arrays)
            size = len(next(iter(more.values())))
            row = {"path": pa.array([path] + [None] * size), "part": pa.array([part] + [None] * size, pa.int64()),
                   "first": pa.array([int(arrays["key"][0])] + [None] * size, pa.int64()),
                   "size": pa.array([len(arrays["key"])] + [None] * size, pa.int64())}
            return pa.RecordBatch.from_pydict(row | {k: pa.concat_arrays([pa.nulls(1, pa.int64()), pa.array(v, pa.int64())])
                                                     for k, v in more.items()})
        for batch in batches:
            if batch.num_rows:
                held.append([batch.column(name).to_numpy() for name in names])
                n += batch.num_rows
                if n >= limit and (got := flush(True)):
                    yield told(got)
        if n and (got := flush(False)):
            yield told(got)

    schema = "path string, part long, first long, size long" + (f", {emit_schema}" if emit_schema else "")
    return written(rows.mapInArrow(run, schema), "model-files")


def _files(table: DataFrame, columns: dict[str, str]) -> SortedFiles:
    """The index of the files: a row per file reaches the driver."""
    rows = sorted((r["first"], r["path"], r["size"]) for r in table.where("path is not null")
                  .select("first", "path", "size").collect())
    return SortedFiles([r[1] for r in rows], np.array([r[0] for r in rows], np.int64),
                       np.array([r[2] for r in rows], np.int64), columns)


def _discounts(n: list[float]) -> list[float]:
    """Modified Kneser-Ney discounts of counts 1, 2, 3 and more, from the numbers of counts 1 to 4.

    Where a number is 0 the formula has no value; 0.5, 0.75 and 0.9 of a count stand in.
    """
    n1, n2, n3, n4 = n
    if not min(n):
        return [0.5, 0.75, 0.9]
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [min(max(x, 0.05), 0.95 * k) for k, x in enumerate(d, 1)]


def _discount(counts: np.ndarray, d: list[float]) -> np.ndarray:
    return np.choose(np.clip(counts, 0, 3).astype(np.int64), [0.0, *d])


@dataclass
class Model:
    words: SortedFiles  # key: hash; count
    chances: SortedFiles  # key: id; total, backoff, chance
    pairs: SortedFiles  # key: id before << 32 | id; count
    discounts: list[float]
    n_tokens: int
    n_words: int
    unknown: float  # chance of a word that is not known

    def lookup(self, keys: np.ndarray, files: SortedFiles, columns: dict[str, float]) -> list[np.ndarray]:
        known, back = np.unique(keys, return_inverse=True)
        return [files.values(known, c, m)[back] for c, m in columns.items()]

    def score(self, text: pa.Array) -> dict[str, np.ndarray]:
        hashed, tokens, offsets = _sequences(text)
        count = self.words.values(hashed, "count", 0)
        ids = self.words.ranks(hashed)
        total, backoff, chance = (self.chances.values_of(ids, c, m) for c, m in (
            ("total", 0.0), ("backoff", 1.0), ("chance", self.unknown)))
        start = self.chances.values_of(np.array([self.n_words]), "total", 0.0)[0]
        start_backoff = self.chances.values_of(np.array([self.n_words]), "backoff", 1.0)[0]
        begins = offsets[:-1]
        before = np.empty(len(tokens), np.int64)  # index into the arrays with the start appended
        before[1:] = tokens[:-1]
        before[begins] = len(hashed)
        ids = np.append(ids, self.n_words)
        total, backoff = np.append(total, start), np.append(backoff, start_backoff)
        known = (ids[before] >= 0) & (ids[tokens] >= 0)
        keys = np.where(known, (ids[before] << 32) | ids[tokens], -1)
        seen, = self.lookup(keys, self.pairs, {"count": 0.0})
        above = np.where(total[before] > 0, (seen - _discount(seen, self.discounts)) / np.maximum(total[before], 1), 0.0)
        scores = np.log10(above + backoff[before] * chance[tokens])
        base = np.log10((count[tokens] + 1) / (self.n_tokens + self.n_words + 1))
        sums = lambda x: np.add.reduceat(x, begins)  # noqa: E731  every text has its end
        return {"n_tokens": np.diff(offsets), "n_known": sums((count[tokens] > 0).astype(np.int64)),
                "base_score": sums(base), "score": sums(scores)}


def train(docs: DataFrame, *, text_col: str = "text") -> Model:
    """Count the texts (null: empty) and write the model.  Counts above 2^24 keep 24 bits.

    An empty table gives a model to which every word is unknown, at chance 1.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(text_col).alias("text"))

    def count_words(batches):
        from affinity.llm.common import slices
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                known, tokens, _ = _sequences(part.column("text"))
                n = np.bincount(tokens, minlength=len(known))
                yield pa.RecordBatch.from_pydict({"key": pa.array(known[n > 0], pa.int64()),
                                                  "count": pa.array(n[n > 0].astype(np.float64))})

    counted = written(texts.mapInArrow(count_words, "key long, count double").groupBy("key").agg(
        F.sum("count").alias("count")), "word-counts")
    n_words, n_tokens = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("count"), F.lit(0.0))).first()
    if n_words >= 1 << 31:
        raise ValueError("more than 2^31 distinct words")
    parts = n_words // FILE_WORDS + 1
    stored = _store(counted.repartitionByRange(parts, "key").sortWithinPartitions("key"),
                    shared_folder(spark, "kn-words"), {"key": "<i8", "count": "<f8"})
    words = _files(stored, {"count": "<f8"})

    def count_pairs(batches):
        from affinity.llm.common import slices
        for batch in batches:
            for part in slices(batch, "text", _SLICE):
                known, tokens, offsets = _sequences(part.column("text"))
                ids = words.ranks(known)[tokens]
                before = np.empty_like(ids)
                before[1:] = ids[:-1]
                before[offsets[:-1]] = n_words
                keys, n = np.unique((before << 32) | ids, return_counts=True)
                yield pa.RecordBatch.from_pydict({"key": pa.array(keys), "count": pa.array(n, pa.int64())})

    def statistics(arrays):
        """Per id: as a context its total and kinds by count, as a word its contexts; and how often a count occurs."""
        n = arrays["count"].astype(np.int64)
        context, starts = np.unique(arrays["key"] >> 32, return_index=True)
        after, contexts = np.unique(arrays["key"] & 0xFFFFFFFF, return_counts=True)
        sums = lambda x: np.add.reduceat(x.astype(np.int64), starts)
        zero, none, of = np.zeros(len(after), np.int64), np.zeros(len(context), np.int64), np.zeros(4, np.int64)
        number = [(n == k).sum() for k in (1, 2, 3, 4)]
        return {"id": np.concatenate((context, after, -np.arange(1, 5))),
                "total": np.concatenate((sums(n), zero, number)), "n1": np.concatenate((sums(n == 1), zero, of)),
                "n2": np.concatenate((sums(n == 2), zero, of)), "n3": np.concatenate((sums(n > 2), zero, of)),
                "contexts": np.concatenate((none, contexts, of))}

    pairs = texts.mapInArrow(count_pairs, "key long, count long")
    parts = int(n_tokens) // FILE_PAIRS + 1
    stored = _store(pairs.repartitionByRange(parts, "key").sortWithinPartitions("key"),
                    shared_folder(spark, "kn-pairs"), {"key": "<i8", "count": "<f4"}, statistics,
                    "id long, total long, n1 long, n2 long, n3 long, contexts long")
    files = _files(stored, {"count": "<f4"})
    sums = written(stored.where("id is not null").groupBy("id").agg(
        *[F.sum(c).alias(c) for c in ("total", "n1", "n2", "n3", "contexts")]), "kn-sums")
    of_counts = {r["id"]: r["total"] for r in sums.where("id < 0").collect()}  # four rows
    upper = _discounts([of_counts.get(-k, 0) for k in (1, 2, 3, 4)])
    entries = sums.where("id >= 0")
    row = entries.agg(F.sum("contexts"), *[F.sum((F.col("contexts") == k).cast("long")) for k in (1, 2, 3, 4)],
                      F.sum((F.col("contexts") > 2).cast("long"))).first()
    kinds = row[0] or 0
    lower = _discounts([row[k] or 0 for k in (1, 2, 3, 4)])
    # What the lower order's discounts free goes evenly to all words and one unknown.
    freed = (lower[0] * (row[1] or 0) + lower[1] * (row[2] or 0) + lower[2] * (row[5] or 0)) / kinds if kinds else 1.0
    unknown = freed / (n_words + 1)
    c = F.col("contexts")
    less = F.when(c == 0, 0.0).when(c == 1, lower[0]).when(c == 2, lower[1]).otherwise(lower[2])
    entries = entries.select(
        F.col("id").alias("key"), F.col("total").cast("double").alias("total"),
        F.when(F.col("total") > 0, (F.col("n1") * upper[0] + F.col("n2") * upper[1] + F.col("n3") * upper[2])
               / F.col("total")).otherwise(1.0).alias("backoff"),
        ((c - less) / max(kinds, 1) + unknown).alias("chance"))
    stored = _store(entries.repartitionByRange(n_words // FILE_WORDS + 1, "key").sortWithinPartitions("key"),
                    shared_folder(spark, "kn-chances"),
                    {"key": "<i8", "total": "<f8", "backoff": "<f8", "chance": "<f8"})
    chances = _files(stored, {"total": "<f8", "backoff": "<f8", "chance": "<f8"})
    return Model(words, chances, files, upper, int(n_tokens), int(n_words), unknown)


def score(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, n_known, train_tokens, base_score, score (log10 chances of the text and its end)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = model.score(batch.column("text"))
        return pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "n_tokens": pa.array(got["n_tokens"], pa.int64()),
            "n_known": pa.array(got["n_known"], pa.int64()),
            "train_tokens": pa.array(np.full(batch.num_rows, model.n_tokens), pa.int64()),
            "base_score": pa.array(got["base_score"]), "score": pa.array(got["score"])})

    return map_slices(rows, run, f"doc_id {dict(rows.dtypes)['doc_id']}, n_tokens long, n_known long, "
                                 "train_tokens long, base_score double, score double")
