"""Quality rules: lines labelled by a linear-chain conditional random field.

Every line that has a word is content or boilerplate.  The field's weights, of
line features and of label pairs, are fitted on labelled documents, whose lines
take the document's label; Viterbi decoding labels the lines of each whole
text, and a document is kept if enough of its words stand in content lines.
Base rules reject short and repetitive texts first.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import hashes, map_slices, mix, tokenise

#: The symbols and limits of the base rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS, REPEAT_WORDS, REPEAT_PERCENT = 10, 5, 20
#: Bytes of text that a task reads lines of at once: the arrays take about 40 times as much.
SLICE = 1 << 20
#: Lines that the fit sees in a row.
PIECE = 32
FEATURES = ("bias", "words", "upper", "symbols", "shouts", "stutter", "word_length", "digits", "sentence", "repeated",
            "distinct")


def _per(mask: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
    return total[ends] - total[starts]


def _table(of: bytes | range) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(of)] = True
    return out


_SPACE, _SYMBOL = _table(b" \t\n\v\f\r"), _table(SYMBOLS)
_UPPER, _LOWER, _DIGIT = _table(range(65, 91)), _table(range(97, 123)), _table(range(48, 58))
_STOP = _table(b".!?:;")


@dataclass
class Lines:
    """Lines with a word, of a slice of texts."""

    doc: np.ndarray
    words: np.ndarray
    features: np.ndarray
    base: dict[str, np.ndarray]


def read_lines(text: pa.Array) -> Lines:
    """Base figures of texts and features of their lines."""
    text = pc.fill_null(text, "")
    lists = pc.split_pattern(text, "\n")
    bounds = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.flatten()
    n_docs, n_lines = len(text), len(flat)
    doc = np.repeat(np.arange(n_docs), np.diff(bounds))
    offsets = np.frombuffer(flat.buffers()[1], np.int32)[flat.offset:flat.offset + n_lines + 1].astype(np.int64)
    data = flat.buffers()[2]
    data = np.frombuffer(data, np.uint8)[:offsets[-1]] if data is not None else np.empty(0, np.uint8)
    a, b = offsets[:-1], offsets[1:]
    solid = ~_SPACE[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    first = a[a < b]
    begins[first] = solid[first]
    words = _per(begins, a, b)
    chars = _per(solid & ((data & 0xC0) != 0x80), a, b)
    symbols = _per(_SYMBOL[data], a, b)
    with_words = words > 0
    code = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    _, earliest, back = np.unique((doc << 32) | code, return_index=True, return_inverse=True)
    again = (earliest[back] != np.arange(n_lines)) & with_words

    codes, word_bounds, _ = tokenise(text)
    word_doc = np.repeat(np.arange(n_docs), np.diff(word_bounds))
    word_line = np.repeat(np.arange(n_lines), words)
    covered = np.zeros(len(codes) + 1, np.int64)
    if len(codes) >= REPEAT_WORDS:
        last = len(codes) - REPEAT_WORDS + 1
        mixed = mix(codes.astype(np.uint64) + np.uint64(1))
        h = mix(word_doc[:last].astype(np.uint64))
        for k in range(REPEAT_WORDS):
            h = (h ^ mixed[k:last + k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(31)
        within = np.flatnonzero(word_doc[:last] == word_doc[REPEAT_WORDS - 1:])
        _, back, number = np.unique(h[within], return_inverse=True, return_counts=True)
        twice = within[number[back] > 1]
        np.add.at(covered, twice, 1)
        np.add.at(covered, twice + REPEAT_WORDS, -1)
    repeat = np.cumsum(covered)[:-1] > 0
    stutter = np.zeros(len(codes), bool)
    if len(codes):
        stutter[1:] = (codes[1:] == codes[:-1]) & (word_doc[1:] == word_doc[:-1])
    of_docs = lambda x: np.bincount(doc, x, n_docs).astype(np.int64)
    base = {"n_words": np.diff(word_bounds), "word_chars": of_docs(chars), "n_symbols": of_docs(symbols),
            "n_dup_lines": of_docs(again),
            "n_repeat_words": np.bincount(word_doc, repeat, n_docs).astype(np.int64)}

    upper, lower = _per(_UPPER[data], a, b), _per(_LOWER[data], a, b)
    _, line_words = np.unique((word_line << 32) | codes, return_index=True)
    distinct = np.bincount(word_line[line_words], minlength=n_lines)
    of = np.maximum(words, 1)
    stops = np.zeros(n_lines, bool)
    stops[a < b] = _STOP[data[b[a < b] - 1]]
    features = np.stack([
        np.ones(n_lines), np.log1p(words) / 4, upper / np.maximum(upper + lower, 1), np.minimum(symbols / of, 2),
        np.minimum(_per(data == 33, a, b) / of, 2), np.bincount(word_line, stutter, n_lines) / of,
        np.minimum(chars / of, 20) / 8, _per(_DIGIT[data], a, b) / np.maximum(chars, 1), stops, again, distinct / of],
        axis=1)
    keep = np.flatnonzero(with_words)
    return Lines(doc[keep], words[keep], features[keep], base)


@dataclass
class LineField:
    """Weights of a linear-chain field: content's lead per feature, and of a pair (before, now)."""

    weights: np.ndarray
    pairs: np.ndarray

    def decode(self, features: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Most likely labels (1: content) of the lines of documents, whose lines follow each other."""
        n = len(doc)
        if not n:
            return np.empty(0, np.int64)
        start = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        length = np.diff(np.append(start, n))
        order = np.argsort(-length, kind="stable")
        start, length = start[order], length[order]
        lead = features @ self.weights
        best = np.zeros((len(start), 2))
        best[:, 1] = lead[start]
        came = np.zeros((n, 2), np.int8)
        for t in range(1, int(length[0])):
            live = int(np.searchsorted(-length, -t, "left"))  # chains with more than t lines
            step = best[:live, :, None] + self.pairs[None]
            at = start[:live] + t
            came[at] = step.argmax(axis=1)
            best[:live] = step.max(axis=1)
            best[:live, 1] += lead[at]
        out = np.zeros(n, np.int64)
        now = best.argmax(axis=1)
        for t in range(int(length[0]) - 1, -1, -1):
            live = int(np.searchsorted(-length, -t, "left")) if t else len(start)
            at = start[:live] + t
            out[at] = now[:live]
            now[:live] = came[at, now[:live]]
        return out


def drawn(n: int, seed: np.uint64, limit: int) -> np.ndarray:
    """Places of at most ``limit`` of ``n`` lines, in order: runs of ``PIECE`` lines drawn by hash from all."""
    if n <= limit:
        return np.arange(n)
    runs = np.arange(-(-n // PIECE))
    with np.errstate(over="ignore"):
        runs = np.sort(runs[np.argsort(mix(mix(runs.astype(np.uint64)) + seed), kind="stable")[:limit // PIECE]])
    places = (runs[:, None] * PIECE + np.arange(PIECE)).ravel()
    return places[places < n]


def fit_field(features: list[np.ndarray], labels: list[int], *, rounds: int = 250, penalty: float = 0.02,
              piece: int = PIECE) -> LineField:
    """Maximum conditional likelihood of chains whose lines all have one label (chains are cut into pieces)."""
    width = len(FEATURES)
    chains = [(x[k:k + piece], y) for x, y in zip(features, labels, strict=True) for k in range(0, len(x), piece)]
    if not chains or len({y for _, y in chains}) < 2:
        # Nothing to tell apart: all is content.
        return LineField(np.eye(1, width)[0], np.zeros((2, 2)))
    x = np.zeros((len(chains), piece, width))
    there = np.zeros((len(chains), piece))
    for i, (c, _) in enumerate(chains):
        x[i, :len(c)], there[i, :len(c)] = c, 1
    y = np.array([y for _, y in chains])
    balance = np.where(y == 1, 0.5 / max((y == 1).sum(), 1), 0.5 / max((y == 0).sum(), 1))
    w, p = np.zeros(width), np.zeros((2, 2))
    moment, square = np.zeros(width + 4), np.zeros(width + 4)
    for r in range(1, rounds + 1):
        lead = x @ w
        e = np.stack([np.zeros_like(lead), lead], axis=2)
        forward, backward = np.zeros_like(e), np.zeros_like(e)
        forward[:, 0] = e[:, 0]
        for t in range(1, piece):
            step = np.logaddexp.reduce(forward[:, t - 1, :, None] + p, axis=1) + e[:, t]
            forward[:, t] = np.where(there[:, t, None] > 0, step, forward[:, t - 1])
        norm = np.logaddexp.reduce(forward[:, -1], axis=1)
        for t in range(piece - 2, -1, -1):
            step = np.logaddexp.reduce(p + (e[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
            backward[:, t] = np.where(there[:, t + 1, None] > 0, step, backward[:, t + 1])
        chance = np.exp(forward + backward - norm[:, None, None])[:, :, 1]
        slope_w = np.einsum("i,it,itf->f", balance, (y[:, None] - chance) * there, x)
        slope_p = np.zeros((2, 2))
        for t in range(1, piece):
            both = np.exp(forward[:, t - 1, :, None] + p + (e[:, t] + backward[:, t])[:, None, :]
                          - norm[:, None, None])
            told = np.zeros_like(both)
            told[np.arange(len(y)), y, y] = 1
            slope_p += np.einsum("i,iab->ab", balance * there[:, t], told - both)
        slope = np.concatenate((slope_w - penalty * w * 0.1, (slope_p - penalty * p).ravel()))
        moment = 0.9 * moment + 0.1 * slope
        square = 0.99 * square + 0.01 * slope * slope
        step = 0.1 * (moment / (1 - 0.9 ** r)) / (np.sqrt(square / (1 - 0.99 ** r)) + 1e-8)
        w, p = w + step[:width], p + step[width:].reshape(2, 2)
    return LineField(w, p)


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_documents: int = 3000, max_lines: int = 256) -> LineField:
    """Fit the field on at most ``max_documents`` labelled documents, as many of either label as there are.

    They are those with the smallest hashes of their ids; of the whole text of
    each, runs of ``PIECE`` lines with a word serve the fit, ``max_lines`` lines at
    most: those whose places have the smallest hashes.  Null labels and labels
    without a document do not count; of several labels of an id the best does,
    of several texts the one with the smallest hash.
    """
    chosen = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(
        F.col(id_col).alias("id")).agg((F.max(label_col) > 0).cast("int").alias("label"))
    some = [chosen.where(F.col("label") == k).orderBy(F.xxhash64("id"), "id").limit(max_documents // 2) for k in (0, 1)]
    some = some[0].unionAll(some[1])  # max_documents rows at most
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(some), "id")
    texts = texts.groupBy("id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    texts = texts.select(F.col("id").cast("string").alias("id"), "label", "text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lines = read_lines(batch.column("text"))
        cuts = np.searchsorted(lines.doc, np.arange(batch.num_rows + 1))
        rows = [lines.features[a + drawn(b - a, seed, max_lines)].astype(np.float32).tobytes()
                for a, b, seed in zip(cuts, cuts[1:], hashes(batch.column("id")), strict=False)]
        return pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(rows, pa.binary())],
                                          ["id", "label", "lines"])

    rows = sorted(map(tuple, map_slices(texts, run, "id string, label int, lines binary", limit=SLICE).collect()))
    return fit_field([np.frombuffer(r[2], np.float32).reshape(-1, len(FEATURES)) for r in rows], [r[1] for r in rows])


def assess(docs: DataFrame, field: LineField, *, id_col: str = "doc_id", text_col: str = "text",
           min_share: float = 0.5) -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, content_share, base_failed, kept.

    content_share is the share of the words that stand in content lines.  Null
    and empty texts have no words, share 0, and fail.  Repeated rows and null
    ids are rows of their own.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lines = read_lines(batch.column("text"))
        label = field.decode(lines.features, lines.doc)
        base = lines.base
        n = base["n_words"]
        share = np.bincount(lines.doc, lines.words * label, batch.num_rows) / np.maximum(n, 1)
        failed = (n < MIN_WORDS) | (100 * base["n_repeat_words"] > REPEAT_PERCENT * n)
        return pa.RecordBatch.from_pydict(
            {"doc_id": batch.column("doc_id")} | {k: pa.array(base[k], pa.int64()) for k in names}
            | {"content_share": pa.array(share), "base_failed": pa.array(failed),
               "kept": pa.array(~failed & (share >= min_share))})

    return map_slices(rows, run, f"doc_id {dict(rows.dtypes)['doc_id']}, " + ", ".join(f"{k} long" for k in names)
                      + ", content_share double, base_failed boolean, kept boolean", limit=SLICE)
