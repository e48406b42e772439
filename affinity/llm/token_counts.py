"""Token counts of a unigram model, by dynamic programming over a trie.

The distinct words of a slice are inserted in a trie, level by level; the best
score and its number of tokens are computed once per node, that is once per
shared prefix, from the nodes up to the longest piece above it.  A word's count
is stored at its terminal node.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import map_slices, mix, tokenise

_BASE = 0x9E3779B97F4A7C15
_WRAP = (1 << 64) - 1
#: Longer words are scored one by one: a trie shares no prefixes that deep.
TRIE_CHARS = 48
#: Words whose count a worker keeps.
CACHE_WORDS = 500_000
#: Fixed value: the mark of a word's beginning in the piece vocabulary.
MARK = "▁"


def _char(c: int) -> int:
    return int(mix(np.array([c + 1], np.uint64))[0])


class Unigram:
    """Pieces with log-probabilities; characters that no piece covers are spelled in bytes."""

    def __init__(self, pieces: dict[str, float], byte_score: float):
        self.pieces, self.byte_score = pieces, byte_score
        self.longest = max(map(len, pieces), default=1)
        self.tables = {}
        for n in range(1, self.longest + 1):
            some = sorted((self._hash(p), s) for p, s in pieces.items() if len(p) == n)
            if some:
                self.tables[n] = (np.array([h for h, _ in some], np.uint64), np.array([s for _, s in some]))
        self.counts: dict[str, int] = {}

    @classmethod
    def load(cls, path: str) -> Unigram:
        """The vocabulary of a sentencepiece file; chances fall with rank (Zipf), bytes ten nats below the last."""
        from sentencepiece import SentencePieceProcessor

        p = SentencePieceProcessor(model_file=path)
        normal = [i for i in range(p.get_piece_size())
                  if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))]
        total = float(np.log((1 / np.arange(1, len(normal) + 1)).sum()))
        scores = {p.id_to_piece(i): -float(np.log(r)) - total for r, i in enumerate(normal, 1)}
        return cls(scores, -float(np.log(len(normal))) - total - 10)

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * _BASE + _char(ord(c))) & _WRAP
        return h

    def count_one(self, word: str) -> int:
        """Tokens of the best segmentation of one word; of equal ones, that with the longest last piece."""
        best, count = [0.0], [0]
        for end in range(1, len(word) + 1):
            n_bytes = len(word[end - 1].encode())
            top, n = best[end - 1] + n_bytes * self.byte_score, count[end - 1] + n_bytes
            for size in range(1, min(self.longest, end) + 1):
                s = self.pieces.get(word[end - size:end])
                if s is not None and best[end - size] + s >= top:
                    top, n = best[end - size] + s, count[end - size] + 1
            best.append(top)
            count.append(n)
        return count[-1]

    def count_trie(self, words: list[str]) -> np.ndarray:
        """Tokens of distinct non-empty words, by levels of their trie."""
        chars = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        length = np.fromiter(map(len, words), np.int64, len(words))
        begin = np.cumsum(length) - length
        out = np.zeros(len(words), np.int64)
        at = np.zeros(len(words), np.int64)  # each word's node on the level above
        # Per level: the nodes' parents, prefix hashes, best scores and counts.
        parent, prefix = [np.zeros(1, np.int64)], [np.zeros(1, np.uint64)]
        best, count = [np.zeros(1)], [np.zeros(1, np.int64)]
        live = np.arange(len(words))
        level = 0
        while True:
            live = live[length[live] > level]
            if not len(live):
                return out
            c = chars[begin[live] + level].astype(np.int64)
            key, node = np.unique((at[live] << 21) | c, return_inverse=True)
            at[live] = node
            up, c = key >> 21, key & ((1 << 21) - 1)
            level += 1
            h = prefix[-1][up] * np.uint64(_BASE) + mix(c.astype(np.uint64) + np.uint64(1))
            n_bytes = 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)
            top, n = best[-1][up] + n_bytes * self.byte_score, count[-1][up] + n_bytes
            above, power = up, np.uint64(_BASE)
            for size in range(1, min(self.longest, level) + 1):
                if size > 1:
                    above = parent[level - size + 1][above]
                    power = np.uint64((int(power) * _BASE) & _WRAP)
                if size not in self.tables:
                    continue
                keys, scores = self.tables[size]
                piece = h - prefix[level - size][above] * power
                place = np.minimum(np.searchsorted(keys, piece), len(keys) - 1)
                score = np.where(keys[place] == piece, best[level - size][above] + scores[place], -np.inf)
                better = score >= top
                top = np.where(better, score, top)
                n = np.where(better, count[level - size][above] + 1, n)
            parent.append(up)
            prefix.append(h)
            best.append(top)
            count.append(n)
            ends = live[length[live] == level]
            out[ends] = n[at[ends]]

    def count_words(self, words: list[str]) -> np.ndarray:
        if len(self.counts) > CACHE_WORDS:
            self.counts = {}
        new = [w for w in words if w not in self.counts]
        short = [w for w in new if len(w) <= TRIE_CHARS]
        found = dict(zip(short, self.count_trie(short).tolist(), strict=True)) if short else {}
        found |= {w: self.count_one(w) for w in new if len(w) > TRIE_CHARS}
        self.counts |= found
        return np.fromiter((self.counts[w] for w in words), np.int64, len(words))


_MODELS: dict[str, Unigram] = {}


def token_counts(docs: DataFrame, model: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_tokens (sum over its words, each marked at its beginning).

    Words are split at ASCII white space; null and empty texts count 0.
    Repeated rows and null ids are rows of their own.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if model not in _MODELS:
            _MODELS[model] = Unigram.load(model)
        codes, offsets, words = tokenise(batch.column("text"))
        # The mark in front also keeps the empty entry of the dictionary from being empty.
        per_word = _MODELS[model].count_words(pc.binary_join_element_wise(MARK, words, "").to_pylist())
        total = np.concatenate(([0], np.cumsum(per_word[codes])))
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.diff(offsets), pa.int64()),
             pa.array(total[offsets[1:]] - total[offsets[:-1]], pa.int64())], ["doc_id", "n_words", "n_tokens"])

    return map_slices(rows, run, f"doc_id {kind}, n_words long, n_tokens long")
