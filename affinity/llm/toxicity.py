"""Toxicity by nearest labelled examples: exact TF-IDF cosine over block-max inverted indexes.

The examples are a bounded sample of labelled documents.  Their vectors hold
TF-IDF weights of the terms (words and word beginnings) that tell toxic
examples from others, and of one background term that every text has, so a text
without any such term is near the ordinary examples.  Examples with equal
vectors share an entry.  Postings are cut into blocks of entries, each with
the largest weight of a term in it: a query bounds every block from these, and
reads blocks from the highest bound on until none can hold a nearer entry.  The
nearest entries vote by distance; votes are calibrated on the examples, each
left out of its own vote.

Near copies of an example (full TF-IDF vectors over all words, cosine 0.9 or
more) are found besides, whether or not they hold such terms, and their
labels join the vote by distance.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import hashes, map_slices, mix, tokenise

#: Marks cut off around words, and lengths of the word beginnings that are terms.
MARKS = ".,;:!?\"'()[]{}*$%&#|<>-_~`"
BEGINNINGS = (4, 5, 6)
_MEMO = 200_000


def terms_of(words: pa.Array) -> list[pa.Array]:
    """The terms of words: the word, and its beginnings if it is longer (null where it is not)."""
    words = pc.utf8_trim(words, characters=MARKS)
    size = pc.utf8_length(words)
    out = [pc.if_else(pc.greater(size, 0), words, None)]
    for n in BEGINNINGS:
        out.append(pc.if_else(pc.greater(size, n), pc.binary_join_element_wise(
            pc.utf8_slice_codeunits(words, 0, n), "-", ""), None))
    return out


@dataclass
class Copies:
    """Full TF-IDF vectors over all words of the examples, to find near copies: cosine of ``least`` or more."""

    words: np.ndarray  # hashes, sorted
    idf: np.ndarray
    unseen: float  # idf of a word that no example has
    starts: np.ndarray  # of entries in terms and weights
    terms: np.ndarray
    weights: np.ndarray  # unit length
    first: np.ndarray  # of words in entries and values: the postings
    entries: np.ndarray
    values: np.ndarray
    share: np.ndarray  # of toxic examples, of entries (examples with equal words and counts)
    example: np.ndarray
    least: float

    @staticmethod
    def of(rows: list[tuple[int, int, bytes, bytes]], least: float) -> Copies:
        """From (id, label, hashes of distinct words, their counts) of examples."""
        merged: dict = {}
        for i, label, words, counts in sorted(rows):
            if words:
                e = merged.setdefault((words, counts), [0, 0, i])
                e[0] += label
                e[1] += 1
        hashed = [np.frombuffer(w, np.uint64) for w, _ in merged]
        flat = np.concatenate([*hashed, np.empty(0, np.uint64)])
        words, terms = np.unique(flat, return_inverse=True)
        df = np.bincount(terms, minlength=len(words))
        n = len(merged)
        idf = np.log((n + 1) / (df + 1)) + 1
        starts = np.concatenate(([0], np.cumsum([len(h) for h in hashed]))).astype(np.int64)
        counts = np.concatenate([*[np.frombuffer(c, np.int64) for _, c in merged], np.empty(0, np.int64)])
        weights = (1 + np.log(counts)) * idf[terms]
        entry = np.repeat(np.arange(n), np.diff(starts))
        weights = weights / np.sqrt(np.bincount(entry, weights * weights, n))[entry]
        order = np.argsort(terms, kind="stable")
        first = np.concatenate(([0], np.cumsum(df))).astype(np.int64)
        e = np.array(list(merged.values())).reshape(-1, 3)
        return Copies(words, idf, np.log(n + 1) + 1, starts, terms, weights, first, entry[order], weights[order],
                      e[:, 0] / np.maximum(e[:, 1], 1), e[:, 2], least)

    def numbers(self, hashed: np.ndarray) -> np.ndarray:
        """Numbers of words by their hashes (-1: in no example)."""
        if not len(self.words):
            return np.full(len(hashed), -1)
        at = np.minimum(np.searchsorted(self.words, hashed), len(self.words) - 1)
        return np.where(self.words[at] == hashed, at, -1)

    def near(self, terms: np.ndarray, counts: np.ndarray) -> list[tuple[float, int]]:
        """All entries of cosine ``least`` or more, nearest first, exactly.

        An entry without any of the text's rarest words is farther if the other
        words' weights are shorter than ``least``; those with some are bounded
        by them before whole vectors are compared.
        """
        known = terms >= 0
        w = (1 + np.log(counts)) * np.where(known, self.idf[terms] if len(self.idf) else 0, self.unseen)
        mass = w * w
        norm = mass.sum()
        if not len(w) or mass[known].sum() < (self.least - 1e-9) ** 2 * norm:
            return []
        w, mass = w / np.sqrt(norm), mass / norm
        order = np.argsort(np.where(known, -self.idf[terms], -np.inf), kind="stable")
        left = 1 - np.cumsum(mass[order])
        order = order[:int(np.argmax(left < (self.least - 1e-9) ** 2)) + 1]
        rest = max(0.0, 1 - mass[order].sum())
        order = order[known[order]]
        if not len(order):
            return []
        spans = [slice(self.first[t], self.first[t + 1]) for t in terms[order]]
        e = np.concatenate([self.entries[x] for x in spans])
        x = np.concatenate([self.values[x] for x in spans])
        q = np.repeat(w[order], [x.stop - x.start for x in spans])
        some, back = np.unique(e, return_inverse=True)
        bound = np.bincount(back, q * x) + np.sqrt(rest * np.maximum(0, 1 - np.bincount(back, x * x)))
        some = some[bound >= self.least - 1e-9]
        if not len(some):
            return []
        by = np.argsort(terms[known])
        mine, q = terms[known][by], w[known][by]
        out = []
        for i in some.tolist():
            part = slice(self.starts[i], self.starts[i + 1])
            at = np.minimum(np.searchsorted(mine, self.terms[part]), len(mine) - 1)
            cos = float((q[at] * self.weights[part])[mine[at] == self.terms[part]].sum())
            if cos >= self.least - 1e-9:
                out.append((min(cos, 1.0), i))
        return sorted(out, key=lambda x: (-x[0], x[1]))

    def join(self, score: float, near: list[tuple[float, int]]) -> float:
        """``score`` and the labels of near copies, by distance; the score stands at the distance of ``least``."""
        own = 1 / (1.02 - self.least) ** 2
        weight = [1 / (1.02 - cos) ** 2 for cos, _ in near]
        return float((own * score + sum(x * self.share[e] for x, (_, e) in zip(weight, near, strict=True)))
                     / (own + sum(weight)))


@dataclass
class Index:
    """Entries (distinct example vectors) with labels, in blocks, and the postings of their terms."""

    terms: dict[str, int]  # of the vocabulary; the background term is the last
    idf: np.ndarray
    vectors: np.ndarray  # entries x terms, unit length; kept as postings below
    toxic: np.ndarray  # weight of toxic and all examples of an entry
    total: np.ndarray
    example: np.ndarray  # an example's id
    k: int = 15
    block: int = 64
    slope: float = 1.0
    offset: float = 0.0
    prior: float = 0.0
    memo: dict = field(default_factory=dict)
    copies: Copies | None = None

    def __post_init__(self):
        n, m = self.vectors.shape
        self.blocks = -(-n // self.block) if n else 0
        self.highest = np.zeros((m, self.blocks))
        self.postings = []
        for t in range(m):
            at = np.flatnonzero(self.vectors[:, t])
            w = self.vectors[at, t]
            np.maximum.at(self.highest[t], at // self.block, w)
            self.postings.append((at, w, np.searchsorted(at, np.arange(self.blocks + 1) * self.block)))
        self.vectors = None

    def vector(self, counts: dict[int, int]) -> tuple[list[int], np.ndarray]:
        """(terms, unit weights) of term counts; the background term always counts one."""
        terms = sorted(counts) + [len(self.idf) - 1]
        w = np.array([(1 + np.log(counts[t])) * self.idf[t] for t in terms[:-1]] + [self.idf[-1]])
        return terms, w / np.sqrt((w * w).sum())

    def nearest(self, terms: list[int], w: np.ndarray) -> list[tuple[float, int]]:
        """The k entries of largest cosine (ties: the first), exactly."""
        bound = w @ self.highest[terms]
        top: list[tuple[float, int]] = []
        for b in np.argsort(-bound, kind="stable"):
            if len(top) == self.k and bound[b] < top[-1][0] - 1e-9:
                break
            size = min(self.block, len(self.total) - b * self.block)
            score = np.zeros(size)
            for t, q in zip(terms, w, strict=True):
                at, x, cut = self.postings[t]
                some = slice(cut[b], cut[b + 1])
                score[at[some] - b * self.block] += q * x[some]
            top = sorted(top + [(s, int(b) * self.block + i) for i, s in enumerate(score.tolist())],
                         key=lambda e: (-e[0], e[1]))[:self.k]
        return top

    def vote(self, near: list[tuple[float, int]], own: tuple[int, float, float] | None = None) -> float:
        """Share of toxic among the nearest, weighted by distance; ``own``: an entry and what to leave out of it."""
        num = den = 0.0
        for cos, e in near:
            toxic, total = self.toxic[e], self.total[e]
            if own and own[0] == e:
                toxic, total = toxic - own[1], total - own[2]
            if total <= 1e-9:
                continue
            weight = total / (total + 1) / (1.02 - min(cos, 1.0)) ** 2
            num += weight * (toxic + self.prior) / (total + 1)
            den += weight
        return num / den if den else self.prior

    def calibrated(self, vote: float) -> float:
        vote = min(max(vote, 1e-6), 1 - 1e-6)
        z = self.slope * np.log(vote / (1 - vote)) + self.offset
        return float(1 / (1 + np.exp(-z)))

    def judge(self, counts: dict[int, int]) -> tuple[float, list[tuple[int, float, float]]]:
        """(score, evidence: id of an example, cosine, its entry's share of toxic)."""
        key = tuple(sorted(counts.items()))
        got = self.memo.get(key)
        if got is None:
            if len(self.memo) > _MEMO:
                self.memo.clear()
            near = self.nearest(*self.vector(counts))
            got = self.memo[key] = (self.calibrated(self.vote(near)), [
                (int(self.example[e]), cos, float(self.toxic[e] / self.total[e])) for cos, e in near])
        return got


def _count_terms(codes: np.ndarray, offsets: np.ndarray, words: pa.Array,
                 vocabulary: dict[str, int]) -> dict[int, dict[int, int]]:
    """Per text (of ``tokenise``) with any: counts of its terms of the vocabulary."""
    out: dict = defaultdict(dict)
    if not len(codes) or not vocabulary:
        return out
    known = pa.array(list(vocabulary), pa.string())
    number = np.array(list(vocabulary.values()), np.int64)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    for terms in terms_of(words):
        place = pc.index_in(terms, value_set=known).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        of = place[codes]
        hit = np.flatnonzero(of >= 0)
        pairs, n = np.unique(np.stack([doc[hit], number[of[hit]]]), axis=1, return_counts=True)
        for d, t, c in zip(*pairs.tolist(), n.tolist(), strict=True):
            out[d][t] = out[d].get(t, 0) + c
    return out


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_examples: int = 4096, max_terms: int = 256, min_chi2: float = 20.0,
          k: int = 15, min_copy: float = 0.9) -> Index | None:
    """An index of at most ``max_examples`` labelled documents, as many of either label as there are.

    They are those with the smallest hashes of their ids.  A term is chosen if
    toxic examples have it at least four times as often as others and its
    chi-squared is ``min_chi2`` or more; near copies (equal smallest word hash)
    count once there.  Whole texts of cosine ``min_copy`` or more are near copies, by
    all their words.  Examples are weighted so that both labels have the
    shares that all labels give them.  Null labels and labels without a
    document do not count; of several labels of an id the largest does.  None
    without examples.
    """
    chosen = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(
        F.col(id_col).alias("id")).agg((F.max(label_col) > 0).cast("int").alias("label"))
    some = [chosen.where(F.col("label") == y).orderBy(F.xxhash64("id"), "id").limit(max_examples // 2) for y in (0, 1)]
    some = some[0].unionAll(some[1])  # max_examples rows at most
    population = {r["label"]: r["count"] for r in chosen.groupBy("label").count().collect()}
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(some), "id")
    texts = texts.dropDuplicates(["id"]).select(F.col("id").cast("long"), "label", "text")

    def features(batch: pa.RecordBatch) -> pa.RecordBatch:
        codes, offsets, words = tokenise(batch.column("text"), lower=True)
        h = mix(hashes(words))
        names = terms_of(words)
        ids, label = batch.column("id").to_pylist(), batch.column("label").to_pylist()
        out: dict[str, list] = {"id": [], "label": [], "copy": [], "term": [], "n": [], "words": [],
                                "counts": []}
        for i, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
            counts: Counter = Counter()
            distinct, n = np.unique(codes[a:b], return_counts=True)
            for terms in names:
                for t, c in zip(terms.take(pa.array(distinct)).to_pylist(), n.tolist(), strict=True):
                    if t is not None:
                        counts[t] += c
            copy = int(h[distinct].min().view(np.int64)) if len(distinct) else 0
            counts[""] = 1  # the background term
            for key, values in zip(out, (ids[i], label[i], copy), strict=False):
                out[key] += [values] * len(counts)
            out["term"] += counts
            out["n"] += counts.values()
            by = np.argsort(h[distinct])
            # The row of the background term, the last, has the whole text.
            for key, values in (("words", h[distinct][by]), ("counts", n[by].astype(np.int64))):
                out[key] += [None] * (len(counts) - 1) + [values.tobytes()]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types, strict=True)], list(out))

    from affinity.llm.common import written

    counted = written(map_slices(texts, features, "id long, label int, copy long, term string, n long, "
                                 "words binary, counts binary"), "examples")
    sizes = {r["label"]: r for r in counted.where("term = ''").groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("copy").alias("copies")).collect()}
    if not sizes:
        return None
    n_examples = sum(r["n"] for r in sizes.values())
    nt, nc = (sizes[y]["copies"] if y in sizes else 0 for y in (1, 0))
    have = counted.select("label", "copy", "term").distinct().groupBy("term").agg(
        F.sum("label").cast("double").alias("a"), F.sum(1 - F.col("label")).cast("double").alias("b"))
    a, b, n = F.col("a"), F.col("b"), float(nt + nc)
    rest = (a + b) * (n - a - b)
    chi2 = F.when(rest > 0, n * F.pow(a * (nc - b) - b * (nt - a), 2) / (rest * max(nt * nc, 1)))
    best = have.where((F.col("term") != "") & (a * max(nc, 1) >= 4 * b * max(nt, 1)) & (chi2 >= min_chi2))
    best = [r["term"] for r in best.orderBy(chi2.desc(), "term").limit(max_terms).collect()]
    vocabulary = {t: i for i, t in enumerate(sorted(best))}
    kept = F.col("term").isin("", *best)  # max_terms at most
    rows = counted.where(kept).select("id", "label", "term", "n").collect()  # examples x terms at most
    df = Counter(r["term"] for r in rows)
    idf = np.array([np.log((n_examples + 1) / (df[t] + 1)) + 1 for t in [*vocabulary, ""]])
    per: dict[int, dict] = defaultdict(dict)
    label = {}
    for r in rows:
        label[r["id"]] = r["label"]
        if r["term"]:
            per[r["id"]][vocabulary[r["term"]]] = r["n"]
    scale = {y: population[y] / sizes[y]["n"] / sum(population.values()) * n_examples for y in sizes}
    entries: dict = {}
    for i in sorted(label):
        key = tuple(sorted(per[i].items()))
        e = entries.setdefault(key, [0.0, 0.0, i])
        e[0] += scale[label[i]] * label[i]
        e[1] += scale[label[i]]
    # Entries of like terms stand together, which makes the blocks' bounds tight.
    keys = sorted(entries)
    index = Index(vocabulary, idf, np.zeros((0, len(idf))), *(np.array([entries[x][j] for x in keys]) for j in range(3)),
                  k=k, prior=population.get(1, 0) / sum(population.values()))
    vectors = np.zeros((len(keys), len(idf)))
    for row, key in zip(vectors, keys, strict=True):
        terms, w = index.vector(dict(key))
        row[terms] = w
    index.vectors = vectors
    index.__post_init__()
    _calibrate(index, keys, per, label, scale)
    whole = counted.where("term = ''").select("id", "label", "words", "counts").collect()  # max_examples texts at most
    index.copies = Copies.of([(r["id"], r["label"], bytes(r["words"]), bytes(r["counts"])) for r in whole], min_copy)
    return index


def _calibrate(index: Index, keys: list, per: dict, label: dict, scale: dict) -> None:
    """Slope and offset of the votes' log-odds, by Newton steps on the examples' own left-out votes."""
    if len(scale) < 2:
        return
    place = {key: e for e, key in enumerate(keys)}
    groups: Counter = Counter((tuple(sorted(per[i].items())), label[i]) for i in label)
    x, y, w = [], [], []
    for (key, toxic), n in sorted(groups.items()):
        near = index.nearest(*index.vector(dict(key)))
        vote = index.vote(near, (place[key], scale[toxic] * toxic, scale[toxic]))
        vote = min(max(vote, 1e-6), 1 - 1e-6)
        x.append(np.log(vote / (1 - vote)))
        y.append(toxic)
        w.append(n * scale[toxic])
    x, y, w = np.array(x), np.array(y, float), np.array(w)
    design = np.stack([x, np.ones_like(x)], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        slope = design.T @ (w * (y - p)) - 1.0 * (beta - [1.0, 0.0])  # drawn to the votes themselves
        curve = (design * (w * p * (1 - p))[:, None]).T @ design + np.eye(2)
        step = np.linalg.solve(curve, slope)
        beta = beta + np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    if beta[0] > 0:
        index.slope, index.offset = map(float, beta)


def score(docs: DataFrame, index: Index | None, *, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = 0.5) -> DataFrame:
    """Per row: doc_id, score (0 to 1), predicted (1 from ``threshold`` on), evidence (the nearest examples).

    evidence lists (doc_id, cosine, toxic share) of near copies, at most k, and
    the k nearest entries.
    Null and empty texts have the background term alone and are scored by it.
    Without an index the score is 0 and there is no evidence.  Repeated rows and
    null ids are rows of their own.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    item = pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.float64())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if index is None:
            got = [(0.0, [])] * batch.num_rows
        else:
            codes, offsets, words = tokenise(batch.column("text"), lower=True)
            counts = _count_terms(codes, offsets, words, index.terms)
            got = [index.judge(counts.get(i, {})) for i in range(batch.num_rows)]
            copies = index.copies
            number = mix(hashes(words)) if copies else None
            place = copies.numbers(number) if copies else None
            for i in range(batch.num_rows if copies else 0):
                distinct, n = np.unique(codes[offsets[i]:offsets[i + 1]], return_counts=True)
                near = copies.near(place[distinct], n)
                if near:
                    vote, voters = got[i]
                    got[i] = (copies.join(vote, near), [
                        (int(copies.example[e]), cos, float(copies.share[e])) for cos, e in near[:index.k]] + voters)
        scores = [s for s, _ in got]
        evidence = [[{"doc_id": i, "cosine": c, "toxic": t} for i, c, t in e] for _, e in got]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(scores), pa.array([int(s >= threshold) for s in scores], pa.int32()),
             pa.array(evidence, pa.list_(item))], ["doc_id", "score", "predicted", "evidence"])

    return map_slices(rows, run, f"doc_id {dict(rows.dtypes)['doc_id']}, score double, predicted int, "
                                 "evidence array<struct<doc_id:long,cosine:double,toxic:double>>")
