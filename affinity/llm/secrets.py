"""Secret scans: patterns, and two character Markov models compared (DataFrame functions only).

Besides the spans of the three patterns, runs of identifier characters are
scored by the log-likelihood ratio of two first-order character models, one of
random strings, one of ordinary identifiers, both counted from labelled
samples.  The samples are the corpus' own: what the patterns match is random,
letter-only and digit-only runs (words, numbers) are ordinary.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinity.llm.common import written

#: The patterns of the contract; runs are matched whole, then judged by length.
ASSIGN = r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: Candidates of the models: runs of identifier characters; ordinary samples: runs of letters or of digits.
RUN = r"[A-Za-z0-9+/_-]{16,}"
ORDINARY = r"\b(?:[A-Za-z]{10,}|[0-9]{8,})\b"
KINDS = ("assign", "access", "hex", "markov")
MIN_ASSIGN = 8
#: A run is a secret if it is so much likelier (natural log) as a random string.
THRESHOLD = 8.0
ALPHABET = "".join(map(chr, range(33, 127)))
_N = len(ALPHABET) + 1


def _code(char: Column) -> Column:
    """1..94 for printable ASCII, 0 for anything else and for the start."""
    a = F.ascii(char)
    return F.when((a >= 33) & (a <= 126), a - 32).otherwise(F.lit(0))


def _find(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def train(samples: DataFrame, *, text_col: str = "text", random_col: str = "is_random",
          smoothing: float = 5.0) -> list[float]:
    """Log-likelihood ratio of each pair of characters, as a row-major table of 95 x 95.

    Samples are (text, is_random); null and empty ones count nothing.  Pairs
    are counted over all samples; only the table, bounded by the alphabet,
    reaches the driver.  Pair chances are smoothed with those of the second
    character, those evenly.  Without samples every ratio is 0.
    """
    chars = samples.select(F.col(random_col).cast("boolean").alias("r"), F.split(F.col(text_col), "").alias("c"))
    chars = chars.where(F.col("r").isNotNull() & (F.size("c") > 0))
    pairs = chars.select("r", F.posexplode("c").alias("i", "b"), "c").select(
        "r", _code(F.when(F.col("i") > 0, F.get("c", F.col("i") - 1)).otherwise(F.lit(" "))).alias("a"),
        _code(F.col("b")).alias("b"))
    counts = pairs.groupBy("r", "a", "b").count().collect()
    table = {}
    for kind in (True, False):
        c = {(x["a"], x["b"]): x["count"] for x in counts if x["r"] is kind}
        second, first = [0.5] * _N, [0.0] * _N
        for (a, b), n in c.items():
            first[a] += n
            second[b] += n
        total = sum(second)
        table[kind] = [math.log((c.get((a, b), 0) + smoothing * second[b] / total) / (first[a] + smoothing))
                       for a in range(_N) for b in range(_N)]
    return [x - y for x, y in zip(table[True], table[False], strict=True)]


def ratio(text: Column, table: list[float]) -> Column:
    """Log-likelihood ratio of a string: random over ordinary."""
    values = F.expr("array(" + ",".join(f"{x:.9e}D" if x else "0D" for x in table) + ")")
    codes = F.transform(F.split(text, ""), _code)
    step = F.aggregate(
        codes, F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("last")),
        lambda acc, b: F.struct((acc["sum"] + F.element_at(values, acc["last"] * _N + b + 1)).alias("sum"),
                                b.alias("last")))
    return step["sum"]


def matches(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(uid, doc_id, found): per text and kind the matched strings, the values of assignments, the gaps' lengths."""
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    patterns = dict(zip(KINDS, (ASSIGN, ACCESS, HEX, RUN), strict=True))
    rows = rows.select("*", *[_find(F.col("t"), p).alias(k) for k, p in patterns.items()])
    gaps = [F.when(F.size(k) > 0, F.transform(F.split("t", p, -1), F.length)).alias(f"{k}_gaps")
            for k, p in patterns.items()]
    values = F.when(F.size("assign") > 0, _find(F.col("t"), ASSIGN, 2)).alias("assign_values")
    return rows.select("uid", "doc_id", *KINDS, *gaps, values)


def _placed(found: DataFrame) -> DataFrame:
    """(uid, doc_id, kind, start, end, text) of every match: a match begins after all gaps and matches before it."""
    each = F.explode(F.array(*[
        F.struct(F.lit(k).alias("kind"), F.col(name).alias("m"), F.col(f"{name}_gaps").alias("g"),
                 (F.col("assign_values") if name == "assign" else F.col(name)).alias("v"))
        for k, name in enumerate(KINDS)])).alias("x")
    rows = found.where(" or ".join(f"size({k}) > 0" for k in KINDS)).select("uid", "doc_id", each)
    rows = rows.where(F.size("x.m") > 0).select(
        "uid", "doc_id", "x.kind", F.posexplode(F.arrays_zip("x.m", "x.v", F.slice("x.g", 1, F.size("x.m")).alias("g"))))
    rows = rows.select("uid", "doc_id", "kind", "pos", F.col("col.m").alias("match"), F.col("col.v").alias("text"),
                       F.col("col.g").alias("gap"))
    upto = Window.partitionBy("uid", "kind").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.length("match")).over(upto))
    rows = rows.withColumn("start", F.col("end") - F.length("match"))
    return rows.where((F.col("kind") != 0) | (F.length("text") >= MIN_ASSIGN)).select(
        "uid", "doc_id", "kind", "start", "end", "text")


def corpus_samples(docs: DataFrame, base: DataFrame, *, text_col: str = "text") -> DataFrame:
    """Labelled samples: pattern matches (random) and letter- or digit-only runs (ordinary), over all texts."""
    ordinary = docs.select(F.explode(_find(F.coalesce(F.col(text_col), F.lit("")), ORDINARY)).alias("text"),
                           F.lit(False).alias("is_random"))
    return base.where(F.col("kind") < 3).select("text", F.lit(True).alias("is_random")).unionAll(ordinary)


def scan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", table: list[float] | None = None,
         threshold: float = THRESHOLD) -> DataFrame:
    """Per row: n_assign, n_access, n_hex, base_sha256, spans, n_markov.

    Spans are kind:start:end in code points, end exclusive, in order of start
    and kind.  Base spans are the patterns' matches, leftmost and without
    overlap within a kind, without too short ones.  A run that overlaps no base
    span and scores at least ``threshold`` adds a "markov" span.  ``table`` is
    a trained model; by default it is trained on the corpus' own samples.  Null
    and empty texts have no span; repeated rows are rows of their own.
    """
    found = written(matches(docs, id_col=id_col, text_col=text_col), "secret-matches")
    placed = written(_placed(found), "secret-spans")
    if table is None:
        table = train(corpus_samples(docs, placed, text_col=text_col))
    within = Window.partitionBy("uid").orderBy("start", "kind")
    base = F.col("kind") < 3
    last_end = F.max(F.when(base, F.col("end"))).over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    next_start = F.min(F.when(base, F.col("start"))).over(
        within.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    free = (F.coalesce(last_end, F.lit(0)) <= F.col("start")) & (
        next_start.isNull() | (next_start >= F.col("end")))
    rows = placed.withColumn("free", free).where(base | F.col("free"))
    rows = rows.where(base | (ratio(F.col("text"), table) >= threshold))
    name = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    span = F.concat_ws(":", name, F.col("start").cast("string"), F.col("end").cast("string"))
    spans = rows.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("start", "kind", span.alias("s")))).alias("x"))
    all_rows = found.select("uid", "doc_id").join(spans, "uid", "left")
    count = lambda k: F.coalesce(F.size(F.filter("x", lambda s: s["kind"] == k)), F.lit(0)).cast("long")
    joined = lambda x: F.concat_ws(",", F.coalesce(F.transform(x, lambda s: s["s"]), F.array().cast("array<string>")))
    return all_rows.select(
        "doc_id", *[F.when(F.col("x").isNull(), F.lit(0)).otherwise(count(k)).cast("long").alias(f"n_{KINDS[k]}")
                    for k in range(4)],
        F.sha2(joined(F.filter("x", lambda s: s["kind"] < 3)), 256).alias("base_sha256"),
        joined(F.col("x")).alias("spans"))
