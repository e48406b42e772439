"""Fill-in-middle transformation with a sparse index of the characters that are not one byte.

Texts stay UTF-8 bytes.  The index of a slice of texts holds only its multibyte
characters: where each one starts, and how many bytes beyond one it takes.  A
cut at a code point becomes a cut at a byte, and the other way round, by one
``searchsorted`` in it and a sum; where a text is ASCII nothing is stored and the
two are equal.  Everything is done for a whole slice at once, save the hashes'
rest and the joining of bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm.common import map_slices

# The marks before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


class ExceptionIndex:
    """Multibyte characters of some bytes: the byte each starts at and the excess bytes up to and with each."""

    def __init__(self, data: np.ndarray):
        self.at = np.flatnonzero(data >= 0xC0)
        lead = data[self.at]
        self.excess = np.concatenate(([0], np.cumsum(1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0))))
        #: The same places counted in code points.
        self.point = self.at - self.excess[:-1]

    def points(self, byte: np.ndarray) -> np.ndarray:
        """Code points before the given bytes (each the start of a character)."""
        return byte - self.excess[np.searchsorted(self.at, byte)]

    def bytes(self, point: np.ndarray) -> np.ndarray:
        """Bytes before the given code points."""
        return point + self.excess[np.searchsorted(self.point, point)]


def draws(id_col: str, seed: int = 7) -> list[Column]:
    """Four 32-bit numbers of a row: the first 8-digit groups of the SHA-256 of ``seed:id`` (null id: no digits)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def _lines(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Newlines before each text, and the number of lines of each."""
    breaks = np.flatnonzero(data == 10)
    before, upto = np.searchsorted(breaks, start), np.searchsorted(breaks, end)
    open_end = (end > start) & (data[np.maximum(end - 1, 0)] != 10) if len(data) else end > start
    return breaks, upto - before + open_end


def _buffer(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an array of texts and the offsets of each."""
    text = text.cast(pa.large_string())
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2], np.uint8) if text.buffers()[2] is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]] if len(data) else data, offsets - offsets[0]


def cut(text: pa.Array, low: np.ndarray, high: np.ndarray, unit: str = "line") -> dict[str, np.ndarray]:
    """Cut each text after ``low % (n + 1)`` and ``high % (n + 1)`` of its n units, the smaller first.

    Bytes of the slice where texts and their middles start and end, n, and the
    code points of prefix and middle.
    """
    data, offsets = _buffer(text)
    start, end = offsets[:-1], offsets[1:]
    index = ExceptionIndex(data)
    if unit == "line":
        breaks, n = _lines(data, start, end)
    else:
        n = index.points(end) - index.points(start)
    first, second = low % (n + 1), high % (n + 1)
    first, second = np.minimum(first, second), np.maximum(first, second)

    def place(k: np.ndarray) -> np.ndarray:
        if unit != "line":
            return index.bytes(index.points(start) + k)
        ends = np.concatenate((breaks + 1, [len(data)]))
        at = ends[np.minimum(np.searchsorted(breaks, start) + k - 1, len(breaks))]
        return np.where(k == 0, start, np.where(k == n, end, at))

    a, b = place(first), place(second)
    return {"data": data, "start": start, "a": a, "b": b, "end": end, "n": n,
            "prefix": index.points(a) - index.points(start), "middle": index.points(b) - index.points(a)}


def transform(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", unit: str = "line",
              fim_percent: int = 100, spm_percent: int = 50, seed: int = 7) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row, cut by numbers drawn from its id.

    ``unit`` is "line" or "char".  ``form`` is plain (the text itself; empty
    texts, texts that hold a mark, and those not drawn), spm (suffix first) or
    psm; only plain rows have null character counts.  A null text is empty; rows
    of equal ids are drawn alike, and a null id is drawn as one without digits.
    A text of any length is worked on whole; memory is bounded by a slice or the
    longest text.  An empty table gives no rows.
    """
    if unit not in ("line", "char"):
        raise ValueError(f"unknown unit {unit!r}")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       *draws(id_col, seed))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        h1, h2, h3, h4 = (batch.column(f"h{k}").to_numpy() for k in (1, 2, 3, 4))
        c = cut(batch.column("text"), h1, h2, unit)
        data, plain, spm = c["data"].tobytes(), h3 % 100 >= fim_percent, h4 % 100 < spm_percent
        marks = [PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()]
        forms, out = [], []
        for i, (s, a, b, e) in enumerate(zip(*(c[k].tolist() for k in ("start", "a", "b", "end")), strict=True)):
            whole = data[s:e]
            if s == e or plain[i] or any(m in whole for m in marks):
                forms.append("plain")
                out.append(whole)
                continue
            forms.append("spm" if spm[i] else "psm")
            head, tail = marks[0] + data[s:a], marks[1] + data[b:e]
            out.append((tail + head if spm[i] else head + tail) + marks[2] + data[a:b])
        none = np.array([f == "plain" for f in forms], bool)
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(c["n"], pa.int64()), pa.array(forms, pa.string()),
             pa.array(c["prefix"], pa.int64(), mask=none), pa.array(c["middle"], pa.int64(), mask=none),
             pa.array(out, pa.binary()).cast(pa.string())],
            ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return map_slices(rows, run, f"doc_id {dict(rows.dtypes)['doc_id']}, n long, form string, prefix_chars long, "
                                 "middle_chars long, output string")


def restored(form: Column, output: Column) -> Column:
    """The text that ``output`` was made from.  The marks are not part of it, so they tell its parts apart."""
    parts = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)))
    head = F.when(form == "psm", F.get(parts, F.lit(1))).otherwise(F.get(parts, F.lit(2)))
    tail = F.when(form == "psm", F.get(parts, F.lit(2))).otherwise(F.get(parts, F.lit(1)))
    return F.when(form == "plain", output).otherwise(F.concat(head, F.get(parts, F.lit(3)), tail))
