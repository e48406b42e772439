"""Helpers shared by the operators: tokens of Arrow text, hashes, written tables."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.session import scratch_path

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: What separates words.
GAP = r"[\x20\x09-\x0D]+"
#: Bytes of text that an Arrow task works on at once.
SLICE_BYTES = 8 << 20

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column | str) -> Column:
    """The words of a text as an array (null: empty)."""
    text = F.col(text) if isinstance(text, str) else text
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, _UPPER, _LOWER)


def remainder(key: str, modulus: int) -> Column:
    """crc32 of a key as text, modulo ``modulus`` (null key: null)."""
    return F.crc32(F.col(key).cast("string")) % modulus


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``limit`` bytes in ``column`` (one row at least)."""
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(size) - size) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield batch.slice(a, b - a)


def map_slices(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str,
               column: str = "text", limit: int = SLICE_BYTES) -> DataFrame:
    """Apply ``fn`` to slices of Arrow batches; memory is bounded by the slice or the longest text."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, column, limit):
                out = fn(part)
                if out is not None:
                    yield out
    return df.mapInArrow(run, schema)


def tokenise(text: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of texts: (code of each word, offsets of each text's words, the words by code)."""
    text = pc.fill_null(text, "")
    if lower:
        text = pc.ascii_lower(text)
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(text))
    flat = lists.flatten().dictionary_encode()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    codes = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    empty = pc.index(flat.dictionary, "").as_py() if len(flat.dictionary) else -1
    if empty >= 0:
        keep = codes != empty
        offsets = np.concatenate(([0], np.cumsum(keep)))[offsets]
        codes = codes[keep]
    return codes, offsets, flat.dictionary


def hashes(strings: pa.Array) -> np.ndarray:
    """64-bit hashes of strings."""
    h = xxhash.xxh3_64_intdigest
    return np.fromiter((h(x) for x in strings.to_pylist()), np.uint64, len(strings))


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of the 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, safe from lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder, below the cluster's shared folder, that tasks open as a mounted path.

    Formats that Spark's own writers do not know are written and memory-mapped
    by tasks, which needs a shared folder mounted on every machine.
    """
    url = urlparse(scratch_path(spark, name))
    if url.scheme not in ("", "file"):
        raise ValueError(f"spark.checkpoint.dir must be a mounted folder for this format, not {url.scheme}:")
    path = unquote(url.path)
    os.makedirs(path)
    return path
