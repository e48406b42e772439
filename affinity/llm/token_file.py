"""Token ids in fixed-width bit-packed files.

A file holds blocks of ids, each id in the fewest bits that the vocabulary
needs, then a footer with the documents' ids and lengths and the byte offset of
every block; so a reader maps the file and unpacks any block at once.  Groups
of 32 ids take as many 32-bit words as an id has bits.
"""

from __future__ import annotations

import os
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from affinity.llm.common import slices, tokenise, written

MAGIC = b"BITS1\0\0\0"
#: Ids of a block (a multiple of 32), and ids of a file at which the next document begins a new one.
BLOCK, FILE_IDS = 1 << 16, 1 << 25
#: Bytes of text that a task encodes at once.
SLICE = 4 << 20
#: Words that a worker keeps encoded.
CACHE_WORDS = 500_000
#: Words of Latin letters and closing marks: their pieces before merging are the letters and the marks.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?$%&*#|\"()\-]*)")


def width_of(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> np.ndarray:
    """32-bit words of ids, padded to a multiple of 32 ids."""
    groups = -(-len(ids) // 32)
    a = np.zeros(groups * 32, np.uint64)
    a[:len(ids)] = ids
    a = a.reshape(groups, 32)
    out = np.zeros((groups, bits), np.uint64)
    for lane in range(32):
        word, shift = divmod(lane * bits, 32)
        out[:, word] |= a[:, lane] << np.uint64(shift)
        if shift + bits > 32:
            out[:, word + 1] |= a[:, lane] >> np.uint64(32 - shift)
    return out.astype(np.uint32).ravel()  # keeps the low 32 bits


def unpack(words: np.ndarray, bits: int, count: int) -> np.ndarray:
    """The first ``count`` ids of packed words."""
    a = np.asarray(words, np.uint64).reshape(-1, bits)
    out = np.empty((len(a), 32), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for lane in range(32):
        word, shift = divmod(lane * bits, 32)
        v = a[:, word] >> np.uint64(shift)
        if shift + bits > 32:
            v = v | (a[:, word + 1] << np.uint64(32 - shift))
        out[:, lane] = v & mask
    return out.ravel()[:count]


class Writer:
    """Writes one file under a passing name; ``close`` gives it its own, so a repeated task replaces it."""

    def __init__(self, path: str, bits: int, block: int = BLOCK):
        self.path, self.bits, self.block = path, bits, block
        self.passing = f"{path}.{os.getpid()}.{id(self)}"
        self.file = open(self.passing, "wb")
        self.docs: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []
        self.offsets: list[int] = []
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = 0

    def add(self, doc_ids: np.ndarray, known: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append(np.stack([doc_ids, known.astype(np.int64)], axis=1))
        self.lengths.append(lengths)
        self.held.append(ids)
        self.n_held += len(ids)
        self.n_ids += len(ids)
        if self.n_held >= self.block:
            ids = np.concatenate(self.held)
            whole = len(ids) // self.block * self.block
            for a in range(0, whole, self.block):
                self._write(ids[a:a + self.block])
            self.held, self.n_held = [ids[whole:]], len(ids) - whole

    def _write(self, ids: np.ndarray) -> None:
        self.offsets.append(self.file.tell())
        self.file.write(pack(ids, self.bits).astype("<u4").tobytes())

    def close(self) -> None:
        if self.n_held:
            self._write(np.concatenate(self.held))
        at = self.file.tell()
        docs = np.concatenate(self.docs) if self.docs else np.empty((0, 2), np.int64)
        lengths = np.concatenate(self.lengths) if self.lengths else np.empty(0, np.int64)
        for a in (docs, lengths, np.array(self.offsets, np.int64)):
            self.file.write(a.astype("<i8").tobytes())
        self.file.write(struct.pack("<qqqqqq", at, len(docs), len(self.offsets), self.n_ids, self.block, self.bits))
        self.file.write(MAGIC)
        self.file.close()
        os.replace(self.passing, self.path)


class Reader:
    """Maps a file; ``read(a, b)`` unpacks the blocks that ids a to b lie in."""

    def __init__(self, path: str):
        self.data = np.memmap(path, np.uint8, "r")
        if bytes(self.data[-8:]) != MAGIC:
            raise ValueError(f"{path} is no token file")
        at, docs, blocks, self.n_ids, self.block, self.bits = struct.unpack("<qqqqqq", bytes(self.data[-56:-8]))
        foot = np.frombuffer(bytes(self.data[at:-56]), "<i8")
        self.docs = foot[:2 * docs].reshape(docs, 2)
        self.lengths = foot[2 * docs:3 * docs]
        self.offsets = foot[3 * docs:3 * docs + blocks]
        self.starts = np.concatenate(([0], np.cumsum(self.lengths))).astype(np.int64)

    def read(self, a: int, b: int) -> np.ndarray:
        if a >= b:
            return np.empty(0, np.uint32)
        first, last = a // self.block, (b - 1) // self.block
        out = []
        for k in range(first, last + 1):
            count = min(self.block, self.n_ids - k * self.block)
            size = -(-count // 32) * self.bits * 4
            part = self.data[self.offsets[k]:self.offsets[k] + size]
            out.append(unpack(np.frombuffer(part.tobytes(), "<u4"), self.bits, count))
        return np.concatenate(out)[a - first * self.block:b - first * self.block]


def _bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    """Ids of texts, word by word, as the tokenizer gives them for the whole text.

    White space always ends a piece and no normalisation reaches across it, so
    a text's ids are its words' ids in turn.  Encoded words are kept, so a word
    is encoded about once a worker.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spell = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.letters = str.maketrans({c: spell(c)[0][0] for c in map(chr, range(0xDF, 0x100)) if c.isalpha()})
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        got = self.pieces.get(piece)
        if got is None:
            spelled = piece if piece.isascii() else piece.translate(self.letters)
            got = self.pieces[piece] = _bytes([t.id for t in self.tokenizer.model.tokenize(spelled)])
        return got

    def encode_words(self, words: list[str]) -> list[bytes]:
        if len(self.words) > CACHE_WORDS or len(self.pieces) > CACHE_WORDS:
            self.words, self.pieces = {}, {}
        out: list = [self.words.get(w) for w in words]
        rest = []
        for i, w in enumerate(words):
            if out[i] is None:
                if m := _PLAIN.fullmatch(w):
                    letters, marks = m.groups()
                    got = self._piece(letters.lower())
                    out[i] = self.words[w] = got + self._piece(marks) if marks else got
                else:
                    rest.append(i)
        for a in range(0, len(rest), 1024):
            part = rest[a:a + 1024]
            for i, e in zip(part, self.tokenizer.encode_batch_fast([words[i] for i in part],
                                                                  add_special_tokens=False), strict=True):
                out[i] = self.words[words[i]] = _bytes(e.ids)
        return out

    def encode(self, text: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each with its end id; number of each)."""
        codes, offsets, words = tokenise(text)
        per_word = [*self.encode_words(words.to_pylist()), np.array([end_id], "<u4").tobytes()]
        length = np.fromiter((len(x) // 4 for x in per_word), np.int64, len(per_word))
        flat = np.frombuffer(b"".join(per_word), "<u4")
        begin = np.cumsum(length) - length
        codes = np.insert(codes, offsets[1:], len(per_word) - 1)
        ends = offsets[1:] + np.arange(1, len(offsets))
        n = length[codes]
        upto = np.concatenate(([0], np.cumsum(n)))
        ids = flat[np.repeat(begin[codes] - upto[:-1], n) + np.arange(upto[-1])]
        return ids, np.diff(np.concatenate(([0], upto[ends])))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a tokenizer file."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, *, end_id: int = 2, id_col: str = "doc_id",
                      text_col: str = "text", block: int = BLOCK, file_ids: int = FILE_IDS) -> DataFrame:
    """Encode texts and write their ids in ascending order of id; a row (path, part, number, n_ids) per file.

    Null and empty texts have the end id alone.  Null ids come first; repeated
    ids follow each other, each a document.  An empty table writes no file.
    ``folder`` must be one that all machines share.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.monotonically_increasing_id().alias("tie"))
    rows = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def write(batches):
        part, number, out = TaskContext.get().partitionId(), 0, None
        own = encoder(tokenizer)
        bits = width_of(max(own.tokenizer.get_vocab_size(), end_id + 1))

        def done():
            out.close()
            return pa.RecordBatch.from_pydict({"path": [out.path], "part": pa.array([part], pa.int64()),
                                               "number": pa.array([number], pa.int64()),
                                               "n_ids": pa.array([out.n_ids], pa.int64())})
        for batch in batches:
            for piece in slices(batch, "text", SLICE):
                ids, lengths = own.encode(piece.column("text"), end_id)
                keys = piece.column("doc_id")
                if out is None:
                    out = Writer(f"{folder}/{part:06d}-{number:06d}.bits", bits, block)
                out.add(keys.fill_null(0).to_numpy(), keys.is_valid().to_numpy(zero_copy_only=False), lengths, ids)
                if out.n_ids >= file_ids:
                    yield done()
                    out, number = None, number + 1
        if out is not None:
            yield done()

    return written(rows.mapInArrow(write, "path string, part long, number long, n_ids long"), "token-files")


def read_token_files(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Per document: doc_id, start (ids before it in all files), n_tokens, ids_crc32 (of its ids as 32-bit words)."""
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    placed = files.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
    placed = placed.repartition(max(1, min(files.count(), 4096)))

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                file = Reader(row["path"])
                at = 0
                while at < len(file.lengths):  # some blocks of documents at a time
                    to = max(at + 1, int(np.searchsorted(file.starts, file.starts[at] + (1 << 20), "right")) - 1)
                    begin = file.starts[at]
                    ids = memoryview(file.read(begin, file.starts[to]).astype("<u4")).cast("B")
                    cuts = ((file.starts[at:to + 1] - begin) * 4).tolist()
                    crc = [zlib.crc32(ids[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
                    keys, known = file.docs[at:to, 0], file.docs[at:to, 1] == 1
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(keys, pa.int64(), mask=~known),
                        "start": pa.array(file.starts[at:to] + row["base"], pa.int64()),
                        "n_tokens": pa.array(file.lengths[at:to], pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})
                    at = to

    return placed.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
