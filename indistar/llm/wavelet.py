"""Token ids in wavelet-matrix files.

A file holds succinct bit-planes over the dense codes of its token ids, a rank
directory for each plane and a document table.  Planes are compressed in frames
of ``FRAME`` bytes, so ``WaveletMatrix`` answers access, rank, select, counts and
occurrence lookups from one file by unpacking a frame or two of each plane.  Files are written by Spark as rows of a Parquet table
(one file per row), so any store that Spark writes to will do.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from indistar.llm.common import map_texts, scratch_path, utf8
from indistar.llm.encoder import encoder

MAGIC = b"WVM2"
BLOCK = 512  # bits per rank sample
FRAME = 8192  # bytes of a plane that are compressed together
FILE_SCHEMA = "part int, seq int, n_docs long, n_tokens long, file binary"
ROW_SCHEMA = "part int, seq int, local_start long, doc_id long, n_tokens long, ids_crc32 long"


class Plane:
    """Bits of one level in memory."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def take(self, a: int, z: int) -> np.ndarray:
        return self.bits[a:z]


class StoredPlane:
    """Bits of one level in compressed frames, unpacked as they are asked for;
    the last frame is kept."""

    def __init__(self, body: memoryview, ends: np.ndarray, size: int):
        self.body, self.ends, self.size = body, ends, size
        self.last: tuple[int, np.ndarray] = (-1, np.empty(0, np.uint8))

    def frame(self, k: int) -> np.ndarray:
        if self.last[0] != k:
            data = self.body[int(self.ends[k - 1]) if k else 0:int(self.ends[k])]
            self.last = k, np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
        return self.last[1]

    def take(self, a: int, z: int) -> np.ndarray:
        first, last = a // FRAME, max(a, min(z, self.size) - 1) // FRAME
        if first >= len(self.ends):
            return np.empty(0, np.uint8)
        if first == last:
            return self.frame(first)[a - first * FRAME:z - first * FRAME]
        return np.concatenate([self.frame(k) for k in range(first, last + 1)])[a - first * FRAME:z - first * FRAME]


class WaveletMatrix:
    """Bit-planes from the highest bit down; at each level zeros go first.
    ``samples`` has, for each plane, the ones before each block of BLOCK bits
    and of the whole."""

    def __init__(self, symbols: np.ndarray, n: int, planes: list, samples: list[np.ndarray]):
        self.symbols, self.n, self.planes, self.samples = symbols, n, planes, samples
        self.zeros = [n - int(s[-1]) for s in samples]

    @classmethod
    def of(cls, ids: np.ndarray) -> "WaveletMatrix":
        present = np.bincount(ids, minlength=1) > 0  # token ids are below the vocabulary's size
        symbols = np.flatnonzero(present).astype(ids.dtype)
        codes = (np.cumsum(present) - 1)[ids].astype(np.uint16 if len(symbols) <= 1 << 16 else np.uint32)
        out, planes, samples = np.empty_like(codes), [], []
        for level in range(max(0, int(len(symbols) - 1).bit_length()) - 1, -1, -1):
            ones = (codes & codes.dtype.type(1 << level)) != 0
            bits = np.packbits(ones)
            per_block = np.add.reduceat(np.bitwise_count(bits), np.arange(0, len(bits), BLOCK // 8), dtype=np.int64)
            planes.append(Plane(bits))
            samples.append(np.concatenate([[0], np.cumsum(per_block)]))
            z = len(codes) - int(samples[-1][-1])
            np.compress(~ones, codes, out=out[:z])
            np.compress(ones, codes, out=out[z:])
            codes, out = out, codes
        return cls(symbols, len(ids), planes, samples)

    def __len__(self) -> int:
        return self.n

    def _ones(self, level: int, i: int) -> int:
        """Ones of a plane before position i."""
        block = i // BLOCK
        a = block * BLOCK // 8
        bits = self.planes[level].take(a, (i + 7) // 8)
        n = int(self.samples[level][block]) + int(np.bitwise_count(bits[:i // 8 - a]).sum(dtype=np.int64))
        return n + (int(bits[-1]) >> (8 - i % 8)).bit_count() if i % 8 else n

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level].take(i // 8, i // 8 + 1)[0]) >> (7 - i % 8) & 1

    def access(self, i: int) -> int:
        """The token at position i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        code = 0
        for level in range(len(self.planes)):
            bit = self._bit(level, i)
            code = code << 1 | bit
            ones = self._ones(level, i)
            i = self.zeros[level] + ones if bit else i - ones
        return int(self.symbols[code])

    def _code(self, token: int) -> int | None:
        at = int(np.searchsorted(self.symbols, token))
        return at if at < len(self.symbols) and self.symbols[at] == token else None

    def _range(self, code: int, lo: int, hi: int) -> tuple[int, int]:
        for level in range(len(self.planes)):
            a, b = self._ones(level, lo), self._ones(level, hi)
            if code >> (len(self.planes) - 1 - level) & 1:
                lo, hi = self.zeros[level] + a, self.zeros[level] + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def rank(self, token: int, i: int) -> int:
        """Occurrences of the token before position i."""
        code = self._code(token)
        if code is None:
            return 0
        lo, hi = self._range(code, 0, min(max(i, 0), self.n))
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def _select_bit(self, level: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) bit of a plane."""
        samples = self.samples[level]
        if not bit:
            samples = np.minimum(np.arange(len(samples)) * BLOCK, self.n) - samples
        block = int(np.searchsorted(samples, k, side="right")) - 1
        a = block * BLOCK
        bits = np.unpackbits(self.planes[level].take(a // 8, (a + BLOCK) // 8))[:self.n - a]
        return a + int(np.flatnonzero(bits == bit)[k - int(samples[block])])

    def select(self, token: int, k: int) -> int:
        """Position of the token's k-th occurrence (from 0)."""
        code = self._code(token)
        if code is None or not 0 <= k < self.count(token):
            raise IndexError(k)
        i = self._range(code, 0, 0)[0] + k
        for level in range(len(self.planes) - 1, -1, -1):
            bit = code >> (len(self.planes) - 1 - level) & 1
            i = self._select_bit(level, bit, i - self.zeros[level] if bit else i)
        return i

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    def to_ids(self) -> np.ndarray:
        """The whole sequence, undoing one level of partition at a time."""
        codes = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        out = np.empty_like(codes)
        for level in range(len(self.planes) - 1, -1, -1):
            ones = np.unpackbits(self.planes[level].take(0, (self.n + 7) // 8), count=self.n).view(bool)
            z = self.zeros[level]
            out[np.flatnonzero(~ones)] = codes[:z]
            out[np.flatnonzero(ones)] = codes[z:] | codes.dtype.type(1 << (len(self.planes) - 1 - level))
            codes, out = out, codes
        return self.symbols[codes] if self.n else np.empty(0, self.symbols.dtype)


HEADER = struct.Struct("<4sQQQIQ")


def pack_file(ids: np.ndarray, doc_ids: list, lengths: list[int]) -> bytes:
    """One file: header, compressed symbols and document table, then the rank
    directory, frame ends and compressed frames of each plane."""
    w, zstd = WaveletMatrix.of(ids.astype(np.uint32)), zstandard.ZstdCompressor(level=1)
    tables = zstd.compress(b"".join([
        w.symbols.astype("<u4").tobytes(), np.array([d is not None for d in doc_ids], np.uint8).tobytes(),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), np.array(lengths, "<i8").tobytes()]))
    out = [HEADER.pack(MAGIC, len(ids), len(w.symbols), len(doc_ids), len(w.planes), len(tables)), tables]
    for plane, samples in zip(w.planes, w.samples):
        frames = [zstd.compress(plane.bits[a:a + FRAME]) for a in range(0, len(plane.bits), FRAME)]
        out += [samples.astype("<u4").tobytes(), np.cumsum([len(f) for f in frames]).astype("<u4").tobytes(), *frames]
    return b"".join(out)


def open_file(data: bytes) -> tuple[WaveletMatrix, list, np.ndarray]:
    """The matrix, the document ids and their lengths; planes stay compressed."""
    magic, n, n_symbols, n_docs, n_planes, size = HEADER.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a wavelet-matrix file")
    body, at = memoryview(data), HEADER.size + size
    tables, start = zstandard.ZstdDecompressor().decompress(body[HEADER.size:at]), 0

    def table(kind: str, count: int) -> np.ndarray:
        nonlocal start
        out = np.frombuffer(tables, kind, count, start)
        start += out.nbytes
        return out

    symbols, present, docs, lengths = table("<u4", n_symbols), table("u1", n_docs), table("<i8", n_docs), table("<i8", n_docs)
    planes, samples, in_plane = [], [], (n + 7) // 8
    for _ in range(n_planes):
        counts, frames = -(-n // BLOCK) + 1, -(-in_plane // FRAME)
        samples.append(np.frombuffer(data, "<u4", counts, at).astype(np.int64))
        ends = np.frombuffer(data, "<u4", frames, at + 4 * counts)
        at += 4 * (counts + frames)
        planes.append(StoredPlane(body[at:at + int(ends[-1])], ends, in_plane))
        at += int(ends[-1])
    return WaveletMatrix(symbols, n, planes, samples), [d if p else None for d, p in zip(docs.tolist(), present)], lengths


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, file_tokens: int = 1 << 19,
                      id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text, add the end id, and write files in ascending id
    order (nulls first; repeated ids by text hash).

    Documents are range-partitioned by id and text hash, so a repeated id
    spreads too.  A file closes at the first document end past
    ``file_tokens``; a very long document makes one larger file.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, seq = encoder(tokenizer, 1_000_000), TaskContext.get().partitionId(), 0
        ids, keys, sizes, total = [], [], [], 0

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {"part": [part], "seq": [seq], "n_docs": [len(keys)], "n_tokens": [total],
                 "file": [pack_file(np.concatenate(ids), keys, sizes)]},
                schema=pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()),
                                  ("n_tokens", pa.int64()), ("file", pa.binary())]))
        for b in batches:
            texts = (raw.as_py().decode("utf-8", "replace") if raw.is_valid else "" for raw in b.column(1))
            for key, got in zip(b.column(0).to_pylist(), enc.encode_all(texts)):
                ids += [got, np.array([end_id], np.int32)]
                keys.append(key)
                sizes.append(len(got) + 1)
                total += len(got) + 1
                if total >= file_tokens:
                    yield close()
                    ids, keys, sizes, total, seq = [], [], [], 0, seq + 1
        if keys:
            yield close()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    map_texts(rows, run, FILE_SCHEMA).write.parquet(path)


def read_token_files(files: DataFrame, document_rows=None, schema: str = ROW_SCHEMA) -> DataFrame:
    """Per document of each file: its place in the file and the crc32 of its
    ids; ``document_rows(part, seq, matrix, doc_ids, lengths)`` may give other
    rows under ``schema``."""
    def crcs(part, seq, matrix, doc_ids, lengths) -> pa.RecordBatch:
        ids = matrix.to_ids().astype("<u4")
        ends = np.cumsum(lengths)
        starts = ends - lengths
        return pa.RecordBatch.from_arrays(
            [pa.array([part] * len(doc_ids), pa.int32()), pa.array([seq] * len(doc_ids), pa.int32()),
             pa.array(starts, pa.int64()), pa.array(doc_ids, pa.int64()), pa.array(lengths, pa.int64()),
             pa.array([zlib.crc32(ids[a:z].tobytes()) for a, z in zip(starts.tolist(), ends.tolist())], pa.int64())],
            names=["part", "seq", "local_start", "doc_id", "n_tokens", "ids_crc32"])

    each = document_rows or crcs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, seq, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                yield each(part, seq, *open_file(data.as_py()))

    return map_texts(files.select("part", "seq", "file"), run, schema)


def token_files(docs: DataFrame, tokenizer: str, end_id: int = 0, path: str | None = None, **options) -> DataFrame:
    """Write all documents as wavelet-matrix files and read them back:
    ``doc_id, start, n_tokens, ids_crc32`` per document.

    A null text is empty and has the end id only.  A null id sorts first,
    repeated rows each get their place, other columns are not read, an empty
    table gives an empty result.  ``start`` counts the ids of all documents
    before, from running sums over files within a part and over parts.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token-files")
    write_token_files(docs, path, tokenizer, end_id, **options)
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n")) \
        .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start"))
    in_part = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    places = files.select("part", "seq", F.coalesce(F.sum("n_tokens").over(in_part), F.lit(0)).alias("file_start")) \
        .join(parts, "part").select("part", "seq", (F.col("part_start") + F.col("file_start")).alias("at"))
    return read_token_files(files).join(places, ["part", "seq"]).select(
        "doc_id", (F.col("at") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")
