"""Packing of documents into fixed-length training sequences.

Vector bin packing with the dot-product heuristic: each example has a demand
in three dimensions (tokens, segments, loss-bearing tokens), a sequence has a
limit in each, and the next example is the one whose demand has the largest
dot product with what the open sequence has left, among those that fit.  Where
none fits, one example is cut to fill the rest.  Each task packs the documents
of its own scan split in blocks and carries what is left to the next block, so
nothing is shuffled and a retried task gives the same sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indistar.llm.common import map_texts, utf8
from indistar.llm.encoder import encoder

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, loss_tokens long")


class Packer:
    """Packs (tokens, loss) items; ``emit(sequence, [(item, start, length)])``
    receives each finished sequence."""

    def __init__(self, tokens: int, segments: int, loss: int, emit):
        self.cap = np.array([tokens, segments, loss], np.float64)
        self.emit = emit
        self.sequence = 0

    def _close(self, pieces) -> None:
        self.emit(self.sequence, pieces)
        self.sequence += 1

    def pack(self, items: list, last: bool) -> list:
        """Pack ``(key, start, length, loss rate)`` items.  Unless ``last``,
        items that would leave a sequence part empty are given back."""
        tokens, segments, loss_cap = self.cap
        pool = []
        for key, start, length, rate in items:
            step = int(min(tokens, loss_cap // rate if rate else tokens))
            while length >= step:  # a full sequence on its own
                self._close([(key, start, step)])
                start, length = start + step, length - step
            if length:
                pool.append((key, start, length, rate))
        if not pool:
            return []
        size = np.array([p[2] for p in pool], np.float64)
        need = np.stack([size, np.ones(len(pool)), np.array([p[2] * p[3] for p in pool])], axis=1)
        free = np.ones(len(pool), bool)
        order = np.argsort(-size, kind="stable")  # large first: ties go to the earlier item
        need, index = need[order], order
        scaled = need / self.cap
        total = size.sum()
        while free.any():
            if not last and total < 2 * tokens:
                break
            left, pieces = self.cap.copy(), []
            while True:
                fits = free & (need <= left + 1e-9).all(axis=1)
                if not fits.any():
                    break
                score = np.where(fits, scaled @ (left / self.cap), -1.0)
                k = int(np.argmax(score))
                key, start, length, rate = pool[index[k]]
                pieces.append((key, start, length))
                left -= need[k]
                free[k] = False
                total -= length
                if left[0] < 1 or left[1] < 1:
                    break
            if left[0] >= 1 and left[1] >= 1 and free.any():
                # no example fits whole: cut the largest one to fill the rest
                k = int(np.argmax(free))
                key, start, length, rate = pool[index[k]]
                cut = int(min(left[0], left[2] // rate if rate else left[0], length))
                if cut:
                    pieces.append((key, start, cut))
                    total -= cut
                    pool[index[k]] = (key, start + cut, length - cut, rate)
                    need[k] = [length - cut, 1, (length - cut) * rate]
                    scaled[k] = need[k] / self.cap
                    left[0] -= cut
                    if length == cut:
                        free[k] = False
            if pieces:
                self._finish(pieces, int(tokens - left[0]), last and not free.any())
        return [pool[index[k]] for k in np.flatnonzero(free)]

    def _finish(self, pieces, used: int, final: bool) -> None:
        """A short last sequence is dealt into sequences of powers of two,
        which need no padding."""
        if not final or used == int(self.cap[0]):
            return self._close(pieces)
        room, out = 1 << (used.bit_length() - 1), []
        for key, start, length in pieces:
            while length:
                cut = min(room, length)
                out.append((key, start, cut))
                start, length, room, used = start + cut, length - cut, room - cut, used - cut
                if not room:
                    self._close(out)
                    out = []
                    room = 1 << (used.bit_length() - 1) if used else 0
        if out:
            self._close(out)


def pack_documents(docs: DataFrame, tokenizer: str, end_id: int = 1, max_tokens: int = 2048, max_segments: int = 512,
                   max_loss: int = 2048, block: int = 1024, id_col: str = "doc_id", text_col: str = "text",
                   loss_rate=lambda text: 1.0) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, loss_tokens``.

    ``loss_rate(text)`` is the share of a document's tokens that bear loss
    (all by default).  A null or empty text has the end id only.  Null ids and
    repeated rows are packed like any other; other columns are not read; an
    empty table gives an empty result.  Sequences never mix scan splits:
    ``sequence_id`` holds the split's number above a running number.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, base = encoder(tokenizer), TaskContext.get().partitionId() << 32
        rows: list[tuple] = []
        held: dict[int, tuple] = {}
        number = 0

        def emit(sequence: int, pieces: list) -> None:
            offset = 0
            for key, start, length in pieces:
                doc, ids, rate = held[key]
                rows.append((doc, start, length, zlib.crc32(ids[start:start + length].tobytes()), len(ids),
                             base + sequence, offset, round(length * rate)))
                offset += length

        def batch() -> pa.RecordBatch:
            kinds = [pa.int64()] * 8
            out = pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens"])
            rows.clear()
            return out

        packer, todo = Packer(max_tokens, max_segments, max_loss, emit), []
        for b in batches:
            rates: list[float] = []

            def texts() -> Iterator[str]:
                for raw in b.column(1):
                    text = raw.as_py().decode("utf-8", "replace") if raw.is_valid else ""
                    rates.append(float(min(max(loss_rate(text), 0.0), 1.0)))
                    yield text

            for k, (doc, ids) in enumerate(zip(b.column(0).to_pylist(), enc.encode_all(texts()))):
                ids, rate = np.append(ids, end_id).astype("<u4"), rates[k]
                held[number] = (doc, ids, rate)
                todo.append((number, 0, len(ids), rate))
                number += 1
                if len(todo) >= block:
                    todo = packer.pack(todo, False)
                    held = {t[0]: held[t[0]] for t in todo}
                    yield batch() if rows else pa.RecordBatch.from_pylist([], schema=EMPTY)
        packer.pack(todo, True)
        if rows:
            yield batch()

    return map_texts(docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("text")), run, SCHEMA)


EMPTY = pa.schema([(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                                             "offset", "loss_tokens")])
