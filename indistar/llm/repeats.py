"""Removal of byte strings of a minimum length that repeat anywhere.

1. Cutting the corpus.  Every window of ``length`` bytes is assigned to the
   least hash of its ``GRAM``-byte strings; consecutive windows with the same
   least hash form a fragment.  Equal windows have equal least hashes, so they
   can only meet inside one hash group, and groups are independent: one
   shuffle of small (hash, fragment digest, place) rows finds those that can
   hold repeats.  Whole equal fragments are counted, not compared again.
2. Threshold-bounded interval expansion.  The distinct fragments of the other
   groups are sent to tasks, a whole group to one task, and joined to texts of
   a bounded size.  The Burrows-Wheeler transform of such a text is expanded
   breadth-first: intervals of strings of growing length are extended backward
   by every preceding byte, and the right border of an interval that is new
   gets the current length as its common prefix.  The expansion stops at the
   minimum length; borders without a value then join suffixes that share at
   least that many bytes.
3. The repeated windows go back to their documents by hash and digest, and
   every byte that one of them covers is removed.

A group with very many distinct fragments (text around a passage that a large
part of the corpus shares) is not sent to one task: its windows are hashed one
by one to 128 bits and counted by a shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indistar.llm.common import materialise, utf8

LENGTH = 400
GRAM = 128
HOT = 20_000  # distinct fragments from which a group is split by window
BROADCAST_ROWS = 500_000  # places of fragments (about 40 MB) that are broadcast; more are joined by a shuffle
TEXT = 2 << 20  # bytes of fragments for one transform
BLOCK = 1 << 20  # windows of a document that are hashed at once
SEED = 8  # the first levels are one sort of 8-byte words
NO_ID = -(1 << 63)
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def gram_hashes(data: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """A hash of each ``size``-byte string of a byte array; ``size`` is a
    multiple of 8."""
    n = len(data) - size + 1
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    h = (words ^ np.uint64(seed)) * _M1
    h ^= h >> np.uint64(32)
    out = np.zeros(n, np.uint64)
    for k in range(0, size, 8):
        out = (out ^ h[k:k + n]) * _M2
        out ^= out >> np.uint64(29)
    return out


def _sliding_least(h: np.ndarray, width: int) -> np.ndarray:
    n = len(h)
    x = np.full(-(-n // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    x[:n] = h
    x = x.reshape(-1, width)
    ahead = np.minimum.accumulate(x, axis=1).ravel()
    back = np.minimum.accumulate(x[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def fragments_of(raw: bytes, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[int, int, int, int, bool]]:
    """``(hash, start, size, digest, own)`` of each fragment of a text;
    ``own`` says that a window may repeat inside the fragment itself."""
    data, width = np.frombuffer(raw, np.uint8), length - gram + 1
    for first in range(0, len(data) - length + 1, BLOCK):
        part = np.ascontiguousarray(data[first:first + BLOCK + length - 1])
        h = gram_hashes(part, gram)
        least = _sliding_least(h, width)
        starts = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
        ends = np.append(starts[1:], len(least))
        values = least[starts]
        view = part.tobytes()
        for a, z, v in zip(starts.tolist(), ends.tolist(), values):
            own = z - a > 1 and np.count_nonzero(h[a:z + width - 1] == v) > 1
            yield int(v), first + a, z - a + length - 1, xxhash.xxh3_64_intdigest(view[a:z + length - 1]), bool(own)


def _signed(values) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def common_prefix_borders(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """``sa, lcp`` of a text: suffixes sorted by their first ``length`` bytes
    at least, and the common prefix of each with the one before it where that
    is below ``length``, else -1."""
    tail = np.random.default_rng(7).integers(0, 256, 64 + SEED, dtype=np.uint8)  # ends the text as no other string does
    t = np.concatenate([np.frombuffer(text, np.uint8), tail])
    n = len(t) - SEED
    word = np.ndarray((n,), ">u8", t, strides=(1,)).astype(np.uint64)
    sa = np.argsort(word, kind="stable")
    ordered = word[sa]
    differs = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    # the common prefixes below SEED bytes, and the intervals of SEED bytes
    lcp = np.full(n + 1, -1, np.int32)
    at = np.flatnonzero(differs[1:]) + 1
    xor = ordered[at] ^ ordered[at - 1]
    lcp[at] = sum((xor < (np.uint64(1) << np.uint64(64 - 8 * k))).astype(np.int32) for k in range(1, SEED))
    lcp[0] = lcp[n] = 0
    low = np.flatnonzero(differs)
    high = np.append(low[1:], n)
    # order by prefix doubling, up to the minimum length
    rank = np.empty(n, np.int64)
    rank[sa] = np.cumsum(differs) - 1
    depth = SEED
    while depth < length:
        ahead = np.zeros(n, np.int64)
        ahead[:n - depth] = rank[depth:] + 1
        key = rank * (n + 1) + ahead
        sa = np.argsort(key)
        ordered = key[sa]
        rank[sa] = np.cumsum(np.concatenate([[False], ordered[1:] != ordered[:-1]]))
        depth *= 2
    isa = np.empty(n, np.int64)
    isa[sa] = np.arange(n)
    before = isa[sa - 1]  # place of the suffix one byte longer
    byte = t[sa - 1].astype(np.int64)
    byte[sa == 0] = -1
    # breadth-first backward extension
    for level in range(SEED, length):
        if not len(low):
            break
        size = high - low
        one = size == 1
        single = low[one]
        lo = before[single[byte[single] >= 0]]
        hi = lo + 1
        many, size = low[~one], size[~one]
        if len(many):
            ends = np.cumsum(size)
            where = np.repeat(many - ends + size, size) + np.arange(int(ends[-1]))
            key = np.repeat(np.arange(len(many)), size) * 256 + byte[where]
            inside = byte[where] >= 0
            key, to = key[inside], before[where[inside]]
            order = np.argsort(key, kind="stable")
            key, to = key[order], to[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
            if len(first):
                least = np.minimum.reduceat(to, first)
                lo = np.concatenate([lo, least])
                hi = np.concatenate([hi, least + np.diff(np.append(first, len(key)))])
        new = lcp[hi] < 0
        low, high = lo[new], hi[new]
        lcp[high] = level
    return sa, lcp[:n]


def repeated_starts(fragments: list[bytes], weights: list[int], length: int = LENGTH) -> list[np.ndarray]:
    """For each fragment the offsets at which a string of ``length`` bytes
    starts that starts at least twice in all, counting a fragment ``weight``
    times."""
    text = b"".join(fragments)
    sa, lcp = common_prefix_borders(text, length)
    sizes = np.array([len(f) for f in fragments])
    ends = np.cumsum(sizes)
    weight = np.zeros(len(sa), np.int64)
    valid = np.repeat(ends, sizes) - np.arange(len(text)) >= length
    weight[:len(text)] = np.where(valid, np.repeat(np.array(weights), sizes), 0)
    runs = np.flatnonzero(lcp >= 0)
    total = np.add.reduceat(weight[sa], runs)
    twice = np.zeros(len(sa), bool)
    twice[sa] = np.repeat(total >= 2, np.diff(np.append(runs, len(sa))))
    hits = np.flatnonzero(twice[:len(text)] & valid)
    border = np.searchsorted(hits, np.concatenate([[0], ends]))
    return [hits[border[i]:border[i + 1]] - (ends[i] - sizes[i]) for i in range(len(fragments))]


def _covers(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Byte ranges that strings of ``length`` bytes at these starts cover."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > length) + 1
    return [(int(s[0]), int(s[-1]) + length) for s in np.split(starts, cut)]


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("text")).select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.coalesce(F.xxhash64("text"), F.lit(0)).alias("th"), "text")


def _verdicts(fragments: DataFrame, length: int) -> DataFrame:
    """``h, digest, lo, hi``: byte ranges of each fragment to remove."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["h", "digest", "lo", "hi"]
        held: list[tuple] = []
        size = 0

        def work() -> pa.RecordBatch:
            out = [(h, d, lo, hi) for (h, d, _, _), s in zip(held, repeated_starts(
                [x[3] for x in held], [x[2] for x in held], length)) for lo, hi in _covers(s, length)]
            cols = list(zip(*out)) or [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=names)

        for b in batches:
            for h, d, m, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(),
                                    b.column(3)):
                if size >= TEXT and held and held[-1][0] != h:
                    yield work()
                    held, size = [], 0
                held.append((h, d, m, raw.as_py()))
                size += len(held[-1][3])
        if held:
            yield work()

    return fragments.select("h", "digest", F.least("m", F.lit(2)).cast("long").alias("m"), "bytes").repartition("h") \
        .sortWithinPartitions("h").mapInArrow(run, "h long, digest long, lo long, hi long")


def _by_window(fragments: DataFrame, length: int) -> DataFrame:
    """The same for groups too large for a task: each window by its hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for h, d, m, raw in zip(*(b.column(i).to_pylist() for i in range(3)), b.column(3)):
                data = np.frombuffer(raw.as_py(), np.uint8)
                one, two = (gram_hashes(data, length, seed).view(np.int64) for seed in (0, 0x5851F42D4C957F2D))
                n = len(one)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, x, np.int64)) for x in (h, d, m)] + [pa.array(np.arange(n)), pa.array(one),
                                                                           pa.array(two)],
                    names=["h", "digest", "m", "lo", "w1", "w2"])

    windows = fragments.select("h", "digest", F.col("m").cast("long").alias("m"), "bytes").mapInArrow(
        run, "h long, digest long, m long, lo long, w1 long, w2 long")
    twice = windows.groupBy("w1", "w2").agg(F.sum("m").alias("all")).where("all > 1")
    return windows.join(twice, ["w1", "w2"], "left_semi").select("h", "digest", "lo", (F.col("lo") + length).alias("hi"))


def repeat_spans(rows: DataFrame, length: int, gram: int, hot: int) -> DataFrame:
    """``id, th, spans``: byte ranges to remove for each text that has any."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[], [], [], [], [], [], []]

            def batch() -> pa.RecordBatch:
                done = pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), _signed(out[2]),
                     pa.array(out[3], pa.int64()), pa.array(out[4], pa.int64()), _signed(out[5]),
                     pa.array(out[6], pa.bool_())], names=["id", "th", "h", "start", "size", "digest", "own"])
                for column in out:
                    column.clear()
                return done

            for key, th, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                for row in fragments_of(raw.as_py() or b"", length, gram):
                    for column, value in zip(out, (key, th, *row)):
                        column.append(value)
                if len(out[0]) >= 50_000:
                    yield batch()
            if out[0]:
                yield batch()

    places = materialise(rows.mapInArrow(
        cut, "id long, th long, h long, start long, size long, digest long, own boolean"), "fragments")
    # a fragment is known by hash, digest and size; groups with one place and no inner repeat are out
    kinds = places.groupBy("h", "digest").agg(F.count(F.lit(1)).alias("m"), F.max("own").alias("own"),
                                              F.min(F.struct("id", "th", "start", "size")).alias("at"))
    groups = kinds.groupBy("h").agg(F.count(F.lit(1)).alias("kinds"), F.sum("m").alias("all"),
                                    F.max("own").alias("inner")).where("all > 1 OR inner")
    kinds = materialise(kinds.join(groups, "h").select("h", "digest", "m", "kinds", "inner", "at.*"), "kinds")
    alone = (F.col("kinds") == 1) & ~F.col("inner")
    whole = kinds.where(alone).select("h", "digest", F.lit(0).cast("long").alias("lo"), F.col("size").alias("hi"))

    wanted = kinds.where(~alone)
    few = wanted.count() <= BROADCAST_ROWS
    wanted = wanted.groupBy("id", "th").agg(F.collect_list(F.struct("h", "digest", "m", "kinds", "start", "size")).alias("x"))
    texts = rows.join(F.broadcast(wanted) if few else wanted, ["id", "th"])
    parts = texts.select("text", F.explode("x").alias("x")).select(
        "x.h", "x.digest", "x.m", "x.kinds",
        F.substring("text", (F.col("x.start") + 1).cast("int"), F.col("x.size").cast("int")).alias("bytes"))
    parts = materialise(parts.dropDuplicates(["h", "digest"]), "parts")
    verdicts = _verdicts(parts.where(F.col("kinds") <= hot), length).union(
        _by_window(parts.where(F.col("kinds") > hot), length)).union(whole)
    return places.select("id", "th", "h", "digest", "start").join(verdicts, ["h", "digest"]).groupBy("id", "th").agg(
        F.collect_set(F.struct((F.col("start") + F.col("lo")).alias("lo"), (F.col("start") + F.col("hi")).alias("hi"))).alias("spans"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT, id_col: str = "doc_id",
                   text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans,
    kept_sha256`` (and ``kept`` bytes, if asked for).

    A byte goes if a string of ``length`` bytes over it also starts anywhere
    else, the same document included; strings are judged on the input and
    never cross documents.  A null text is empty; texts shorter than
    ``length`` stay whole.  Repeated rows are separate documents and repeat
    each other; a null id is kept as null; other columns are not read; an
    empty table gives an empty result.
    """
    if gram % 8 or length % 8 or not 8 <= gram <= length:
        raise ValueError("lengths must be multiples of 8, and a gram no longer than a string")
    rows = _rows(docs, id_col, text_col)
    spans = materialise(repeat_spans(rows, length, gram, hot), "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, removed, runs, digest, kept = [], [], [], [], []
            for raw, own in zip(b.column(1), b.column(2)):
                data, left, at, gone, count = raw.as_py() or b"", [], 0, 0, 0
                for lo, hi in sorted((s["lo"], s["hi"]) for s in own.as_py() or []):
                    if lo > at or not count:
                        left.append(data[at:lo])
                        count += 1
                        gone += hi - lo
                        at = hi
                    elif hi > at:
                        gone += hi - at
                        at = hi
                left.append(data[at:])
                stays = b"".join(left)
                n.append(len(data))
                removed.append(gone)
                runs.append(count)
                digest.append(hashlib.sha256(stays).hexdigest())
                kept.append(stays if with_text else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(x, pa.int64()) for x in (n, removed, runs)), pa.array(digest, pa.string()),
                 pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    def shown() -> Column:
        return F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id")

    out = rows.join(spans, ["id", "th"], "left").select(shown(), "text", "spans").mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out if with_text else out.drop("kept")
