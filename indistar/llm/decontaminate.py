"""Benchmark decontamination with a generalised suffix automaton.

The normalised words of all benchmark items form one automaton; each
document's words are streamed through it while the longest match ending at
each word is tracked.  Wherever the match is at least a window long, the
words of the window are hit and the items owning it are noted.  Words that
cannot be part of a window (their pair with the neighbour occurs in no item)
are stepped over with numpy; the automaton reads the runs between.

Tasks cut the items into blocks of a bounded number of words and build each
block's automaton, whose states, transitions and owners are plain arrays (some
30 bytes a word).  The documents are read once for every ``PASS_BLOCKS``
blocks, written between passes, so a benchmark of any size works, nothing of
unknown size is broadcast, and neither the driver nor a task holds more than
that many blocks.  No shuffle.
"""

from __future__ import annotations

import hashlib
import pickle
from array import array
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indistar.llm.common import claim, map_texts, materialise, utf8

WINDOW = 10
BLOCK_WORDS = 1_000_000
PASS_BLOCKS = 4
_KEEP = frozenset([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
_TO_BLANK = bytes(b if b in _KEEP else 0x20 for b in range(256))


def words_of(raw: bytes | None) -> list[bytes]:
    """Lower-cased words of digits, letters and non-ASCII signs."""
    return raw.lower().translate(_TO_BLANK).split() if raw else []


class ItemAutomaton:
    """Generalised suffix automaton over word ids of several items.

    A state's first transition is in two arrays, further ones in a sorted array
    of (state, word) keys, those of the root in a table by word.
    """

    def __init__(self, items: list[list[bytes]], window: int = WINDOW):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        seqs = [array("i", [self.vocab.setdefault(w, len(self.vocab)) for w in ws]) for ws in items]
        self.word, self.next = array("i", [-1]), array("i", [0])
        self.link, self.len = array("i", [-1]), array("i", [0])
        self._more: dict[int, int] = {}
        self._words_of: dict[int, list[int]] = {}
        for seq in seqs:
            last = 0
            for w in seq:
                last = self._extend(last, w)
        self._own(seqs)
        n = len(self.vocab)
        pairs = [np.asarray(q[:-1], np.int64) * n + np.asarray(q[1:], np.int64) for q in seqs if len(q) > 1]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        self.least = min((min(window, len(s)) for s in seqs if s), default=0)
        self.root = array("i", [self._step(0, w) for w in range(n)])
        keys = np.fromiter(self._more, np.int64, len(self._more))
        order = np.argsort(keys)
        self.keys = array("q", keys[order].tobytes())
        self.targets = array("i", np.fromiter(self._more.values(), np.int32, len(keys))[order].tobytes())
        del self._more, self._words_of

    def _step(self, state: int, w: int) -> int:
        """The next state while building; 0 if there is none."""
        return self.next[state] if self.word[state] == w else self._more.get(state << 32 | w, 0)

    def _put(self, state: int, w: int, target: int) -> None:
        if self.word[state] in (-1, w):
            self.word[state], self.next[state] = w, target
            return
        key = state << 32 | w
        if key not in self._more:
            self._words_of.setdefault(state, []).append(w)
        self._more[key] = target

    def _state(self, size: int, link: int, word: int = -1, target: int = 0) -> int:
        self.len.append(size), self.link.append(link), self.word.append(word), self.next.append(target)
        return len(self.len) - 1

    def _extend(self, last: int, w: int) -> int:
        link, ln = self.link, self.len
        if q := self._step(last, w):
            return q if ln[q] == ln[last] + 1 else self._split(last, q, w)
        cur = self._state(ln[last] + 1, 0)
        p = last
        while p != -1 and not self._step(p, w):
            self._put(p, w, cur)
            p = link[p]
        if p != -1:
            q = self._step(p, w)
            link[cur] = q if ln[q] == ln[p] + 1 else self._split(p, q, w)
        return cur

    def _split(self, p: int, q: int, w: int) -> int:
        clone = self._state(self.len[p] + 1, self.link[q], self.word[q], self.next[q])
        if q in self._words_of:
            self._words_of[clone] = list(self._words_of[q])
            for other in self._words_of[q]:
                self._more[clone << 32 | other] = self._more[q << 32 | other]
        self.link[q] = clone
        while p != -1 and self._step(p, w) == q:
            self._put(p, w, clone)
            p = self.link[p]
        return clone

    def _own(self, seqs: list[array]) -> None:
        """Which items own the windows of a state, how long these are, and the
        nearest state on the way up the links that owns windows."""
        link, ln, found = self.link, self.len, (array("i"), array("i"), array("i"))
        for k, seq in enumerate(seqs):
            size, state, n = min(self.window, len(seq)), 0, 0
            for w in seq:
                state, n = self._step(state, w), n + 1
                if n > size:  # the first word falls out of the window
                    n = size
                    if ln[link[state]] == size:
                        state = link[state]
                if n == size:
                    for column, v in zip(found, (state, size, k)):
                        column.append(v)
        rows = np.unique(np.array([np.asarray(c) for c in found], np.int32).reshape(3, -1), axis=1)
        self.size, self.item = (array("i", rows[i].tobytes()) for i in (1, 2))
        starts = np.searchsorted(rows[0], np.arange(len(ln) + 1)).astype(np.int32)
        self.owned = array("i", starts.tobytes())
        up = array("i", [-1]) * len(ln)
        for state in np.argsort(np.asarray(ln), kind="stable")[1:].tolist():
            up[state] = state if starts[state] < starts[state + 1] else up[link[state]] if link[state] > 0 else -1
        self.up = up

    def scan(self, words: list[bytes], hit: np.ndarray) -> set[int]:
        """Mark the hit words; the items whose windows occur."""
        items: set[int] = set()
        if len(words) < self.least or not self.least:
            return items
        get = self.vocab.get
        ids = np.array([get(w, -1) for w in words], np.int64)
        if self.least == 1:
            starts, ends = self._runs(ids >= 0, 0)
        else:
            known = (ids[:-1] >= 0) & (ids[1:] >= 0)
            at = np.flatnonzero(known)
            key = ids[at] * len(self.vocab) + ids[at + 1]
            place = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            ok = np.zeros(len(ids) - 1, bool)
            ok[at[self.pairs[place] == key]] = True
            starts, ends = self._runs(ok, 1)
        for a, z in zip(starts.tolist(), ends.tolist()):
            if z - a >= self.least:
                self._stream(ids[a:z].tolist(), a, hit, items)
        return items

    @staticmethod
    def _runs(ok: np.ndarray, more: int) -> tuple[np.ndarray, np.ndarray]:
        edge = np.diff(np.concatenate([[0], ok.view(np.int8), [0]]))
        return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + more

    def _stream(self, ids: list[int], at: int, hit: np.ndarray, items: set[int]) -> None:
        word, nxt, link, ln, up = self.word, self.next, self.link, self.len, self.up
        keys, targets, owned, sizes, owner = self.keys, self.targets, self.owned, self.size, self.item
        state = size = 0
        for k, w in enumerate(ids):
            while state:
                if word[state] == w:
                    state = nxt[state]
                    break
                key = state << 32 | w
                place = bisect_left(keys, key)
                if place < len(keys) and keys[place] == key:
                    state = targets[place]
                    break
                state = link[state]
                size = ln[state]
            else:
                state = self.root[w]
            size += 1
            s = up[state]
            while s > 0:
                for j in range(owned[s], owned[s + 1]):
                    length = sizes[j]
                    if length <= size:
                        end = at + k + 1
                        hit[end - length:end] = True
                        items.add(owner[j])
                s = up[link[s]] if link[s] > 0 else -1


def _pieces(ws: list[bytes], window: int, most: int) -> Iterator[list[bytes]]:
    """An item in pieces of at most ``most`` words that overlap by a window less
    a word, so each window lies in a piece; a short item is one piece."""
    for start in range(0, max(len(ws) - window + 1, 1), most - window + 1):
        yield ws[start:start + most]


def item_automata(items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS,
                  id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """The items' automata, one row a block of about ``block_words`` words at
    most: ``automaton`` holds the item names and the automaton, pickled."""
    most = max(block_words, 4 * window)

    def row(names: list[str], pieces: list[list[bytes]]) -> pa.RecordBatch:
        block = pickle.dumps((names, ItemAutomaton(pieces, window)), pickle.HIGHEST_PROTOCOL)
        return pa.RecordBatch.from_arrays([pa.array([block], pa.binary())], names=["automaton"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("automaton")
        names, pieces, n = [], [], 0
        for b in batches:
            for name, raw in zip(b.column(0), b.column(1)):
                for piece in _pieces(words_of(raw.as_py()), window, most):
                    if not piece:
                        continue
                    if pieces and n + len(piece) > block_words:
                        yield row(names, pieces)
                        names, pieces, n = [], [], 0
                    names.append(name.as_py() or "")
                    pieces.append(piece)
                    n += len(piece)
        if pieces:
            yield row(names, pieces)
    return map_texts(items.select(F.col(id_col).cast("string").alias("item_id"), utf8(text_col).alias("text")), build,
                     "automaton binary")


def _scan(blocks: list, words: list[bytes], old: pa.Scalar, names: pa.Scalar) -> tuple[list[str], np.ndarray, list[bytes]]:
    """Names of the items found so far and in the blocks, the words hit, the words."""
    hit = np.unpackbits(np.frombuffer(old.as_py(), np.uint8), count=len(words)).view(bool).copy() \
        if old.is_valid else np.zeros(len(words), bool)
    found = names.as_py()
    for block in blocks:
        own, automaton = block.value
        found = found + [own[k] for k in automaton.scan(words, hit)]
    return found, hit, words


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS,
                  id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256,
    contaminated``, then the columns named in ``keep`` and ``clean_text`` (the
    words not hit) if ``keep`` is given.

    Null or empty texts have no words and null or empty items no windows; a
    null item id is named ``""``.  Items with one id are one item.  Repeated
    documents get a row each; null ids are allowed.  Without documents the
    result is empty; without items nothing is hit.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("text"),
                       F.lit(None).cast("binary").alias("hit"), F.array().cast("array<string>").alias("items"),
                       F.struct(*(keep or [F.lit(1).alias("one")])).alias("rest"))
    schema = rows.schema

    def pass_over(blocks):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            claim("automaton")
            for b in batches:
                hits, found = [], []
                for raw, old, names_so_far in zip(b.column(1), b.column(2), b.column(3)):
                    names, mask, _ = _scan(blocks, words_of(raw.as_py()), old, names_so_far)
                    hits.append(np.packbits(mask).tobytes())
                    found.append(names)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(hits, pa.binary()), pa.array(found, pa.list_(pa.string())),
                     b.column(4)], names=["doc_id", "text", "hit", "items", "rest"])
        return run

    held: list = []  # the last blocks run in the finishing pass
    for block in materialise(item_automata(items, window, block_words, item_id, item_text), "automata").toLocalIterator():
        if len(held) == PASS_BLOCKS:
            rows = materialise(map_texts(rows, pass_over(held), schema), "contamination")
            held = []
        held.append(spark.sparkContext.broadcast(pickle.loads(block.automaton)))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("automaton")
        for b in batches:
            out: list[tuple] = []
            for raw, old, names_so_far in zip(b.column(1), b.column(2), b.column(3)):
                found, mask, words = _scan(held, words_of(raw.as_py()), old, names_so_far)
                names = sorted(set(found))
                n = int(mask.sum())
                out.append((len(words), n, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), n > 0,
                            b" ".join(w for w, m in zip(words, mask) if not m).decode("utf-8", "replace")
                            if keep else None))
            cols = list(zip(*out)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds)), b.column(4)],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "clean_text", "rest"])

    out = map_texts(rows, finish, "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, "
                                  f"contaminated boolean, clean_text string, rest {schema['rest'].dataType.simpleString()}")
    base = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return out.select(*base, "clean_text", "rest.*") if keep else out.select(*base)


def drop_contaminated(docs: DataFrame, items: DataFrame, max_share: float = 0.0, **options) -> DataFrame:
    """``docs`` without the documents of which more than ``max_share`` of the
    words are hit; all columns and texts stay, whatever their names.  Texts
    without words, null ones too, have no hit and stay; an empty table stays
    empty, and without items all documents stay."""
    flagged = contamination(docs.withColumn("_row", F.struct(*docs.columns)), items, keep=["_row"], **options)
    return flagged.where(F.col("n_hit") <= F.lit(max_share) * F.col("n_words")).select("_row.*")
