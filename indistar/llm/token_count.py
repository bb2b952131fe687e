"""Token counts by rank-synchronous merging of ragged numpy arrays.

A text is split into pre-tokens that no vocabulary piece can span (a piece
has the word mark only at its start).  The pre-tokens of a batch that the
process has not met form one flat symbol array with sequence borders.  Each
round looks up the rank of every adjacent pair, takes each sequence's lowest,
and applies it to all sequences at once; a sequence without a mergeable pair
leaves with its surviving symbols counted.  Where merging every occurrence of
the pair would make a new pair of no higher rank, only the leftmost is merged,
so the result equals one-merge-at-a-time encoding.  No shuffle: counting runs
inside the scan tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indistar.llm.common import claim, parts, utf8

MARK = "▁"
_BIG = np.int64(1) << 40
_RUNS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_PART = 1 << 20
SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


class PieceCounter:
    """Merge table of a sentencepiece BPE model with byte fallback, and a
    bounded cache of pre-token counts."""

    def __init__(self, path: str, cache: int = 700_000):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        pieces = {sp.id_to_piece(i): i for i in range(n)
                  if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("a piece spans the start of a word: pre-tokens are not independent")
        # single characters that occur only inside pieces survive as bytes
        chars = sorted({c for p in pieces for c in p})
        ids = dict(pieces)
        for c in chars:
            ids.setdefault(c, len(ids) + n)
        self.char = np.array([ord(c) for c in chars], np.int64)
        self.char_id = np.array([ids[c] for c in chars], np.int64)
        self.weight = np.ones(max(ids.values()) + 1, np.int64)
        for c in chars:
            if c not in pieces:
                self.weight[ids[c]] = len(c.encode())
        scores = sorted({sp.get_score(i) for i in pieces.values()}, reverse=True)
        place = {s: r for r, s in enumerate(scores)}
        rows = [(ids[p[:k]], ids[p[k:]], place[sp.get_score(i)], i)
                for p, i in pieces.items() for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids]
        t = np.array(rows, np.int64).reshape(-1, 4)
        key = (t[:, 0] << 20) | t[:, 1]
        order = np.argsort(key)
        self.key, self.rank, self.made = key[order], t[order, 2], t[order, 3]
        self.limit = cache
        self.cache: dict[str, int] = {}

    def _pairs(self, sym: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of each symbol with its right neighbour."""
        right = np.empty_like(sym)
        right[:-1], right[-1] = sym[1:], -1
        key = (sym << 20) | right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        ok = (self.key[at] == key) & ~last & (sym >= 0) & (right >= 0)
        return np.where(ok, self.rank[at], _BIG), self.made[at]

    @staticmethod
    def _merge(sym, seq, made, mask):
        out = np.where(mask, made, sym)
        keep = np.ones(len(sym), bool)
        keep[1:] = ~mask[:-1]
        return out[keep], seq[keep]

    def merge_counts(self, texts: list[str]) -> np.ndarray:
        """Surviving symbols of each pre-token."""
        total = np.zeros(len(texts), np.int64)
        flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        if not len(flat):
            return total
        seq = np.repeat(np.arange(len(texts)), np.fromiter(map(len, texts), np.int64, len(texts)))
        at = np.minimum(np.searchsorted(self.char, flat), len(self.char) - 1)
        known = self.char[at] == flat
        sym = np.where(known, self.char_id[at], -1)
        lost = 1 + (flat > 0x7F) + (flat > 0x7FF) + (flat > 0xFFFF)  # UTF-8 bytes of an unknown character
        np.add.at(total, seq[~known], lost[~known])
        last = np.empty(len(seq), bool)
        while len(seq):
            last[-1:], last[:-1] = True, seq[1:] != seq[:-1]
            rank, made = self._pairs(sym, last)
            start = np.flatnonzero(np.concatenate([[True], last[:-1]]))
            length = np.diff(np.append(start, len(seq)))
            low = np.minimum.reduceat(rank, start)
            over = np.repeat(low == _BIG, length)
            if over.any():
                known_now = sym[over] >= 0
                np.add.at(total, seq[over][known_now], self.weight[sym[over][known_now]])
                sym, seq, rank, made = sym[~over], seq[~over], rank[~over], made[~over]
                length, low = length[low != _BIG], low[low != _BIG]
                if not len(seq):
                    break
                start = np.cumsum(length) - length
            hit = rank == np.repeat(low, length)
            # of hits side by side, every second one from the left
            n = np.arange(len(hit))
            begin = hit.copy()
            begin[1:] &= ~hit[:-1]
            run = np.maximum.accumulate(np.where(begin, n, 0))
            mask = hit & ((n - run) % 2 == 0)
            first = np.zeros(len(hit), bool)
            first[np.minimum.reduceat(np.where(mask, n, len(n)), start)] = True
            new, new_seq = self._merge(sym, seq, made, mask)
            end = np.empty(len(new), bool)
            end[-1], end[:-1] = True, new_seq[1:] != new_seq[:-1]
            new_start = np.flatnonzero(np.concatenate([[True], end[:-1]]))
            early = np.minimum.reduceat(self._pairs(new, end)[0], new_start) <= low
            if early.any():
                new, new_seq = self._merge(sym, seq, made, np.where(np.repeat(early, length), first, mask))
            sym, seq, last = new, new_seq, np.empty(len(new), bool)
        return total

    def _words(self, text: str) -> list[str]:
        """Pre-tokens of a text that starts with a (possibly added) space."""
        if "  " in text or MARK in text:
            return _RUNS.findall(text.replace(" ", MARK))
        return text.replace(" ", " " + MARK).split(" ")[1:]

    def count(self, text: str) -> int:
        if not text:
            return 0
        total, cache = 0, self.cache
        for k, part in enumerate(parts(text, _PART) if MARK not in text else [text]):
            words = self._words(part if k else " " + part)
            got = list(map(cache.get, words))
            if None in got:
                new = list({w for w, g in zip(words, got) if g is None})
                counted = dict(zip(new, self.merge_counts(new).tolist()))
                total += sum(g if g is not None else counted[w] for w, g in zip(words, got))
                if len(cache) + len(new) > self.limit:
                    cache.clear()
                cache.update(counted)
            else:
                total += sum(got)
        return total

    def counts(self, texts: list[str]) -> list[int]:
        """Counts of many texts; the unknown pre-tokens of a group of texts
        are merged in one go."""
        group, size = [], 0
        out: list[int] = []
        for t in texts + [None]:
            if t is not None:
                group.append(t)
                size += len(t)
            if group and (t is None or size > _PART):
                words = {w for x in group for p in [x[:_PART]] if p for w in self._words(" " + p)}
                new = [w for w in words if w not in self.cache]
                if new:
                    if len(self.cache) + len(new) > self.limit:
                        self.cache.clear()
                    self.cache.update(zip(new, self.merge_counts(new).tolist()))
                out += [self.count(x) for x in group]
                group, size = [], 0
        return out


@lru_cache(maxsize=1)
def _loaded(path: str) -> PieceCounter:
    return PieceCounter(path)


def counter(path: str) -> PieceCounter:
    claim("pieces", _loaded.cache_clear)
    return _loaded(path)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_bytes, n_tokens, over_limit``.

    A null or empty text has no bytes and no tokens.  A null id and repeated
    rows are counted like any other row; other columns are not read.  An empty
    table gives an empty result.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = counter(tokenizer)
        for b in batches:
            raw = b.column(1).to_pylist()
            n = np.array(pieces.counts([x.decode("utf-8", "replace") if x else "" for x in raw]), np.int64)
            size = [len(x) if x else 0 for x in raw]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(size, pa.int64()), pa.array(n), pa.array(n > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(text_col).alias("text")) \
        .mapInArrow(run, SCHEMA)
