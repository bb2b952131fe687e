"""Token ids of whole texts from a tokenizer file, encoding each distinct
chunk of text once per process.

Both vocabularies used here split text into pre-tokens before any merge, so a
text may be cut at some places without changing its ids: in front of a space
or a full stop that follows a letter, for instance.  The tokenizer library
encodes the chunks that the process has not met; the ids of a text are then
gathered with numpy.  Texts in which a cut could change the result (special
strings, odd white space) are given to the library whole.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from indistar.llm.common import claim, parts

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# A text may be cut in front of blanks, stops and commas if it has plain signs
# only, no two punctuation marks in a row, and no blank, stop or comma after a
# blank.
_MARKS = r"""!,\-:;?"'()."""
_ODD = [re.compile(f"[^0-9A-Za-zÀ-ÖØ-öø-ɏ \\n{_MARKS}]"),
        re.compile(f"[{_MARKS}][{_MARKS}]"),
        re.compile(r"[ \n][ \n.,]")]
_RUNS = re.compile(f" ?[^{_WHITE}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+")
_PART = 1 << 20
_GROUP = 3 << 20
# Byte-level vocabularies write each byte as one printable sign: itself where
# it prints, else the next free sign from 256 on.
_PRINTS = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE_SIGN = [chr(b) if b in _PRINTS else chr(256 + sum(x not in _PRINTS for x in range(b))) for b in range(256)]


class ChunkEncoder:
    """``encode(text)`` gives the ids that ``tokenizers`` gives for the text
    (``add_special_tokens=False``) as an int32 array; ``encode_all`` does so
    for many texts."""

    def __init__(self, path: str, cache: int = 300_000):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.merges = self.tok.model
        self.limit = cache
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        # a byte-level vocabulary keeps blanks; the lower-casing one drops them
        self.keeps_blanks = self.tok.normalizer is None
        self.sep = "\x1f" if self.keeps_blanks else " "
        self._clear()

    def _clear(self) -> None:
        self.at: dict[str, int] = {}
        self.ids = np.empty(1 << 16, np.int32)
        self.first = np.zeros(1 << 14, np.int64)
        self.size = np.zeros(1 << 14, np.int32)
        self.used = 0

    def _separated(self, text: str) -> str:
        """The text with ``sep`` between its chunks."""
        if self.keeps_blanks:
            if any(odd.search(text) for odd in _ODD):
                return self.sep.join(_RUNS.findall(text))
            return (text.replace(" ", "\x1f ").replace(".", "\x1f.").replace(",", "\x1f,")
                    .replace("\n", "\x1f\n\x1f"))
        low = text.lower()
        if "Σ" in text or not (unicodedata.is_normalized("NFC", text) and unicodedata.is_normalized("NFC", low)):
            return text
        # the vocabulary lower-cases; doing it first merges chunks
        if any(odd.search(low) for odd in _ODD):
            return low
        return low.replace(".", " .").replace(",", " ,").replace("\n", " ")

    def _ids(self, new: list[str]) -> list[list[int]]:
        """Ids of chunks.  One word is one pre-token and goes straight to the
        vocabulary's merges; the rest takes the whole way."""
        got: list = [None] * len(new)
        rest, tokenize = [], self.merges.tokenize
        for k, c in enumerate(new):
            if self.keeps_blanks:
                plain = (c[1:] if c[:1] == " " else c).isalpha()
            else:
                plain = c.isalpha() and c.islower() and unicodedata.is_normalized("NFC", c)
            if plain:
                if c.isascii():  # letters stand for themselves, a blank before them does not
                    signs = _BYTE_SIGN[32] + c[1:] if c[0] == " " else c
                else:
                    signs = c.encode().decode("latin-1").translate(_BYTE_SIGN)
                got[k] = [t.id for t in tokenize(signs)]
            else:
                rest.append(k)
        if rest:
            for k, e in zip(rest, self.tok.encode_batch_fast([new[k] for k in rest], add_special_tokens=False)):
                got[k] = e.ids
        return got

    def _learn(self, new: list[str]) -> None:
        """Append the ids of chunks that are not known yet."""
        got = self._ids(new)
        n0, n1 = len(self.at), len(self.at) + len(new)
        size = np.fromiter(map(len, got), np.int32, len(got))
        total = int(size.sum())
        while n1 > len(self.first):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        self.ids[self.used:self.used + total] = np.fromiter(chain.from_iterable(got), np.int32, total)
        self.size[n0:n1] = size
        self.first[n0:n1] = self.used + np.cumsum(size) - size
        self.used += total
        self.at.update(zip(new, range(n0, n1)))

    def _places(self, chunks: list[str]) -> np.ndarray:
        """The place of each of the distinct chunks among those known."""
        index = np.fromiter(map(self.at.get, chunks, repeat(-1)), np.int64, len(chunks))
        new = np.flatnonzero(index < 0)
        if len(new) and len(self.at) + len(new) > self.limit:
            self._clear()
            new = np.arange(len(chunks))
        if len(new):
            index[new] = np.arange(len(self.at), len(self.at) + len(new))
            self._learn([chunks[i] for i in new.tolist()])
        return index

    def _group(self, texts: list[str]) -> list[np.ndarray]:
        out: list[list[np.ndarray]] = [[] for _ in texts]
        cut, owner = [], []
        for i, t in enumerate(texts):
            low = t if self.keeps_blanks else t.lower()  # chunks are lower-cased, which may make a special string
            if any(s in t or s in low for s in self.special) or (self.keeps_blanks and self.sep in t):
                out[i].append(np.array(self.tok.encode(t, add_special_tokens=False).ids, np.int32))
            elif t:
                for p in parts(t, _PART):
                    cut.append(self._separated(p))
                    owner.append(i)
        if cut:
            lists = pc.split_pattern(pa.array(cut, pa.large_string()), self.sep)
            chunks = lists.flatten().dictionary_encode()
            k = self._places(chunks.dictionary.to_numpy(zero_copy_only=False).tolist())[chunks.indices.to_numpy()]
            size = self.size[k]
            ends = np.cumsum(size, dtype=np.int64)
            shift = (self.first[k] - ends + size).astype(np.int32)  # a group and the cache are far below 2^31 ids
            ids = self.ids[np.repeat(shift, size) + np.arange(int(ends[-1]), dtype=np.int32)]
            border = np.concatenate([[0], ends])[lists.offsets.to_numpy()].tolist()
            for j, i in enumerate(owner):
                out[i].append(ids[border[j]:border[j + 1]])
        return [x[0] if len(x) == 1 else np.concatenate(x) if x else np.empty(0, np.int32) for x in out]

    def encode_all(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of each text, in order; chunks are looked up once for a
        group of texts."""
        group, size = [], 0
        for t in texts:
            group.append(t)
            size += len(t)
            if size >= _GROUP:
                yield from self._group(group)
                group, size = [], 0
        if group:
            yield from self._group(group)

    def encode(self, text: str) -> np.ndarray:
        return next(self.encode_all([text]))


@lru_cache(maxsize=1)
def _loaded(path: str, cache: int) -> ChunkEncoder:
    return ChunkEncoder(path, cache)


def encoder(path: str, cache: int = 300_000) -> ChunkEncoder:
    """The process's encoder; ``cache`` bounds its chunks (about 250 bytes
    each)."""
    claim("encoder", _loaded.cache_clear)
    return _loaded(path, cache)
