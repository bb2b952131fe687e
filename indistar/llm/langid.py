"""Language identification with hyperdimensional profiles.

Every letter (code point, lower case) of any script has a random +-1 vector of
its own, made from a hash of the code point.  A letter n-gram binds its letters'
vectors, each permuted by its place, with the element-wise product; a document
bundles (adds up) its n-gram vectors, a language the documents labelled with
it.  A document's language is the prototype with the highest cosine.  Training
adds up one vector per language and task before the shuffle; prediction is a
narrow pass with a few prototypes in the closure.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indistar.llm.common import claim, map_texts, utf8

DIMS = 1024
ORDER = 3
BITS = 21  # of a code point; an n-gram is one 64-bit code
GAP = 0  # between words
MAX_LANGUAGES = 1000
_CHARS = 1 << 18
_BOUND = 2048  # n-gram vectors at once
UNDETERMINED = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Lower-case letter of each code point; GAP where it is no letter."""
    out = np.full(0x110000, GAP, np.uint32)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()
            out[cp] = ord(low) if len(low) == 1 else cp
    return out


def letter_vectors(letters: np.ndarray, dims: int = DIMS) -> np.ndarray:
    """A row of +-1 for each code point, from the bits of a 64-bit hash."""
    words = -(-dims // 64)
    h = (letters.astype(np.uint64)[:, None] * np.uint64(words) + np.arange(1, words + 1, dtype=np.uint64)) \
        * np.uint64(0x9E3779B97F4A7C15)  # splitmix64
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return np.unpackbits(h.astype("<u8").view(np.uint8), axis=1)[:, :dims].astype(np.int8) * 2 - 1


def ngrams(text: str, order: int = ORDER) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct letter n-grams of a text with counts, and the number of
    letters.  Runs of other signs count as one gap; n-grams that are mostly
    gap are left out by the single gap."""
    if order * BITS > 63:
        raise ValueError("n-grams of 3 letters at most")
    keys, counts, n = [], [], 0
    for a in range(0, len(text), _CHARS):
        part = np.frombuffer(text[max(0, a - order + 1):a + _CHARS].encode("utf-32-le", "surrogatepass"), np.uint32)
        s = _letters()[part]
        letters = s != GAP
        n += int(letters.sum())
        keep = letters.copy()
        keep[1:] |= letters[:-1]
        s = np.concatenate([[GAP], s[keep], [GAP]]).astype(np.int64)
        code = np.zeros(max(0, len(s) - order + 1), np.int64)
        for k in range(order):
            code = code << BITS | s[k:len(s) - order + 1 + k]
        k, c = np.unique(code, return_counts=True)
        keys.append(k)
        counts.append(c)
    if len(keys) == 1:
        return keys[0], counts[0], n
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int64), 0
    k, at = np.unique(np.concatenate(keys), return_inverse=True)
    return k, np.bincount(at, np.concatenate(counts)).astype(np.int64), n


def bind(codes: np.ndarray, dims: int = DIMS, order: int = ORDER) -> np.ndarray:
    """One vector per n-gram: the product of its letters' vectors, rolled by
    one step for each place further left."""
    places = [codes >> (BITS * (order - 1 - k)) & ((1 << BITS) - 1) for k in range(order)]
    letters, at = np.unique(np.concatenate(places), return_inverse=True)
    base, at = letter_vectors(letters, dims), at.reshape(order, -1)
    out = base[at[order - 1]]
    for k in range(order - 1):
        out *= np.roll(base, order - 1 - k, axis=1)[at[k]]
    return out


def bundle(texts: list[str], dims: int = DIMS, order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """A vector per text and its number of letters."""
    out, letters = np.zeros((len(texts), dims), np.float32), np.zeros(len(texts), np.int64)
    for a in range(0, len(texts), 32):
        got = [ngrams(t, order) for t in texts[a:a + 32]]
        letters[a:a + 32] = [g[2] for g in got]
        keys, at = np.unique(np.concatenate([g[0] for g in got]), return_inverse=True)
        if not len(keys):
            continue
        weight = np.zeros((len(got), len(keys)), np.float32)
        weight[np.repeat(np.arange(len(got)), [len(g[0]) for g in got]), at] = np.concatenate([g[1] for g in got])
        for z in range(0, len(keys), _BOUND):
            out[a:a + 32] += weight[:, z:z + _BOUND] @ bind(keys[z:z + _BOUND], dims, order).astype(np.float32)
    return out, letters


def _parts(texts: pa.Array, size: int = 2 << 20) -> Iterator[tuple[int, list[str]]]:
    """Runs of a column of UTF-8 texts with about ``size`` bytes each, and
    where they start; null texts are empty."""
    start, total, texts = 0, 0, texts.cast(pa.binary())
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        total += n
        if total >= size or i - start >= 2047 or i + 1 == len(texts):
            yield start, [x.as_py().decode("utf-8", "replace") if x.is_valid else "" for x in texts.slice(start, i + 1 - start)]
            start, total = i + 1, 0


def train_prototypes(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", dims: int = DIMS,
                     order: int = ORDER, max_languages: int = MAX_LANGUAGES) -> dict[str, np.ndarray]:
    """Prototype per language over all labelled rows.  Each document's bundle
    is scaled to unit length before it is added.  Only one vector per language
    reaches the driver; more than ``max_languages`` languages are an error."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("language")
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for at, texts in _parts(b.column(1)):
                vectors, letters = bundle(texts, dims, order)
                vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
                langs = np.array(b.column(0).slice(at, len(texts)).to_pylist(), object)
                for lang in set(langs[letters > 0].tolist()):
                    sums[lang] = sums.get(lang, 0) + vectors[langs == lang].sum(axis=0, dtype=np.float64)
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))],
                names=["lang", "v"])

    rows = labelled.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"),
                                                             utf8(text_col).alias("text"))
    sums = map_texts(rows, run, "lang string, v array<double>")
    # rounded to whole units so that the order of addition cannot matter
    total = sums.select("lang", F.posexplode("v").alias("at", "x")) \
        .groupBy("lang", "at").agg(F.sum(F.round(F.col("x") * 1e6).cast("long")).alias("x"))
    rows = total.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "x"))).alias("v")) \
        .limit(max_languages + 1).collect()
    if len(rows) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    return {r["lang"]: np.array([x["x"] for x in r["v"]], np.float64) for r in sorted(rows, key=lambda r: r["lang"])}


def predict_languages(docs: DataFrame, prototypes: dict[str, np.ndarray], text_col: str = "text", dims: int = DIMS,
                      order: int = ORDER) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (cosine, at least 0) added;
    ``und`` and 0 for a null text, one without a letter, or no prototypes."""
    names = sorted(prototypes)
    matrix = np.stack([prototypes[n] / max(np.linalg.norm(prototypes[n]), 1e-9) for n in names]).astype(np.float32) \
        if names else np.zeros((0, dims), np.float32)
    columns = docs.columns
    rows = docs.select(F.struct(*columns).alias("row"))
    place = columns.index(text_col)  # the text travels once, inside its row
    schema = f"row {rows.schema['row'].dataType.simpleString()}, lang_pred string, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("language")
        for b in batches:
            for at, texts in _parts(b.column(0).field(place).cast(pa.string())):
                vectors, letters = bundle(texts, dims, order)
                lang, score = [UNDETERMINED] * len(texts), np.zeros(len(texts))
                if names:
                    cosine = vectors @ matrix.T / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
                    best = cosine.argmax(axis=1)
                    score = np.where(letters > 0, np.clip(cosine[np.arange(len(best)), best], 0.0, 1.0), 0.0)
                    lang = [names[k] if n else UNDETERMINED for k, n in zip(best.tolist(), letters.tolist())]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(texts)), pa.array(lang, pa.string()),
                                                  pa.array(score.astype(np.float64))],
                                                 names=["row", "lang_pred", "score"])

    return map_texts(rows, run, schema).select("row.*", "lang_pred", "score")


def held_out(id_col: str = "doc_id") -> Column:
    """One document in three, by the checksum of its id as text."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                       **options) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``.

    Prototypes come from the documents that are not held out and have a
    language.  Null or letterless texts are ``und`` with score 0; a null id is
    not held out; repeated rows are predicted each; an empty table gives an
    empty result.
    """
    prototypes = train_prototypes(docs.where(~held_out(id_col)), lang_col, text_col, **options)
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return predict_languages(rows, prototypes, "text", **options).drop("text")
