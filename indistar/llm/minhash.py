"""Near-duplicates from bottom-k sketches of one hash function.

1. Each document's distinct word shingles are hashed once; the k smallest
   hashes are its sketch.  Rows with equal shingle sets form one class, named
   by a row number; the search knows classes only, never document ids.
2. Inverted lists of retained values.  A pair with similarity 0.75 shares a
   known least number of retained values, so each document enters only the
   lists of its rarest values (rare first, in one global order): values that
   very many documents share are left to the documents that have little else.
3. Every list first pairs its members with its smallest one only, a crowded
   list then with a few drawn members.  Confirmed links join whole groups of
   near copies without all their pairs.  The remaining pairs are made between
   different components only: from the lists, or, for documents of crowded
   lists, from inverted lists over their full sets, where the size and place
   bounds are exact and leave the documents out that are near nobody.
4. A union-sketch estimate filters pairs, the Jaccard coefficient on the full
   shingle sets decides.
5. Classes that share a document id are linked, and the components of classes
   are mapped back to the rows.

The least number of shared values is a lower bound of a hypergeometric count
with ``Z`` standard deviations to spare (below 1e-7 for a pair to fall short).  A
union of at most k shingles is retained whole: sets no larger than 0.75 k have
the exact bound, larger ones up to k the smaller of both.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indistar.llm.common import claim, map_texts, materialise, utf8
from indistar.llm.components import components, near_labels

K = 64
Z = 5.5
WORDS = 5
SIMILARITY = 75  # per cent
BROADCAST_TEXTS = 500_000  # the same for ids with the checksum of their text
PIVOTS = 4  # drawn members of a crowded list that the others are compared with
TURNS = 2  # times that members are drawn
CROWDED = 8  # pairs for each row from which a list is crowded
SIGNS = 8  # longs of a document's parity bits
ALL, LONE = -1, -2  # parts of a list that are no component
_CACHE = 200_000
_words: dict[bytes, int] = {}


def shingle_set(raw: bytes | None, size: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles."""
    words = raw.lower().split() if raw else []
    if not words:
        return np.empty(0, np.uint64)
    got = list(map(_words.get, words))
    if None in got:
        if len(_words) > _CACHE:
            _words.clear()
        for i, g in enumerate(got):
            if g is None:
                got[i] = _words[words[i]] = xxhash.xxh3_64_intdigest(words[i])
    h = np.array(got, np.uint64)
    width = min(size, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for j in range(width):
        out = (out ^ h[j:len(h) - width + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return np.unique(out)


def least_shared(n: Column, k: int = K, per_cent: int = SIMILARITY) -> Column:
    """Retained values that a set of n shingles shares at least with any set
    of the given similarity.  A union of at most k shingles is retained whole
    and the pair shares ``per_cent`` of n; a larger one, possible where n is
    over ``per_cent`` of k, is drawn from."""
    p = per_cent / 100
    most = n / F.lit(p)
    spread = F.sqrt(F.lit(k * p * (1 - p)) * (most - k) / (most - 1))
    whole = F.ceil(n * F.lit(per_cent) / 100)
    drawn = F.greatest(F.floor(F.lit(k * p) - F.lit(Z) * spread), F.lit(1))
    return F.when(n <= int(k * p), whole).when(n <= k, F.least(whole, drawn)).otherwise(drawn).cast("int")


def _rows(docs: DataFrame, id_col: str, text_col: str, tag: Column) -> DataFrame:
    """``doc, tag, h, text``: ``h`` is a 128-bit hash of the text."""
    return docs.select(F.col(id_col).cast("long").alias("doc"), tag.cast("long").alias("tag"), utf8(text_col).alias("text")) \
        .select("doc", "tag", F.unhex(F.md5("text")).alias("h"), "text")


def sketches(rows: DataFrame, size: int = WORDS, k: int = K) -> DataFrame:
    """``row, doc, tag, h, n, key, sketch``: a row number, set size, 128-bit
    hash of the set, k least."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("shingles", _words.clear)
        for b in batches:
            n, key, sketch = [], [], []
            for raw in b.column(4):
                s = shingle_set(raw.as_py(), size)
                n.append(len(s))
                key.append(xxhash.xxh3_128_digest(s.tobytes()))
                sketch.append((s[:k] ^ np.uint64(1 << 63)).view(np.int64))  # signed, same order
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:4], pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(sketch, pa.list_(pa.int64()))],
                names=["row", "doc", "tag", "h", "n", "key", "sketch"])

    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "doc", "tag", "h", "text")
    return map_texts(numbered, run, "row long, doc long, tag long, h binary, n long, key binary, sketch array<long>")


def _posting_lists(classes: DataFrame, k: int) -> DataFrame:
    """``value, id, n`` for the rarest values of each class that others have
    too."""
    postings = classes.select("id", "n", F.explode("sketch").alias("value"))
    shared = postings.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    # values of one document only are rarest: they need no place in the table
    return postings.join(shared, "value").groupBy("id").agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "value"))).alias("v")) \
        .withColumn("own", F.least(F.col("n"), F.lit(k)) - F.size("v")) \
        .withColumn("room", (F.least(F.col("n"), F.lit(k)) - least_shared(F.col("n"), k) + 1 - F.col("own")).cast("int")) \
        .where("room > 0").select("id", "n", F.explode(F.slice("v", F.lit(1), F.col("room"))).alias("x")) \
        .select(F.col("x.value").alias("value"), "id", "n")


def _similar_sizes(a: str, b: str, per_cent: int) -> Column:
    return (F.least(a, b) * 100 >= F.greatest(a, b) * per_cent)


def _estimated(pairs: DataFrame, classes: DataFrame, k: int, per_cent: int) -> DataFrame:
    """Pairs whose union sketch (the k least values of both) holds enough
    common values; exact where both sketches are whole sets."""
    left = classes.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    right = classes.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    both = pairs.join(left, "a").join(right, "b").where(_similar_sizes("na", "nb", per_cent)).select(
        "a", "b", "na", "nb", F.least(least_shared(F.col("na"), k, per_cent),
                                      least_shared(F.col("nb"), k, per_cent)).cast("long").alias("need"), "sa", "sb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            na, nb, need = (b.column(i).to_numpy() for i in (2, 3, 4))
            values, row = [], []
            for i in (5, 6):
                lists = b.column(i)
                values.append(lists.flatten().to_numpy())
                row.append(np.repeat(np.arange(b.num_rows), lists.value_lengths().to_numpy()))
            values, row = np.concatenate(values), np.concatenate(row)
            order = np.lexsort((values, row))
            values, row = values[order], row[order]
            twin = np.zeros(len(values), bool)
            twin[1:] = (values[1:] == values[:-1]) & (row[1:] == row[:-1])
            nth = np.cumsum(~twin)
            first = np.searchsorted(row, np.arange(b.num_rows))
            nth = nth - nth[first][row] + 1  # the place in the union sketch, from 1
            common = np.bincount(row, twin, b.num_rows)
            inside = np.bincount(row, twin & (nth <= k), b.num_rows)
            whole = (na <= k) & (nb <= k)
            ok = np.where(whole, common * (100 + per_cent) >= (na + nb) * per_cent, inside >= need)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(ok))

    return both.mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame, size: int, per_cent: int) -> DataFrame:
    """Pairs with ``100 * intersection >= per_cent * union`` on full sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("shingles", _words.clear)
        last: tuple = (None, None)
        for b in batches:
            ok = []
            for x, y in zip(b.column(2), b.column(3)):
                x = x.as_py()
                if x != last[0]:
                    last = (x, shingle_set(x, size))
                other = shingle_set(y.as_py(), size)
                both = len(np.intersect1d(last[1], other, assume_unique=True))
                ok.append(bool(both) and 100 * both >= per_cent * (len(last[1]) + len(other) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    a, b = (texts.select(F.col("id").alias(c), F.col("text").alias(f"t{c}")) for c in "ab")
    return map_texts(pairs.join(b, "b").join(a, "a").select("a", "b", "ta", "tb"), run, "a long, b long").distinct()


def _ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def near_links(rows: DataFrame, size: int = WORDS, k: int = K, per_cent: int = SIMILARITY) \
        -> tuple[DataFrame, DataFrame, DataFrame]:
    """``sketches`` of the ``_rows``; ``id, row, doc, tag, h, n`` of the rows
    with shingles, ``id`` the class; and links ``a, b`` of classes whose
    components are those of all similar pairs."""
    drawn = materialise(sketches(rows, size, k), "sketches")
    some = drawn.where("n > 0")
    classes = some.groupBy("key").agg(F.min(F.struct("row", "doc", "h")).alias("r"), F.first("n").alias("n"),
                                      F.first("sketch").alias("sketch"))
    classes = materialise(classes.select(F.col("r.row").alias("id"), "r.doc", "r.h", "key", "n", "sketch"), "classes")
    members = materialise(some.select("key", "row", "doc", "tag", "h", "n").join(classes.select("key", "id"), "key")
                          .drop("key"), "members")
    shown, classes = classes.select("id", "doc", "h"), classes.select("id", "n", "sketch")
    lists = materialise(_posting_lists(classes, k), "lists")

    first = lists.groupBy("value").agg(F.min(F.struct("id", "n")).alias("p"))
    stars = lists.join(first, "value").where(
        (F.col("id") != F.col("p.id")) & _similar_sizes("n", "p.n", per_cent)) \
        .select(*_ordered("id", "p.id")).distinct()
    stars = materialise(_estimated(stars, classes, k, per_cent), "stars")

    ids = lists.join(lists.groupBy("value").count().where("count > 1"), "value", "left_semi").select("id").distinct()
    ids = materialise(shown.join(ids, "id", "left_semi").select("id", F.col("doc").alias("d"), F.col("h").alias("g")), "ids")
    few = ids.count() <= BROADCAST_TEXTS
    texts = rows.select("doc", "h", "text").join(
        F.broadcast(ids) if few else ids, (F.col("h") == F.col("g")) & F.col("doc").eqNullSafe(F.col("d")))
    # rows that repeat an id and its text, or null and a text, give one
    texts = materialise(texts.groupBy("id").agg(F.first("text").alias("text")), "texts")

    links = materialise(_verified(stars, texts, size, per_cent), "links")
    at = materialise(_mixed(lists, near_labels(links, 1)), "lists")
    crowded = materialise(_crowded(at), "crowded")
    tested = stars
    if not crowded.isEmpty():
        for turn in range(TURNS):
            pairs = materialise(_estimated(_pivot_pairs(at.join(crowded, "value", "left_semi"), per_cent, turn).join(
                tested, ["a", "b"], "left_anti"), classes, k, per_cent), "pairs")
            tested = tested.union(pairs)
            links = links.union(_verified(pairs, texts, size, per_cent))
            # whole components: what is connected already is not paired again
            labels = components(links)
            links = labels.where("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b"))
            at = materialise(_mixed(lists, labels), "lists")
        ids = materialise(at.join(crowded, "value", "left_semi").select("id").distinct(), "ids")
        full = materialise(_mixed(_full_lists(ids, texts, size, per_cent), labels), "full").join(_parities(ids, texts, size), "id")
        rest = _cross_pairs(at.join(crowded, "value", "left_anti"), per_cent).union(_full_pairs(full, per_cent)).distinct()
    else:
        rest = _cross_pairs(at, per_cent)
    rest = materialise(_estimated(rest.join(tested, ["a", "b"], "left_anti"), classes, k, per_cent), "rest")
    return drawn, members, materialise(links.union(_verified(rest, texts, size, per_cent)), "links")


def _mixed(lists: DataFrame, found: DataFrame) -> DataFrame:
    """The lists that hold several known components, with the component ``c``
    and ``lone`` where no link of the document is known."""
    at = lists.join(found.withColumnRenamed("node", "id"), "id", "left").withColumn("lone", F.col("component").isNull()) \
        .withColumn("c", F.coalesce("component", "id")).drop("component")
    several = at.groupBy("value").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi")
    return at.join(several.select("value"), "value", "left_semi")


def _crowded(at: DataFrame) -> DataFrame:
    """``value`` of the lists whose pairs across components outnumber their
    rows by far."""
    by = at.groupBy("value", "c").agg(F.count(F.lit(1)).cast("double").alias("m")).groupBy("value").agg(
        F.sum("m").alias("m"), F.sum(F.col("m") * F.col("m")).alias("own"))
    return by.where((F.col("m") * F.col("m") - F.col("own")) / 2 > CROWDED * F.col("m")).select("value")


def _pivot_pairs(at: DataFrame, per_cent: int, turn: int = 0) -> DataFrame:
    """Each list's members with a few drawn ones, others in each turn."""
    order = F.struct(F.xxhash64("id", F.lit(-turn)).alias("h"), "id", "n", "c")
    few = at.groupBy("value").agg(F.array_compact(F.array(*[
        F.min(F.when(F.pmod(F.xxhash64("id", F.lit(turn + 1)), F.lit(PIVOTS)) == i, order)) for i in range(PIVOTS)])).alias("p"))
    # many lists draw the same members: one row for each place in a list, each pair of documents once
    met = at.join(few, "value").groupBy("id", "n", "c").agg(F.array_distinct(F.flatten(F.collect_set("p"))).alias("p"))
    return met.select("id", "n", "c", F.explode("p").alias("p")) \
        .where((F.col("c") != F.col("p.c")) & _similar_sizes("n", "p.n", per_cent)) \
        .select(*_ordered("id", "p.id")).distinct()


def _cross_pairs(at: DataFrame, per_cent: int) -> DataFrame:
    """All pairs of a list from different components."""
    groups = at.select("value", "c").distinct()
    across = groups.join(groups.withColumnRenamed("c", "d"), "value").where("c < d")
    return across.join(at.select("value", "c", F.col("id").alias("x"), F.col("n").alias("nx")), ["value", "c"]) \
        .join(at.select("value", F.col("c").alias("d"), F.col("id").alias("y"), F.col("n").alias("ny")), ["value", "d"]) \
        .where(_similar_sizes("nx", "ny", per_cent)).select(*_ordered("x", "y")).distinct()


def _full_lists(ids: DataFrame, texts: DataFrame, size: int, per_cent: int) -> DataFrame:
    """Inverted lists over the full sets of the documents of crowded lists:
    ``value, id, n, most``.  The rarest quarter of a set is indexed; ``most``
    is the largest partner that can still be similar if this value, at its
    place in the rare-first order, is the first one that both have."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("shingles", _words.clear)
        for b in batches:
            sets = [(shingle_set(raw.as_py(), size) ^ np.uint64(1 << 63)).view(np.int64) for raw in b.column(1)]
            for i in range(0, len(sets), 500):  # bounded batches of long lists
                part = sets[i:i + 500]
                lengths = [len(s) for s in part]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, 500).take(pa.array(np.repeat(np.arange(len(part)), lengths))),
                     pa.array(np.repeat(lengths, lengths), pa.int64()),
                     pa.array(np.concatenate(part) if part else np.empty(0, np.int64))], names=["id", "n", "value"])

    rows = map_texts(texts.join(ids, "id", "left_semi").select("id", "text"), run, "id long, n long, value long")
    shared = rows.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    return rows.join(shared, "value").groupBy("id").agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "value"))).alias("v")) \
        .withColumn("own", F.col("n") - F.size("v")) \
        .withColumn("room", (F.col("n") - F.ceil(F.col("n") * per_cent / 100) + 1 - F.col("own")).cast("int")) \
        .where("room > 0").select("id", "n", "own", F.posexplode(F.slice("v", F.lit(1), F.col("room"))).alias("i", "x")) \
        .select(F.col("x.value").alias("value"), "id", "n", (F.floor(
            (F.col("n") - F.col("own") - F.col("i")) * (100 + per_cent) / per_cent) - F.col("n")).alias("most"))


def _parities(ids: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """``id, s0, s1, ...``: bits that say whether an odd number of the full
    set's values fall on them.  Where two documents' bits differ, at least one
    value is in one set only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("shingles", _words.clear)
        for b in batches:
            bits = np.zeros((b.num_rows, SIGNS), np.uint64)
            for i, raw in enumerate(b.column(1)):
                odd = np.bincount((shingle_set(raw.as_py(), size) % np.uint64(64 * SIGNS)).astype(np.int64),
                                  minlength=64 * SIGNS) % 2
                bits[i] = np.packbits(odd.astype(np.uint8)).view(np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(bits[:, j].view(np.int64)) for j in range(SIGNS))],
                                             names=["id", *(f"s{j}" for j in range(SIGNS))])

    return map_texts(texts.join(ids, "id", "left_semi").select("id", "text"), run,
                     ", ".join(["id long", *(f"s{j} long" for j in range(SIGNS))]))


def _full_pairs(at: DataFrame, per_cent: int) -> DataFrame:
    """Pairs of different components that can be similar by size, place and
    parity bits.  The larger document looks for the smaller one in classes of
    sizes, so documents that are too far from all others meet nobody."""
    def grade(n) -> Column:
        return F.floor(F.log(F.greatest(n, F.lit(1))) / F.lit(float(np.log(1.05))))

    least = F.ceil(F.col("n") * per_cent / 100)
    top = F.least("n", "most")
    bits = [f"s{j}" for j in range(SIGNS)]
    apart = sum((F.bit_count(F.col(f"x{b}").bitwiseXOR(F.col(f"y{b}"))) for b in bits), F.lit(0))
    seek = at.where(top >= least).select("value", "c", "lone", F.col("id").alias("x"), F.col("n").alias("nx"),
                                         F.col("most").alias("mx"), *(F.col(b).alias(f"x{b}") for b in bits),
                                         F.explode(F.sequence(grade(least), grade(top))).alias("g"))
    stand = at.where("most >= n").select("value", F.col("c").alias("d"), "lone", F.col("id").alias("y"),
                                         F.col("n").alias("ny"), F.col("most").alias("my"),
                                         *(F.col(b).alias(f"y{b}") for b in bits), grade(F.col("n")).alias("g"))
    # ``part``: a lone document meets all of a list (ALL), a linked one the lone ones (LONE) and every other component
    linked = seek.where("NOT lone").select("value", "g", "c").distinct().join(
        stand.where("NOT lone").select("value", "g", "d").distinct(), ["value", "g"]).where("c <> d") \
        .select("value", "g", "c", F.col("d").alias("part"))
    linked = seek.join(linked, ["value", "g", "c"]).where("NOT lone").select(*seek.columns, "part")
    seek = seek.withColumn("part", F.when(F.col("lone"), ALL).otherwise(LONE).cast("long")).union(linked).drop("lone")
    stand = stand.withColumn("part", F.explode(F.array(F.lit(ALL).cast("long"), F.when(F.col("lone"), LONE).otherwise(F.col("d"))))) \
        .drop("lone")
    return seek.join(stand, ["value", "g", "part"]) \
        .where((F.col("c") != F.col("d")) & (F.col("ny") <= F.col("nx")) & (F.col("ny") <= F.col("mx"))
               & (F.col("nx") <= F.col("my")) & _similar_sizes("nx", "ny", per_cent)
               # the values of one set only are at most this part of both sizes
               & (apart * (100 + per_cent) <= (F.col("nx") + F.col("ny")) * (100 - per_cent))) \
        .select(*_ordered("x", "y")).distinct()


def _groups(rows: DataFrame, **options) -> DataFrame:
    """``doc, tag, n, component, kept`` of the ``_rows``."""
    drawn, members, links = near_links(rows, **options)
    # classes that share an id
    each = members.where("doc is not null").select("doc", "id")
    several = each.groupBy("doc").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo <> hi")
    links = links.union(each.join(several, "doc").where("id <> lo").select("id", "lo").distinct())
    found = components(links).withColumnRenamed("node", "id")
    placed = materialise(members.join(found, "id", "left").withColumn("c", F.coalesce("component", "id"))
                         .select("c", "row", "doc", "tag", "h", "n"), "placed")
    groups = placed.groupBy("c").agg(F.min("doc").alias("low"), F.min(
        F.when(F.col("doc").isNull(), F.struct("h", "row"))).alias("head"))
    shown = placed.join(groups.select("c", "low", F.col("head.row").alias("head")), "c").select(
        "doc", "tag", "n", F.when(F.col("head").isNull(), F.col("low")).alias("component"),
        F.when(F.col("head").isNull(), F.col("doc") == F.col("low")).otherwise(
            F.col("doc").isNull() & (F.col("row") == F.col("head"))).alias("kept"))

    # rows without a shingle go with the other rows of their id
    bare = drawn.where("n = 0").select("doc", "tag", "n")
    named = bare.where("doc is not null")
    known = shown.join(named.select("doc").distinct(), "doc", "left_semi").groupBy("doc").agg(
        F.first("component").alias("component"), F.first("kept").alias("known"))
    named = named.join(known, "doc", "left").select(
        "doc", "tag", "n", F.when(F.col("known").isNull(), F.col("doc")).otherwise(F.col("component")).alias("component"),
        F.coalesce("known", F.lit(True)).alias("kept"))
    alone = bare.where("doc is null").select("doc", "tag", "n", F.col("doc").alias("component"), F.lit(True).alias("kept"))
    return shown.union(named).union(alone)


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS, k: int = K,
                per_cent: int = SIMILARITY) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Words are runs of non-blank signs after lower-casing A-Z; a text with
    fewer words than a shingle has one shingle, a null or blank one has none
    and is linked with nothing.  Rows that repeat an id are one record and
    linked with whatever one of them links.  Each row with a null id is a
    record of its own; null counts as the smallest id, so it names the
    component, and one of the component's null-id rows is kept (the least MD5
    of the text; any of equal texts).  Other columns are not read; an empty
    table gives an empty result.
    """
    out = _groups(_rows(docs, id_col, text_col, F.lit(None)), size=size, k=k, per_cent=per_cent)
    return out.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"),
                      F.col("component").alias("component_id"), "kept")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that ``near_groups`` doesn't keep; all columns
    stay, whatever their names.  Null and blank texts are near nobody and stay,
    each row with a null id is a record of its own, long texts are compared
    whole, an empty table stays empty."""
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"), F.struct(*docs.columns).alias("row"))
    named = rows.where(F.col("doc").isNotNull())
    # rows without an id are told apart by a number that stays
    anon = materialise(rows.where(F.col("doc").isNull()).withColumn("tag", F.monotonically_increasing_id()), "anon")
    every = _rows(named, "doc", "text", F.lit(None)).union(_rows(anon, "doc", "text", F.col("tag")))
    gone = _groups(every, **options).where(~F.col("kept")).select(F.col("doc").alias("gone_doc"), F.col("tag").alias("gone_tag"))
    gone = materialise(gone.distinct(), "gone")  # its size on disk lets the planner choose the join
    return named.join(gone, F.col("doc") == F.col("gone_doc"), "left_anti").select("row.*").union(
        anon.join(gone, F.col("tag") == F.col("gone_tag"), "left_anti").select("row.*"))
