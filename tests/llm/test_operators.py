"""Each operator against brute force on small tables with nulls, empty and
long texts, ties, repeated rows, empty tables and clashing columns."""

import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest

from indistar.llm import minhash
from indistar.llm.components import components
from indistar.llm.decontaminate import ItemAutomaton, contamination, drop_contaminated, words_of
from indistar.llm.exact_dedup import drop_exact_copies, exact_groups
from indistar.llm.langid import identify_languages
from indistar.llm.packing import pack_documents
from indistar.llm.repeats import remove_repeats, repeated_starts
from indistar.llm.sharding import shard_records
from indistar.llm.token_count import token_counts
from indistar.llm.toxicity import toxicity
from indistar.llm.wavelet import StoredPlane, WaveletMatrix, open_file, pack_file, token_files

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h long, norm string, sketch string"
ODD = [None, "", "a", "A", " ", "  two  blanks ", "\n\t", "x<|endoftext|> y  <|startoftext|>", "É ẗ İ Σ中文 😀 ▁ ▁x",
       "one two three four five", "ONE two three four five", "it's a.b, c!! d_e\x1d f\x00"]


def corpus(seed: int, n: int = 60) -> list[tuple]:
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeéß") for _ in range(r.randrange(1, 7))) for _ in range(60)]
    texts = list(ODD) + [" ".join(r.choice(words) for _ in range(r.randrange(1, 120))) for _ in range(n)]
    texts += [texts[20], texts[20], texts[21].upper(), texts[22] + " tail", "long " * 3000 + "end", "q" * 3000]
    for _ in range(10):
        w = texts[r.randrange(len(ODD), len(texts) - 6)].split()
        w[r.randrange(len(w))] = "changed"
        texts.append(" ".join(w))
    rows = [(i, t, r.choice(["aa", "bb", None]), "s", 0, 1, "n", "k") for i, t in enumerate(texts)]
    return [*rows, rows[25], (None, "null id " * 30, "aa", "s", 0, 1, "n", "k"), (None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(1), SCHEMA).repartition(3, "doc_id").cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def key(r):
    return tuple((x is None, str(x)) for x in r)


def same(df, want):
    assert sorted((tuple(r) for r in df.collect()), key=key) == sorted(want, key=key)


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def test_repeated_starts_against_counting():
    r = random.Random(3)
    for _ in range(40):
        size = r.choice((16, 40))
        parts = [bytes(r.choice(b"ab\0") for _ in range(r.randrange(size, 4 * size))) for _ in range(r.randrange(1, 9))]
        weights = [r.choice((1, 1, 2)) for _ in parts]
        seen = collections.Counter()
        for f, w in zip(parts, weights):
            for i in range(len(f) - size + 1):
                seen[f[i:i + size]] += w
        want = [[i for i in range(len(f) - size + 1) if seen[f[i:i + size]] > 1] for f in parts]
        assert [x.tolist() for x in repeated_starts(parts, weights, size)] == want


@pytest.mark.parametrize("hot", [2, 20_000])
def test_remove_repeats(docs, rows, empty, hot):
    size, raws = 40, [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(d[i:i + size] for _, d in raws for i in range(len(d) - size + 1))
    want = []
    for key_, d in raws:
        m = np.zeros(len(d), bool)
        for i in range(len(d) - size + 1):
            if seen[d[i:i + size]] > 1:
                m[i:i + size] = True
        spans = int(np.count_nonzero(np.diff(np.concatenate([[0], m.view(np.int8)])) == 1))
        want.append((key_, len(d), int(m.sum()), spans,
                     hashlib.sha256(np.frombuffer(d, np.uint8)[~m].tobytes()).hexdigest()))
    same(remove_repeats(docs, length=size, gram=16, hot=hot), want)
    assert remove_repeats(empty).count() == 0


def test_decontamination(spark, docs, rows, empty):
    texts = dict(rows)
    items = [(1, " ".join(texts[30].split()[2:30])), (2, "A"), (10, None), (3, "ONE, two three"), (4, ""), (None, texts[31])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    grams = collections.defaultdict(set)
    for name, t in items:
        ws = words_of((t or "").encode())
        n = min(10, len(ws))
        for i in range(len(ws) - n + 1 if n else 0):
            grams[tuple(ws[i:i + n])].add("" if name is None else str(name))
    want = []
    for key_, t in rows:
        ws, hit, own = words_of((t or "").encode()), set(), set()
        for g, names in grams.items():
            for i in range(len(ws) - len(g) + 1):
                if tuple(ws[i:i + len(g)]) == g:
                    hit |= set(range(i, i + len(g)))
                    own |= names
        want.append((key_, len(ws), len(hit), len(own), hashlib.sha256(",".join(sorted(own)).encode()).hexdigest(), bool(hit)))
    same(contamination(docs, bench), want)
    same(contamination(docs, bench, block_words=5), want)  # several automata
    clean = drop_contaminated(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(map(key, ((r.doc_id,) for r in clean.collect()))) == sorted(key((w[0],)) for w in want if not w[2])
    assert contamination(empty, bench).count() == 0
    assert contamination(docs, bench.limit(0)).where("contaminated").count() == 0
    assert ItemAutomaton([]).scan([b"x"], np.zeros(1, bool)) == set()


def test_exact_groups(docs, rows, empty):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[lower(t)].append(i)
    keep = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    same(exact_groups(docs), [(i, keep[lower(t)], len(groups[lower(t)]), i == keep[lower(t)],
                               hashlib.sha256(lower(t).encode()).hexdigest()) for i, t in rows])
    left = drop_exact_copies(docs)
    assert left.columns == docs.columns
    assert sorted(lower(r.text) for r in left.collect()) == sorted(groups)
    assert exact_groups(empty).count() == 0 and drop_exact_copies(empty).count() == 0


def test_exact_groups_compares_bytes(docs, rows):
    from pyspark.sql import functions as F
    same(exact_groups(docs, content_hash=lambda c: F.lit(b"one hash for all")),
         [tuple(r) for r in exact_groups(docs).collect()])


def test_toxicity(spark, docs, empty):
    r = random.Random(8)
    calm = [f"w{k}" for k in range(50)]
    data = [(i, " ".join([r.choice(calm) for _ in range(30)] + (["grimble"] * (1 + i % 4) if i % 5 == 0 else [])))
            for i in range(600)]
    d = spark.createDataFrame(data, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0, int(i % 5 == 0)) for i in range(600)] + [(None, 0, 1), (5, None, None)],
                                   "doc_id long, quality int, toxic int")
    got = {x.doc_id: x for x in toxicity(d, labels).collect()}
    assert sum(got[i].toxic == (i % 5 == 0) for i in got) > 590
    assert all(0 <= x.severity <= 2 for x in got.values())
    mild, harsh = ([got[i].severity for i in got if i % 5 == 0 and i % 4 == k] for k in (0, 3))
    assert sum(harsh) / len(harsh) > sum(mild) / len(mild)
    odd = {x.doc_id: x for x in toxicity(docs, labels.limit(0)).collect()}
    assert not any(x.toxic for x in odd.values())
    assert toxicity(empty, labels).count() == 0


def test_toxicity_takes_one_text_of_an_id(spark, monkeypatch):
    from indistar.llm import toxicity as module
    data = [(i, f"calm words number {i}" + (" grimble" if i % 2 else "")) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    many = next(i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1)
    d = spark.createDataFrame(data + [(many, f"again {k} grimble") for k in range(200)] + [(many, None)],
                              "doc_id long, text string")
    seen, fit = [], module.fit_ordinal
    monkeypatch.setattr(module, "fit_ordinal", lambda rows, *a, **b: seen.append(len(rows)) or fit(rows, *a, **b))
    models = [module.train(x, labels, train_rows=30) for x in (d, d.repartition(5))]
    assert seen == [30, 30]
    assert (models[0].weights == models[1].weights).all()
    module.train(d, labels)
    assert seen[2] == sum(zlib.crc32(str(i).encode()) % 3 != 1 for i in range(60))


def brute_components(texts: dict, per_cent: int = 75):
    sets = {i: set(minhash.shingle_set((t or "").encode()).tolist()) for i, t in texts.items()}
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= per_cent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((top(a), top(b)))
                up[y] = x
    return {i: (len(sets[i]), top(i)) for i in ids}


def test_near_groups(docs, rows, empty):
    texts = {i: t for i, t in rows if i is not None}
    want = brute_components(texts)
    got = [r for r in minhash.near_groups(docs).collect() if r.doc_id is not None]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert minhash.near_groups(empty).count() == 0


def test_near_groups_of_a_crowded_list(spark, monkeypatch):
    """A family of near copies with few and many edits, all in the same lists."""
    monkeypatch.setattr(minhash, "CROWDED", 0.2)
    r = random.Random(2)
    base = [f"b{k}" for k in range(120)]
    texts = {}
    for i in range(90):
        w = list(base)
        for _ in range(i % 9):
            w[r.randrange(len(w))] = f"e{r.randrange(10 ** 9)}"
        texts[i] = " ".join(w)
    got = minhash.near_groups(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == brute_components(texts)


def test_near_groups_of_every_size_around_the_sketch(spark):
    """One word changed in the middle, or the tail cut off to each length
    that is still similar."""
    texts = {}
    for n in range(45, 71):
        words = [f"s{n}x{k}" for k in range(n + 4)]
        for kind, cuts in (("c", [None]), *((f"t{m}", [m]) for m in range(-(-3 * n // 4), n))):
            own = [f"{kind}{w}" for w in words]
            copy = own[:cuts[0] + 4] if cuts[0] else [*own[:25], "changed", *own[26:]]
            texts[len(texts)] = " ".join(own)
            texts[len(texts)] = " ".join(copy)
    got = minhash.near_groups(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    want = {i: (len(minhash.shingle_set(t.encode())), i - i % 2) for i, t in texts.items()}
    assert all(3 * want[i][0] <= 4 * want[i + 1][0] for i in range(0, len(texts), 2))
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in got} == want


def test_near_groups_of_null_and_repeated_ids(spark):
    """Against brute force over rows: links are similar pairs and equal ids."""
    r = random.Random(11)
    data = []
    for f in range(40):
        base = [f"f{f}w{k}" for k in range(r.randrange(30, 200))]
        for _ in range(r.randrange(1, 5)):
            w = list(base)
            w[r.randrange(len(w))] = f"e{r.randrange(10 ** 9)}"
            # a third under one id, a third without one
            data.append((r.choice([7, None, 100 + len(data)]), " ".join(w[:len(w) - r.randrange(3)])))
    data += [(None, "no id " * 9), (None, "no id " * 9), (None, None), (None, ""), (7, None), (50, ""), (50, "a b c"), (51, "a b c"),
             *data[:6], (60, "x " + data[0][1]), (61, "one two three four five six"), (61, "seven eight nine")]
    own = [set(minhash.shingle_set((t or "").encode()).tolist()) for _, t in data]
    up = list(range(len(data)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in range(len(data)):
        for b in range(a):
            both = len(own[a] & own[b])
            if (data[a][0] is not None and data[a][0] == data[b][0]) \
                    or both and 100 * both >= 75 * (len(own[a]) + len(own[b]) - both):
                up[top(a)] = top(b)
    groups = collections.defaultdict(list)
    for i in range(len(data)):
        groups[top(i)].append(data[i][0])
    least = {t: None if None in ids else min(ids) for t, ids in groups.items()}
    want = [(data[i][0], len(own[i]), least[top(i)]) for i in range(len(data))]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    got = minhash.near_groups(df).collect()
    assert sorted((tuple(x)[:3] for x in got), key=key) == sorted(want, key=key)
    assert all(x.kept == (x.doc_id == x.component_id) for x in got if x.doc_id is not None)
    # one null-id row of each group that has one
    assert sum(x.kept for x in got if x.doc_id is None) == sum(None in ids for ids in groups.values())
    left = minhash.drop_near_copies(df).collect()
    assert len(left) == sum(x.kept for x in got)
    at = collections.defaultdict(set)
    for i, d in enumerate(data):
        at[d].add(top(i))
    assert sum(len(at[tuple(x)]) for x in left if x.doc_id is None and x.text) == len(
        {top(i) for i, d in enumerate(data) if d[0] is None and d[1]})
    assert all(least[top(data.index(tuple(x)))] == x.doc_id for x in left)


def test_near_groups_of_one_crowd_stay_few_pairs(spark, monkeypatch):
    r = random.Random(12)
    base = [f"w{i}" for i in range(150)]
    data = []
    for i in range(240):
        words = list(base)
        for j, at in enumerate(r.sample(range(150), r.choice([1, 2]) if i % 2 else r.choice([5, 6]))):
            words[at] = f"own{i}x{j}"
        data.append((i, " ".join(words)))
    own = [set(minhash.shingle_set(t.encode()).tolist()) for _, t in data]
    near = [[b for b in range(len(data)) if 100 * len(own[a] & own[b]) >= 75 * len(own[a] | own[b])] for a in range(len(data))]
    up = list(range(len(data)))
    for _ in range(len(data)):
        new = [min(up[b] for b in near[a]) for a in range(len(data))]
        if new == up:
            break
        up = new
    made, write = {}, minhash.materialise

    def counted(df, name):
        out = write(df, name)
        made[name] = out.count()
        return out
    monkeypatch.setattr(minhash, "materialise", counted)
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    got = {x.doc_id: x.component_id for x in minhash.near_groups(df).collect()}
    assert got == dict(enumerate(up))
    assert made["crowded"] and made["rest"] < 500  # 772 where connected and far documents were paired


def test_components(spark):
    r = random.Random(4)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)]
    up = {}

    def top(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x
    for a, b in edges:
        if a != b:
            x, y = sorted((top(a), top(b)))
            up[y] = x
    got = {x.node: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: top(x) for x in up}


def test_sharding(docs, rows, empty):
    got = shard_records(docs, [1.0] * 7, rows_per_block=3).collect()
    assert sorted(key((x.doc_id, x.size, x.text_crc32)) for x in got) == sorted(
        key((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode()))) for i, t in rows)
    assert len({(x.doc_id, x.shard) for x in got}) == len({x.doc_id for x in got})
    assert all(x.grown_shard in (x.shard, 7) for x in got)
    for s in range(7):
        slots = sorted(x.slot for x in got if x.shard == s)
        assert slots == list(range(len(slots)))
    assert shard_records(empty, [1.0] * 7).count() == 0


def test_sharding_follows_weights(spark):
    n = collections.Counter(x.shard for x in shard_records(
        spark.range(8000).selectExpr("id doc_id", "'' text"), [1.0, 3.0]).collect())
    assert 2.6 < n[1] / n[0] < 3.4


def test_token_counts(docs, rows, empty):
    import sentencepiece
    path = P.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    r = random.Random(6)
    want = []
    for i, t in rows:
        n = len(sp.encode(t or ""))
        want.append((i, len((t or "").encode()), n, n > 50))
    same(token_counts(docs, path, limit=50), want)
    assert token_counts(empty, path).count() == 0
    from indistar.llm.token_count import PieceCounter
    counter = PieceCounter(path, cache=50)  # emptied on the way
    texts = ["".join(r.choice("aabbcd e  \t\n▁éñ中😀\x00<s>0x.-") for _ in range(r.randrange(60))) for _ in range(800)]
    texts += ["a" * 700, " " * 301, "ab" * 400]
    assert counter.counts(texts) == [len(x) for x in sp.encode(texts)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder(name):
    from tokenizers import Tokenizer

    from indistar.llm.encoder import ChunkEncoder
    tok, own, r = Tokenizer.from_file(P.path(name)), ChunkEncoder(P.path(name), cache=200), random.Random(9)
    signs = "aabB cd's e.. ,,\t\n_éÑ中ΣσİẗT̈́😀\x00\x1d<|endoftext|>10²\xa0　"
    texts = ["".join(r.choice(signs) for _ in range(r.randrange(50))) for _ in range(1500)]
    texts += ["a<|endoftext|>b  <|endoftext|> c", "a .b", "a, b.c\nd.\ne 's", "x y" * 500_000, *[t or "" for t in ODD]]
    for t, ids in zip(texts, own.encode_all(texts)):
        assert ids.tolist() == tok.encode(t, add_special_tokens=False).ids, t[:60]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_of_special_strings_in_other_cases(name):
    from tokenizers import Tokenizer

    from indistar.llm.encoder import ChunkEncoder
    tok, own = Tokenizer.from_file(P.path(name)), ChunkEncoder(P.path(name))
    texts = [f"{a}{s}{b}" for s in ("<|ENDOFTEXT|>", "<|EndOfText|>", "<|StartOfText|>", "<|endoftext|>")
             for a, b in (("", ""), ("one ", " two"), ("One", "Two."), ("Σ ", " É"))]
    for t, ids in zip(texts, own.encode_all(texts)):
        assert ids.tolist() == tok.encode(t, add_special_tokens=False).ids, t


def test_packing(docs, rows, empty):
    from tokenizers import Tokenizer
    path = P.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    got = pack_documents(docs, path, max_tokens=256, max_segments=6, block=16).collect()
    ids = {(i, t): np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for i, t in rows}
    total = sum(len(ids[r]) for r in rows)
    assert sum(x.length for x in got) == total
    for i in {r[0] for r in rows if r[0] is not None and rows.count(r) == 1}:
        own = sorted((x for x in got if x.doc_id == i), key=lambda x: x.start)
        seq = ids[i, dict(rows)[i]]
        at = 0
        for x in own:
            assert x.start == at and x.doc_tokens == len(seq)
            assert x.ids_crc32 == zlib.crc32(seq[at:at + x.length].tobytes())
            at += x.length
        assert at == len(seq)
    padding = 0
    for s in {x.sequence_id for x in got}:
        own = sorted((x for x in got if x.sequence_id == s), key=lambda x: x.offset)
        size = sum(x.length for x in own)
        assert [x.offset for x in own] == [0, *np.cumsum([x.length for x in own])[:-1].tolist()]
        assert size <= 256 and len(own) <= 6 and sum(x.loss_tokens for x in own) <= 2048
        padding += 256 - size if size & (size - 1) else 0
    assert padding < 0.1 * total
    assert pack_documents(empty, path).count() == 0


def test_language(spark, docs, empty):
    r = random.Random(7)
    voices = {"one": "abcdefg", "two": "fghijkl", "drei": "äöüßmno"}
    data = [(i, " ".join("".join(r.choice(voices[v]) for _ in range(6)) for _ in range(r.randrange(3, 40))), v)
            for i, v in enumerate(r.choice(list(voices)) for _ in range(400))]
    d = spark.createDataFrame(data + [(1000, None, "one"), (1001, "12 !", "two"), (1002, "abcdefg abc", None)],
                              "doc_id long, text string, lang string")
    got = {x.doc_id: x for x in identify_languages(d).collect()}
    assert all(x.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, x in got.items())
    tested = [(x, data[i][2]) for i, x in got.items() if i < 400 and x.held_out]
    assert sum(x.lang_pred == v for x, v in tested) >= 0.95 * len(tested)
    assert all(0 <= x.score <= 1 for x in got.values())
    assert (got[1000].lang_pred, got[1001].lang_pred, got[1000].score) == ("und", "und", 0)
    assert identify_languages(docs).count() == docs.count()
    assert identify_languages(empty).count() == 0
    assert {x.lang_pred for x in identify_languages(d.drop("lang").selectExpr("*", "cast(null as string) lang")).collect()} == {"und"}


@pytest.mark.parametrize("script", [0x430, 0x915, 0x4E00])
def test_languages_of_one_script(spark, script):
    """Words of equal length from two halves of a block of letters."""
    r = random.Random(5)
    halves = {"one": range(script, script + 16), "two": range(script + 12, script + 28)}
    data = [(i, " ".join("".join(chr(r.choice(halves[v])) for _ in range(5)) for _ in range(r.randrange(5, 30))), v)
            for i, v in enumerate(r.choice(list(halves)) for _ in range(200))]
    got = identify_languages(spark.createDataFrame(data, "doc_id long, text string, lang string")).where("held_out").collect()
    assert len(got) > 40
    assert sum(x.lang_pred == data[x.doc_id][2] for x in got) >= 0.95 * len(got)


def test_wavelet_matrix():
    a = np.random.default_rng(0).integers(0, 90, 3000) ** 2
    w, names, sizes = open_file(pack_file(a, [5, None], [1000, 2000]))
    assert names == [5, None] and sizes.tolist() == [1000, 2000] and (w.to_ids() == a).all()
    for i in (0, 1, 511, 512, 513, 2999):
        assert w.access(i) == a[i]
    for t in (int(a[7]), int(a[99]), 2):
        assert w.count(t) == (a == t).sum() and w.rank(t, 777) == (a[:777] == t).sum()
        assert w.occurrences(t) == np.flatnonzero(a == t).tolist()
    with pytest.raises(IndexError):
        w.select(2, 0)
    assert len(WaveletMatrix.of(np.array([7, 7], np.uint32)).planes) == 0


def test_lookups_unpack_single_frames(monkeypatch):
    a = np.random.default_rng(1).integers(0, 4000, 400_000)
    data = pack_file(a, [1], [len(a)])
    unpacked = []
    whole = StoredPlane.frame

    def frame(self, k):
        if self.last[0] != k:
            unpacked.append(k)
        return whole(self, k)
    monkeypatch.setattr(StoredPlane, "frame", frame)
    for i in (0, 65_535, 65_536, 399_999):
        w, _, _ = open_file(data)
        unpacked.clear()
        assert w.access(i) == a[i] and len(unpacked) <= 2 * len(w.planes) < sum(len(p.ends) for p in w.planes) / 3
    w, _, _ = open_file(data)
    assert w.rank(int(a[9]), 300_000) == (a[:300_000] == a[9]).sum()
    assert w.select(int(a[9]), 5) == np.flatnonzero(a == a[9])[5]
    assert (w.to_ids() == a).all()


def test_token_files(spark, docs, rows, empty):
    from tokenizers import Tokenizer
    path = P.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    got = token_files(docs, path, file_tokens=2000).collect()
    ids = {(i, t): np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for i, t in rows}
    want = sorted(key((i, len(ids[i, t]), zlib.crc32(ids[i, t].tobytes()))) for i, t in rows)
    assert sorted(key((x.doc_id, x.n_tokens, x.ids_crc32)) for x in got) == want
    at = 0
    for x in sorted(got, key=lambda x: x.start):
        assert x.start == at
        at += x.n_tokens
    order = [x.doc_id for x in sorted(got, key=lambda x: x.start) if x.doc_id is not None]
    assert order == sorted(order)
    assert token_files(empty, path).count() == 0
