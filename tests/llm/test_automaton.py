"""Item automata as arrays: built in tasks, cut into blocks, scanned in passes."""

import pickle
import random

import numpy as np
import pytest

from indistar.llm import decontaminate as dc


def _brute(items, words, window):
    grams = {}
    for k, ws in enumerate(items):
        n = min(window, len(ws))
        for i in range(len(ws) - n + 1 if n else 0):
            grams.setdefault(tuple(ws[i:i + n]), set()).add(k)
    hit, own = np.zeros(len(words), bool), set()
    for g, owners in grams.items():
        for i in range(len(words) - len(g) + 1):
            if tuple(words[i:i + len(g)]) == g:
                hit[i:i + len(g)] = True
                own |= owners
    return hit, own


@pytest.mark.parametrize("seed", range(60))
def test_scan_equals_brute_force(seed):
    rng = random.Random(seed)
    letters = [bytes([97 + i]) for i in range(rng.choice([1, 2, 3, 8, 26]))]
    window = rng.choice([1, 2, 3, 5, 10])
    items = [[rng.choice(letters) for _ in range(rng.choice([0, 1, 2, 4, 9, 30]))] for _ in range(rng.randint(0, 12))]
    items += items[:2]  # the same item twice
    a = pickle.loads(pickle.dumps(dc.ItemAutomaton(items, window)))
    for _ in range(10):
        words = [rng.choice([*letters, b"other"]) for _ in range(rng.randint(0, 40))]
        for item in rng.sample(items, min(2, len(items))):
            at, start = rng.randint(0, len(words)), rng.randint(0, 5)
            words[at:at] = item[start:start + rng.randint(0, 20)]
        hit = np.zeros(len(words), bool)
        own = a.scan(words, hit)
        want, owners = _brute(items, words, window)
        assert own == owners and (hit == want).all()


def test_pieces_hold_every_window():
    for n in range(0, 60):
        ws, most = [b"%d" % i for i in range(n)], 12
        pieces = list(dc._pieces(ws, 5, most))
        assert all(len(p) <= most for p in pieces)
        wins = lambda q: {tuple(q[i:i + min(5, len(q))]) for i in range(len(q) - min(5, len(q)) + 1)}
        assert set().union(*map(wins, pieces)) == wins(ws)
        assert n < 5 or all(len(p) >= 5 for p in pieces)


def test_blocks_and_passes_change_nothing(spark, monkeypatch):
    rng = random.Random(11)
    word = lambda: f"w{rng.randint(0, 60)}"
    items = [(i % 17, " ".join(word() for _ in range(rng.choice([3, 9, 10, 25, 200])))) for i in range(40)] + [(99, None), (None, "w1 w2")]
    docs = []
    for i in range(60):
        ws = [word() for _ in range(rng.randint(0, 30))]
        src = (rng.choice(items)[1] or "").split()
        ws[3:3] = src[:rng.choice([0, 5, 15, 150])]
        docs.append((i, " ".join(ws)))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, dc.contamination(d, b).collect()))
    monkeypatch.setattr(dc, "PASS_BLOCKS", 2)
    one = b.coalesce(1)
    assert dc.item_automata(one, block_words=120).count() > 6
    assert sorted(map(tuple, dc.contamination(d, one, block_words=120).collect())) == whole
    assert sum(r[2] > 0 for r in whole) > 20
