"""Search by an automaton against scores counted by hand."""

import math
import random
import re
from collections import Counter

import pytest

from edges import EDGES, SCHEMA
from tradeloom.llm import lexical

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEM = "item_id long, text string, doc_id long, item string, rank int, term string"


def terms(text):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in WORD.findall(text or "")]


def plain(docs, items, k=10):
    bags = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs if terms(t)]
    n_docs, n_words = len(bags), sum(b[2] for b in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = []
    for i, ts in wanted.items():
        found = []
        for d, bag, n in bags:
            m = 100 - 90 + (90 * n * n_docs) // n_words
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in ts if t in bag)
            if score > 0:
                found.append((-score, d is None, d, score))
        out += [(i, r + 1, f[2], f[3]) for r, f in enumerate(sorted(found, key=lambda f: (f[0], f[1], f[2] or 0))[:k])]
    return sorted(out, key=str)


def found(docs, items, **kw):
    return sorted((tuple(r) for r in lexical.search(docs, items, **kw).select("item_id", "rank", "doc_id", "score").collect()), key=str)


def bench(spark, items):
    return spark.createDataFrame([(i, t, 7, "x", 1, "z") for i, t in items], ITEM)


@pytest.mark.parametrize("seed,kw", [(1, {}), (2, {"most_pairs": 7}), (3, {"k": 3, "most_pairs": 25})])
def test_plain(spark, make, seed, kw):
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["a", "b", "ab", "aba", "Ünï", "ünï", "日本", "x9", "Über", "the", "THE"]) + rnd.choice(["", "", "s", "1"])
    text = lambda n: "".join(word() + rnd.choice([" ", ", ", "\n", "-", "\x00", "_"]) for _ in range(n))
    docs = [(rnd.randrange(150), text(rnd.randrange(0, 60))) for _ in range(200)]
    docs += docs[:20] + [(None, docs[3][1]), (None, docs[4][1]), (2 ** 60 + 1, docs[5][1])]
    items = [(i, text(rnd.randrange(1, 12))) for i in range(15)] + [(3, text(4)), (None, text(5)), (2 ** 60 + 1, "a B"), (40, "nowhere"), (41, None), (42, "...")]
    assert found(make(docs), bench(spark, items), **kw) == plain(docs, items, kw.get("k", 10))


def test_whole_words_only(spark, make):
    docs = [(1, "cat"), (2, "cats concat cat_ CAT"), (3, "concat"), (4, "cat cat cat"), (5, "écat")]
    got = found(make(docs), bench(spark, [(1, "Cat?")]))
    assert {r[2] for r in got} == {1, 2, 4} and got == plain(docs, [(1, "Cat?")])


def test_ties_by_doc_id(spark, make):
    docs = [(d, "same words here") for d in range(300, 0, -1)] + [(d, "other") for d in range(400, 800)]
    assert [r[2] for r in sorted(found(make(docs, parts=5), bench(spark, [(1, "same")])), key=lambda r: r[1])] == list(range(1, 11))


def test_edges(spark, make):
    items = [(1, "one three"), (2, "word7 and7"), (3, "çödé 日本語"), (4, "")]
    assert found(make(EDGES), bench(spark, items)) == plain([(r[0], r[1]) for r in EDGES], items)
    assert found(spark.createDataFrame([], SCHEMA), bench(spark, items)) == []
    assert found(make(EDGES), bench(spark, [])) == [] and found(make([(1, None), (2, "")]), bench(spark, items)) == []


def test_best_keeps_ties():
    import numpy as np
    best = lexical.Best(2, 2)
    best.add(np.array([0, 0, 0, 1]), np.array([5, 5, 5, 0]), np.array([9, 8, 7, 1]))
    best.settle()
    best.add(np.array([0, 1]), np.array([5, 1]), np.array([6, 3]))
    best.settle()
    assert list(zip(best.item, best.score, best.doc)) == [(0, 5, 6), (0, 5, 7), (1, 1, 3)]
