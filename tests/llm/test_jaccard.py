import random
import re

import numpy as np
import pytest

from edges import EDGES, LONG, SCHEMA
from tradeloom.llm import jaccard
from tradeloom.llm.components import stars


def grams(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i:i + 4]) for i in range(len(words) - 3)} if len(words) > 3 else {tuple(words)}


def plain(rows, percent=85):
    """doc_id -> (size, smallest id reachable), by comparing all pairs."""
    sets = {i: grams(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10 ** 6)}"
    return words


def corpus(seed, groups=12, copies=8):
    """Groups of copies with few or many edits, common passages, short texts, exact copies, case changes."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(40)]
    texts = []
    for g in range(groups):
        base = [f"g{g}w{rng.randrange(400)}" for _ in range(rng.choice([5, 7, 9, 12, 20, 40, 150, 300]))]
        for _ in range(copies):
            words = edited(rng, base, rng.choice([0, 0, 1, 1, 2, len(base) // 40, len(base) // 15]))
            if rng.random() < 0.4:
                words = words + passage
            text = " ".join(words)
            texts.append(text.upper() if rng.random() < 0.1 else text)
    texts += [" ".join(passage + edited(rng, passage, 1)[:rng.randrange(1, 6)]) for _ in range(15)]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", range(4))
def test_join_equals_all_pairs(make, seed):
    rows = corpus(seed)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(make(rows)).collect()}
    assert got == plain(rows)


@pytest.mark.parametrize("seed", [0, 3])
def test_links_equal_all_pairs(make, seed):
    """Every link between different sets, also inside groups of copies."""
    rows = corpus(seed)
    low = {}
    for i, t in rows:
        low.setdefault(frozenset(grams(t)), i)
    want = {(a, b): len(s & t) / len(s | t) for s, a in low.items() for t, b in low.items()
            if a < b and 100 * len(s & t) >= 85 * len(s | t)}
    got = [(r["a_doc_id"], r["b_doc_id"], r["jaccard"]) for r in jaccard.pairs(make(rows)).collect()]
    # A spanning forest has fewer.
    assert len(want) > len(low) - len({v[1] for v in plain(rows).values()})
    assert len(got) == len(want) and {p[:2] for p in got} == set(want)
    assert all(abs(j - want[a, b]) < 1e-9 for a, b, j in got)


@pytest.mark.parametrize("x", [0, 12, 64])
def test_any_boundary_gives_the_same(make, monkeypatch, x):
    monkeypatch.setattr(jaccard, "measured", lambda rows, percent: x)
    rows = corpus(9)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(make(rows)).collect()}
    assert got == plain(rows)


@pytest.mark.parametrize("size", [1, 3])
def test_lists_paired_in_blocks_give_the_same(make, monkeypatch, size):
    monkeypatch.setattr(jaccard, "LIST_BLOCK", size)
    rows = corpus(6)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(make(rows)).collect()}
    assert got == plain(rows)
    sets = {frozenset(grams(t)) for _, t in rows if grams(t)}
    links = sum(a is not b and 100 * len(a & b) >= 85 * len(a | b) for a in sets for b in sets) // 2
    assert jaccard.pairs(make(rows)).count() == links


def test_chain_of_links(make):
    """Each text is linked with the next one only; the ends share little."""
    words = [f"w{i}" for i in range(400)]
    rows = [(100 + i, " ".join(words[8 * i:8 * i + 130])) for i in range(30)]
    got = {r["component_id"] for r in jaccard.join(make(rows), percent=85).collect()}
    assert got == {v[1] for v in plain(rows).values()} == {100}


def test_edges(spark, make):
    rows = jaccard.join(make(EDGES)).collect()
    assert len(rows) == len(EDGES)
    by = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows}
    assert {(1, 0, 1), (2, 0, 2), (3, 0, 3), (5, 1, 5), (6, 1, 5), (7, 1, 7), (None, 0, None), (None, 2, None)} <= by
    assert (4, len(grams(LONG)), 4) in by
    assert jaccard.join(spark.createDataFrame([], SCHEMA)).count() == 0


def test_shingles():
    for text in ("", None, "a b c", "a b c d", "A b\x0bC d e", "a b c d a b c d", "é É e E x"):
        assert len(jaccard.shingles(text)) == len(grams(text))
    assert np.array_equal(jaccard.shingles("A B C D"), jaccard.shingles("a b\tc d"))
    assert len({jaccard.shingles(t)[0] for t in ("a", "a a", "a a a", "a a a a")}) == 4


def test_a_boundary_above_the_first_sizes(make, monkeypatch):
    """Longer texts that hold the same words: lists of single n-grams are long, those of subsets are not."""
    rng = random.Random(4)
    shared = [f"s{i}" for i in range(40)]
    rows = [(i, " ".join(f"{a} {b}" for a, b in zip(rng.sample(shared, 40), rng.sample(shared, 40)))) for i in range(120)]
    rows += [(200 + i, t) for i, (_, t) in enumerate(rows[:10])]
    monkeypatch.setattr(jaccard, "SAMPLED", 1)
    found, _ = jaccard.classes(make(rows), 1, 85)
    low, high = jaccard.measured(found, 85, 4), jaccard.measured(found, 85, 1000)
    assert low == high
    pairs = {30: 10.0, 80: 2000.0, 300: 20.0, 900: 9e9}
    assert jaccard.boundary(pairs, {30: 1e3, 80: 1e4, 300: 1e6, 900: 1.0}, 85) == 300


def test_boundary():
    cheap, dear = {7: 1.0, 8: 1.0}, {7: 100.0, 8: 100.0, 9: 10.0}
    assert jaccard.boundary(cheap, dear, 85) == 64 or jaccard.boundary(cheap, dear, 85) >= 9
    assert jaccard.boundary({7: 1000.0}, {7: 1.0}, 85) == 0 and jaccard.boundary({}, {}, 85) == 0


def test_stars(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    got = {r["node"]: r["root"] for r in stars(spark.createDataFrame(edges, "a long, b long")).collect()}
    low = {}
    for _ in range(100):
        for a, b in edges:
            m = min(low.get(a, a), low.get(b, b))
            low[a] = low[b] = m
    assert got == {k: v for k, v in low.items() if k != v}
    assert stars(spark.createDataFrame([], "a long, b long")).count() == 0
