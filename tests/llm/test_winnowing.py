"""Decontamination against a plain version that compares every window."""

import random
import re

import pytest

from edges import EDGES, SCHEMA
from tradeloom.llm import winnowing

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEM = "item_id long, text string, doc_id long, h string, c string, w string"


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, window=10):
    windows = {}
    for i, t in items:
        w = words(t)
        m = min(window, len(w))
        for j in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[j:j + m]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, named = words(t), set(), set()
        for m in {len(x) for x in windows}:
            for j in range(len(w) - m + 1):
                if tuple(w[j:j + m]) in windows:
                    hit |= set(range(j, j + m))
                    named |= windows[tuple(w[j:j + m])]
        out.append((d, len(w), len(hit), sorted(str(i) for i in named if i is not None)))
    return sorted(out, key=str)


def found(docs, items, **kw):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["item_ids"]) for r in winnowing.contamination(docs, items, **kw).collect()), key=str)


def bench(spark, items):
    return spark.createDataFrame([(i, t, 7, "x", "y", "z") for i, t in items], ITEM)


def corpus(seed, n=120):
    """Few words, so grams repeat inside and across texts; passages of all lengths around the window."""
    rnd = random.Random(seed)
    text = lambda k, size=4: " ".join(f"w{rnd.randrange(size)}" for _ in range(k))
    items = [(i, text(rnd.randrange(10, 40))) for i in range(20)] + [(100 + m, text(m, 9)) for m in range(1, 10, 2)]
    items += [(20, items[0][1]), (21, items[1][1] + " tail " + items[2][1]), (3, text(15)), (22, ""), (23, None), (None, text(12, 3)), (24, "!!! ...")]
    docs = []
    for d in range(n):
        parts = []
        for _ in range(rnd.randrange(1, 5)):
            w = words(rnd.choice(items)[1])
            if w and rnd.random() < 0.7:
                a = rnd.randrange(len(w))
                parts.append(rnd.choice([", ", "\n"]).join(w[a:a + rnd.randrange(5, 20)]).upper())
            parts.append(text(rnd.randrange(0, 30), 200))
        docs.append((d, " ".join(parts)))
    return docs, items


@pytest.mark.parametrize("seed,kw", [(1, {}), (2, {"k": 10}), (3, {"k": 1}), (4, {"window": 6, "k": 3}), (5, {"block": 10}), (6, {"block": 13, "k": 5})])
def test_plain(spark, make, seed, kw):
    docs, items = corpus(seed)
    want = plain(docs, items, kw.get("window", 10))
    assert found(make(docs), bench(spark, items), **kw) == want
    assert any(r[2] for r in want) and any(not r[2] for r in want)


def test_spans(spark, make):
    passage = " ".join(f"p{i}" for i in range(12))
    docs = [(1, f"a b {passage} c"), (2, f"{passage[:-4]} z {passage}")]
    got = {r["doc_id"]: r for r in winnowing.contamination(make(docs), bench(spark, [(5, "x " + passage)])).collect()}
    assert got[1]["n_hit"] == 12 and min(s["lo"] for s in got[1]["spans"]) == 2 and max(s["hi"] for s in got[1]["spans"]) == 14
    assert got[2]["n_hit"] == 23 and got[2]["item_ids"] == ["5"]


def test_edges(spark, make):
    rows = [(r[0], r[1]) for r in EDGES]
    items = [(1, "one two three"), (1, "solo"), (2, " ".join(f"word{i} and{i % 97}" for i in range(500, 540))), (3, "日本語"), (4, "Ünï")]
    assert found(make(EDGES), bench(spark, items), block=1000) == plain(rows, items)
    none = spark.createDataFrame([], SCHEMA)
    assert found(none, bench(spark, items)) == []
    assert all(r[2] == 0 and r[3] == [] for r in found(make(EDGES), bench(spark, [])))
    same = [(1, "one two three four five six seven eight nine ten eleven"), (1, "Other words that nothing shares"), (None, "ten " * 15), (None, "x")]
    items = [(9, same[0][1]), (8, "ten " * 10)]
    assert found(make(same), bench(spark, items)) == plain(same, items)


def test_no_python(spark, make):
    plan = winnowing.contamination(make([(1, "a")]), bench(spark, [(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_bad_parameters(spark, make):
    with pytest.raises(ValueError):
        winnowing.shared(make([(1, "a")]), bench(spark, [(1, "a")]), window=3, k=4)
