from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from edges import EDGES, SCHEMA
from tradeloom.llm import mixing


def fill(sizes, weights=(5, 2, 1), most=3):
    """Raise a common level until nothing is left; sources at their limit drop out."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    done, left = {}, float(sum(sizes.values()))
    while True:
        open_ = [s for s in names if s not in done]
        share = left / max(1, sum(w[s] for s in open_))
        over = [s for s in open_ if share * w[s] > most * sizes[s]]
        if not over:
            return {**done, **{s: share * w[s] for s in open_}}
        for s in over:
            done[s] = most * sizes[s]
            left -= done[s]


@pytest.mark.parametrize("sizes", [
    {"a": 1000, "b": 10, "c": 500, "d": 3, None: 70}, {"a": 1, "b": 1000}, {"z": 0, "y": 5}, {"é": 9, "z": 9, "Z": 9, "a": 900}, {"a": 7},
    {"a": 10, "b": 4, "c": 2, "d": 10, "e": 4000},
])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df, (5, 2, 1), 3).collect()}
    assert got == pytest.approx(fill(sizes))


def sized(df):
    return df.select("doc_id", "source", mixing.n_words(F.col("text")).alias("size"))


def test_mix(make):
    rng = np.random.default_rng(3)
    rows = [(i, "w " * int(rng.integers(1, 60)), "hot" if i % 3 else f"s{i % 4}") for i in range(3000)]
    one, two = (sorted(map(tuple, mixing.mix(sized(make(rows, parts=p))).collect())) for p in (3, 5))
    assert one == two
    got = mixing.mix(sized(make(rows))).collect()
    taken, goal = Counter(), {}
    for r in got:
        assert 0 <= r["copies"] <= 3
        taken[r["source"]] += r["copies"] * r["size"]
        goal[r["source"]] = r["target"]
    assert all(abs(taken[s] - goal[s]) <= 130 for s in goal)


def test_systematic_counts(spark):
    rows = spark.createDataFrame([(i, "g" if i % 2 else None, 0.25 * (i % 5)) for i in range(400)], "id long, g string, e double")
    got = mixing.systematic(rows, "g", "e", ["id"], "s").collect()
    for r in got:
        assert int(r["e"]) <= r["_copies"] <= int(np.ceil(r["e"]))
    for g in ("g", None):
        want = sum(r["e"] for r in got if r["g"] == g)
        assert abs(sum(r["_copies"] for r in got if r["g"] == g) - want) < 1


def test_edges(spark, make):
    got = mixing.mix(sized(make(EDGES))).collect()
    assert len(got) == len(EDGES) and all(r["copies"] <= 3 for r in got)
    assert mixing.mix(sized(spark.createDataFrame([], SCHEMA))).count() == 0
