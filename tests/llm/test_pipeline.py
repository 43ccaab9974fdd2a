"""The pipeline's stages against plain versions, and the registered queries against their SQL."""

import re
from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from check import compare, connect
from edges import EDGES, SCHEMA
from test_jaccard import corpus
from tradeloom.llm import queries

SF = "/root/testdata/sf0.001"
STAGE = dict(corpus_pipeline.STAGES)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, name):
    assert compare(entry.queries()[name](spark, SF), connect(SF), entry.oracle_sql()[name]) is None


def test_registered():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and {"doc_id", "piece", "start", "length", "sequence_id", "offset"} <= set(rows[0].asDict())


def test_columns_stay(spark, make):
    docs = make(EDGES)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0, name


def test_one_of_each(spark, make):
    rows = corpus(5)
    got = sorted(r["doc_id"] for r in STAGE["ngram_jaccard_join"](spark, make(rows + rows[:5]), SF).collect())
    assert got == near(rows)
    edges = Counter(r["doc_id"] for r in STAGE["ngram_jaccard_join"](spark, make(EDGES), SF).collect())
    assert edges == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 7: 1, 8: 1, None: 2}


def test_mix_sources(spark, make):
    words = lambda k: " ".join(f"w{k}x{j}" for j in range(10))
    rows = [(i, words(i), "a" if i < 20 else "b") for i in range(100)] + [(5, words(5), "a")] * 2
    got = Counter(r["doc_id"] for r in STAGE["source_mix"](spark, make(rows), SF).collect())
    # Source a holds 220 words and wants 5/7 of 1020, which is over three times its size.
    assert all(got[i] == (9 if i == 5 else 3) for i in range(20))
    assert abs(sum(got[i] for i in range(20, 100)) - 36) <= 1


def test_toxic_go(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    left = {r["doc_id"] for r in STAGE["toxicity"](spark, docs, sf).select("doc_id").collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    toxic, clean = ([r["doc_id"] in left for r in labels if r["toxic"] == t] for t in (1, 0))
    # Some documents that are labelled toxic were turned into junk and hold no toxic word any more.
    assert sum(toxic) < 0.15 * len(toxic) and clean.count(False) <= 0.002 * len(clean)


def near(rows, n=5, percent=80):
    """Smallest id of each component of near copies, by comparing all pairs."""
    words = {i: t.lower().split() for i, t in rows}
    sets = {i: {tuple(w[j:j + n]) for j in range(max(1, len(w) - n + 1))} for i, w in words.items()}
    low = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
    return sorted(set(low.values()))


def test_near_copies_by_five_words(spark, make):
    text = [f"w{i}" for i in range(122)]
    rows = corpus(5) + [(1000, " ".join(text[:100])), (1001, " ".join(text))]
    got = sorted(r["doc_id"] for r in STAGE["ngram_jaccard_join"](spark, make(rows + rows[:5]), SF).collect())
    # 96 of 118 five-word shingles are shared, and 97 of 119 four-word ones, less than 0.85.
    assert got == near(rows) and 1001 not in got


def test_one_id_with_different_texts(spark, make):
    text = lambda k: " ".join(f"t{k}w{j}" for j in range(60))
    # Id 5 has a text of its own, a copy of the text of 3, and two copies of one another; 6 has a null and an empty text.
    rows = [(3, text(0)), (5, text(1)), (5, text(0)), (5, text(2)), (5, text(2) + " more"), (5, text(1)), (6, None), (6, ""), (6, ""), (7, text(1))]
    got = [(r["doc_id"], r["text"]) for r in STAGE["ngram_jaccard_join"](spark, make(rows), SF).collect()]
    assert Counter(d for d, _ in got) == {3: 1, 5: 2, 6: 2}
    assert {(3, text(0)), (5, text(1)), (6, None), (6, "")} < set(got) and (5, text(0)) not in got
