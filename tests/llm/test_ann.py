import numpy as np

from tradeloom.llm import ann


def plain(rows, k, picked):
    rows = {i: np.array(v) for i, v in rows}
    out = set()
    for q in rows:
        if picked(q):
            best = sorted((-float((rows[q] * v).sum()), i) for i, v in rows.items() if i != q)[:k]
            out |= {(q, r + 1, i) for r, (_, i) in enumerate(best)}
    return out


def test_recall_and_scores(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((1500, 48)) * rng.uniform(0.2, 3, (1500, 1)) + 0.3
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.search(df, "id % 20 = 0", block=400, query_block=30).collect()
    assert len(got) == 75 * 20
    want = plain(rows, 20, lambda i: i % 20 == 0)
    assert len({(q, i) for q, _, i in want} & {(r["query_id"], r["vec_id"]) for r in got}) / len(want) > 0.98
    for r in got:
        assert abs(r["score"] - float(x[r["query_id"]] @ x[r["vec_id"]])) < 1e-9


def test_rounds_of_queries_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x, ids = rng.standard_normal((300, 16)), np.arange(300)
    center, turn = x.mean(0), ann.rotation(16)
    args = (ids, ids, x, *ann.encode(x, center, turn), ids[:50], ids[:50], x[:50], center, turn, 5, 9.0)
    once = ann.nearest_in_block(*args)
    monkeypatch.setattr(ann, "ROUND", 7)
    assert ann.nearest_in_block(*args) == once
    assert {(q, i) for q, _, i, _ in once} == {(q, i) for q, _, i in plain(list(zip(ids.tolist(), x)), 5, lambda i: i < 50)}


def test_estimate_is_within_its_bound():
    rng = np.random.default_rng(1)
    x, q = rng.standard_normal((3000, 64)), rng.standard_normal((20, 64))
    center, turn = x.mean(0), ann.rotation(64)
    guess, bound = ann.estimate(*ann.encode(x, center, turn), q, center, turn, 2.5)
    off = np.abs(guess - q @ x.T)
    assert (off <= bound).mean() > 0.97 and abs((guess - q @ x.T).mean()) < 0.1
    assert np.allclose(turn @ turn.T, np.eye(64))


def test_edges(spark):
    v = [1.0, 0.0, 2.0]
    rows = [(0, v), (20, v), (20, v), (3, v), (1, v), (2, [0.0, 0.0, 0.0]), (4, None), (5, [1.0, None, 1.0]), (6, [float("nan"), 1.0, 1.0]),
            (7, [float("inf"), 0.0, 0.0]), (8, []), (9, [1.0]), (None, v), (40, [-1.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' rank", "1 block", "2 id", "3 v")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in ann.search(df, "id % 20 = 0").collect())
    assert got == [(0, 1, 1, 5.0), (0, 2, 3, 5.0), (0, 3, 20, 5.0), (0, 4, 40, -1.0), (20, 1, 0, 5.0), (20, 2, 1, 5.0), (20, 3, 3, 5.0),
                   (20, 4, 40, -1.0), (40, 1, 0, -1.0), (40, 2, 1, -1.0), (40, 3, 3, -1.0), (40, 4, 20, -1.0)]
    assert ann.search(df.limit(0), "id % 20 = 0").count() == 0
    assert ann.search(df.filter("vec_id = 1"), "id % 20 = 0").count() == 0


def test_vectors_of_one_id_are_rows_of_their_own(spark):
    rows = [(20, [1.0, 0.0]), (20, [9.0, 0.0]), (20, [9.0, 0.0]), (1, [1.0, 0.0]), (1, [3.0, 1.0]), (2, [-1.0, 5.0])]
    got = sorted((r["query_id"], r["score"], r["rank"], r["vec_id"]) for r in ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "id % 20 = 0").collect())
    assert got == sorted([(20, 9.0, 1, 20), (20, 3.0, 2, 1), (20, 1.0, 3, 1), (20, -1.0, 4, 2), (20, 27.0, 1, 1), (20, 9.0, 2, 1), (20, 9.0, 3, 20), (20, -9.0, 4, 2)])
