"""Nearest neighbours by randomly rotated one-bit codes, reranked where an error bound allows."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.common import unit, written


#: Queries whose estimates a task holds at once.
ROUND = 256


def rotation(dim: int, seed: int = 7) -> np.ndarray:
    """Random orthogonal matrix, the same for every task."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(x: np.ndarray, center: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits of the rotated directions from the centre, and two correction scalars.

    The scalars are the distance from the centre, and the inner product of a direction with its code
    (1 for a vector at the centre, which has no direction).
    """
    d = x - center
    length = np.sqrt((d * d).sum(1))
    o = (d / np.where(length > 0, length, 1.0)[:, None]) @ turn.T
    own = np.where(length > 0, np.abs(o).sum(1) / np.sqrt(x.shape[1]), 1.0)
    return np.packbits(o > 0, axis=1), length, own


def estimate(codes: np.ndarray, length: np.ndarray, own: np.ndarray, queries: np.ndarray, center: np.ndarray, turn: np.ndarray,
             sure: float) -> tuple[np.ndarray, np.ndarray]:
    """Inner products (query, vector) estimated from the codes, and how far off they may be.

    The estimate is unbiased over rotations. Its error is below the bound but for the tail of a
    normal distribution beyond `sure` deviations.
    """
    dim = queries.shape[1]
    bits = np.unpackbits(codes, axis=1, count=dim).astype(np.float32)
    turned = (queries @ turn.T).astype(np.float32)
    along = (2 * (turned @ bits.T) - turned.sum(1, keepdims=True)) / np.float32(np.sqrt(dim))
    scale = (length / own).astype(np.float32)
    wide = length * np.sqrt(np.maximum(1 / own ** 2 - 1, 0)) * sure / np.sqrt(max(dim - 1, 1))
    size = np.sqrt((queries * queries).sum(1))
    return along * scale + (queries @ center)[:, None].astype(np.float32), (size[:, None] * wide[None, :]).astype(np.float32)


def nearest_in_block(ids: np.ndarray, names: np.ndarray, x: np.ndarray, codes: np.ndarray, length: np.ndarray, own: np.ndarray, q_ids: np.ndarray,
                     q_names: np.ndarray, queries: np.ndarray, center: np.ndarray, turn: np.ndarray, k: int, sure: float) -> list[tuple[int, int, int, float]]:
    """The block's `k` nearest of each query, as query's id and name, vector's id, and exact inner product.

    A vector of the query's name is the query itself and no neighbour.

    The best estimates are reranked first; their k-th exact score is what any other vector's
    estimate plus bound must reach to be reranked, too. Queries are estimated `ROUND` at a time.
    """
    out, top = [], min(2 * k, len(ids))
    for i, q in enumerate(queries):
        if i % ROUND == 0:
            guesses, bounds = estimate(codes, length, own, queries[i:i + ROUND], center, turn, sure)
        guess, bound = guesses[i % ROUND], bounds[i % ROUND]
        first = np.argpartition(-guess, top - 1)[:top]
        exact = (x[first] * q).sum(1)
        floor = np.sort(exact)[-min(k + 1, top)] if top > k else -np.inf
        some = np.flatnonzero((guess + bound >= floor) & (names != q_names[i]))
        exact = (x[some] * q).sum(1)
        best = np.lexsort((ids[some], -exact))[:k]
        out += zip([int(q_ids[i])] * len(best), [int(q_names[i])] * len(best), ids[some][best].tolist(), exact[best].tolist())
    return out


def vectors(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v, row): the vectors that take part, as doubles, with a hash of both that names the row.

    Left out are rows without id, and vectors that are null, zero, of another length than most, or
    hold null or non-finite components. Rows that are equal in id and vector are one; different
    vectors of one id are rows of their own.
    """
    v = F.col(vec_col).cast("array<double>")
    rows = rows.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter(F.col("id").isNotNull() & (F.size("v") > 0))
    rows = rows.filter(F.expr("forall(v, x -> x is not null and not isnan(x) and abs(x) < double('Infinity')) and exists(v, x -> x != 0)"))
    rows = written(rows.distinct().withColumn("row", F.xxhash64("id", "v")), "vectors")
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.filter(F.size("v") == (sizes["d"] if sizes else 0))


def search(rows: DataFrame, queries: str, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20, block: int = 8192,
           query_block: int = 4096, sample: int = 10000, sure: float = 2.5) -> DataFrame:
    """(query_id, rank, vec_id, score): the `k` rows of largest inner product for each row that `queries` picks.

    `queries` is an SQL condition on `id`. The centre is the mean of about `sample` vectors, taken by
    hash; every vector is coded and met by every query, block by block: a task holds one block of
    vectors and one of queries, whatever the number of rows. Scores are exact, in double precision;
    ties go to the smaller id. Where an id that is asked for has several vectors, each is a query of its
    own. See `vectors` for rows that take no part.
    """
    clean = vectors(rows, id_col, vec_col)
    total = clean.count()
    wanted = clean.filter(queries)
    schema = "query_id long, query_row long, vec_id long, score double"
    some = clean.filter(unit(F.col("id"), "centre") < min(1.0, sample / max(1, total)))
    mean = some.select(F.posexplode("v").alias("i", "x")).groupBy("i").agg(F.avg("x").alias("m")).orderBy("i").collect()
    dim = len(clean.select("v").first()["v"]) if total else 1
    center = np.array([r["m"] for r in mean]) if mean else np.zeros(dim)
    turn = rotation(dim)
    blocks, q_blocks = max(1, -(-total // block)), max(1, -(-wanted.count() // query_block))

    numbers = lambda n: F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))

    def code(batches):
        for rows in batches:
            if len(rows):
                codes, length, own = encode(np.stack(rows["v"].to_numpy()), center, turn)
                yield rows.assign(code=[c.tobytes() for c in codes], length=length, own=own)

    index = clean.mapInPandas(code, "id long, v array<double>, row long, code binary, length double, own double")
    index = index.withColumns({"block": F.pmod("row", F.lit(blocks)), "q_block": F.explode(numbers(q_blocks))})
    asked = wanted.withColumns({"q_block": F.pmod(F.xxhash64("row"), F.lit(q_blocks)), "block": F.explode(numbers(blocks))})

    def cell(data: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(data) and len(ask):
            codes = np.stack([np.frombuffer(c, np.uint8) for c in data["code"]])
            found = nearest_in_block(
                data["id"].to_numpy(), data["row"].to_numpy(), np.stack(data["v"].to_numpy()), codes, data["length"].to_numpy(), data["own"].to_numpy(),
                ask["id"].to_numpy(), ask["row"].to_numpy(), np.stack(ask["v"].to_numpy()), center, turn, k, sure)
        return pd.DataFrame(found, columns=["query_id", "query_row", "vec_id", "score"])

    near = index.groupBy("block", "q_block").cogroup(asked.groupBy("block", "q_block")).applyInPandas(cell, schema)
    rank = F.row_number().over(Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
