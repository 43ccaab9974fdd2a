"""Toxicity categories by a chain of linear classifiers."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import slices, unit, written

_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> set[str]:
    """Distinct words, runs of letters in small letters, and the first six letters of longer ones with a star."""
    found = set(_WORD.findall((text or "").lower()))
    return found | {f"{w[:6]}*" for w in found if len(w) > 6}


@dataclass(frozen=True)
class Chain:
    """Categories in order, the vocabulary, and weights: vocabulary, earlier categories, constant.

    `learnt` says for each category whether the labels held it and its opposite; if not, its
    probability tells nothing.
    """

    categories: tuple[str, ...]
    vocabulary: tuple[str, ...]
    weights: tuple[np.ndarray, ...]
    learnt: tuple[bool, ...]

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Probabilities (text, category)."""
        at = {w: i for i, w in enumerate(self.vocabulary)}
        hits = [[at[w] for w in words(t) & at.keys()] for t in texts]
        return chained(hits, len(at), self.weights)


def chained(hits: list[list[int]], size: int, weights: tuple[np.ndarray, ...]) -> np.ndarray:
    """Each category's probability from the words and from the probabilities of those before it."""
    out = np.zeros((len(hits), len(weights)))
    flat, rows = _flat(hits)
    for c, w in enumerate(weights):
        z = np.bincount(rows, w[flat], len(hits)) + out[:, :c] @ w[size:size + c] + w[-1]
        out[:, c] = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    return out


def _flat(hits: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    n = np.array([len(h) for h in hits], np.int64)
    return np.array([i for h in hits for i in h], np.int64), np.repeat(np.arange(len(hits)), n)


def logistic(flat: np.ndarray, rows: np.ndarray, size: int, dense: np.ndarray, y: np.ndarray, l2: float, steps: int = 200) -> np.ndarray:
    """Weights of a ridge-penalised logistic regression on word marks and `dense` columns, by
    accelerated gradient steps, each weight with a step length of its own."""
    n, width = len(y), size + dense.shape[1] + 1
    w, v, t = np.zeros(width), np.zeros(width), 1.0
    # A row's curvature is at most a quarter of its length for each of its columns.
    length = (np.bincount(rows, minlength=n) + dense.shape[1] + 1) / (4.0 * n)
    rate = 1 / (np.concatenate([np.bincount(flat, length[rows], size), dense.T ** 2 @ length, [length.sum()]]) + l2)
    for _ in range(steps):
        z = np.bincount(rows, v[flat], n) + dense @ v[size:-1] + v[-1]
        r = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y) / n
        g = np.concatenate([np.bincount(flat, r[rows], size), dense.T @ r, [r.sum()]])
        g[:-1] += l2 * v[:-1]
        new = v - rate * g
        s = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, w, t = new + (t - 1) / s * (new - w), new, s
    return w


def fit_chain(hits: list[list[int]], labels: np.ndarray, size: int, folds: np.ndarray, l2: float = 1e-4) -> tuple[np.ndarray, ...]:
    """Weights of each category's model, in order.

    A later model sees the earlier categories as probabilities. Those of its training rows come from
    models that did not see the row (one for each fold), as at prediction time. A row without a
    label (nan) of a category is left out of that category's models only.
    """
    flat, rows = _flat(hits)
    dense, weights = np.zeros((len(hits), 0)), []
    for c in range(labels.shape[1]):
        y = labels[:, c].astype(float)
        known = ~np.isnan(y)

        def fitted(some: np.ndarray) -> np.ndarray:
            keep, new = some[rows], np.cumsum(some) - 1
            return logistic(flat[keep], new[rows[keep]], size, dense[some], y[some], l2)

        weights.append(fitted(known))
        if c + 1 == labels.shape[1]:
            break
        unseen = np.zeros(len(hits))
        for fold in np.unique(folds):
            inside = folds != fold
            w = fitted(inside & known)
            z = np.bincount(rows, w[flat], len(hits)) + dense @ w[size:-1] + w[-1]
            unseen[~inside] = 1 / (1 + np.exp(-np.clip(z[~inside], -500, 500)))
        dense = np.column_stack([dense, unseen])
    return tuple(weights)


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, str], most: int = 20000, terms: int = 1500,
          least: int = 5, sure: float = 15.0, folds: int = 3, seed: str = "toxic") -> Chain:
    """Chain for `categories` (name -> SQL condition over the columns of `labels`), fitted on a bounded sample.

    About `most` labelled documents are taken by a hash of doc_id; rows whose doc_id is null are not
    labelled, and where a condition is null the row is not labelled for that category. Of all words of the sample the `terms` that tell each
    category apart best, by chi-squared, are the vocabulary, if they are in `least` documents or more and
    their chi-squared is `sure` or more. Where labels repeat for
    a document, the largest counts. Without labelled rows every probability is one half.
    """
    names = list(categories)
    flags = [F.expr(f"cast({c} as int)").alias(f"_y{i}") for i, c in enumerate(categories.values())]
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), *flags).dropna(subset=["_id"]).dropna("all", subset=[f"_y{i}" for i in range(len(names))])
    known = known.groupBy("_id").agg(*[F.max(f"_y{i}").alias(f"_y{i}") for i in range(len(names))])
    share = min(1.0, most / max(1, known.count()))
    known = known.filter(unit(F.col("_id"), seed) < share).withColumn("_fold", F.floor(unit(F.col("_id"), f"{seed}-fold") * folds).cast("int"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sample = texts.join(known, F.col("doc_id") == F.col("_id"))

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            bag = pa.array([sorted(words(t)) for t in batch.column("text").to_pylist()], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([bag, *[batch.column(c) for c in kept]], names=["bag", *kept])

    kept = [f"_y{i}" for i in range(len(names))] + ["_fold"]
    bagged = written(sample.select("text", *kept).mapInArrow(bags, "bag array<string>, " + ", ".join(f"{c} int" for c in kept)), "bags")
    total = bagged.agg(*[F.count(c) for c in kept[:-1]], *[F.coalesce(F.sum(c), F.lit(0)) for c in kept[:-1]]).first()
    totals = [(float(total[i]), float(total[len(names) + i])) for i in range(len(names))]
    learnt = tuple(0 < p < n for n, p in totals)
    used = bagged.select(F.explode("bag").alias("w"), *kept[:-1]).groupBy("w").agg(
        *[F.count(c).alias(f"n{c}") for c in kept[:-1]], *[F.sum(c).alias(c) for c in kept[:-1]])
    vocabulary: set[str] = set()
    for i, c in enumerate(kept[:-1]):
        n, p = totals[i]
        expected = F.col(f"n{c}") * p / max(n, 1.0)
        chi = (F.col(c) - expected) ** 2 / F.greatest(expected * (1 - F.col(f"n{c}") / (n + 1)), F.lit(1e-9))
        vocabulary |= {r[0] for r in used.filter(F.col(f"n{c}") >= least).select("w", chi.alias("chi")).filter(F.col("chi") >= sure).orderBy(F.desc("chi"), "w").limit(terms).collect()}
    terms_ = tuple(sorted(vocabulary))
    index = {w: i for i, w in enumerate(terms_)}

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = pa.array([[index[w] for w in bag if w in index] for bag in batch.column("bag").to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([hit, *[batch.column(c) for c in kept]], names=["hit", *kept])

    rows = bagged.mapInArrow(marks, "hit array<int>, " + ", ".join(f"{c} int" for c in kept)).orderBy("_fold", *kept[:-1], "hit").toPandas()
    if not len(rows):
        return Chain(tuple(names), (), tuple(np.zeros(i + 1) for i in range(len(names))), learnt)
    weights = fit_chain(rows["hit"].tolist(), rows[kept[:-1]].to_numpy(float), len(terms_), rows["_fold"].to_numpy())
    return Chain(tuple(names), terms_, weights, learnt)


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """(doc_id, p_<category> ...) of every row; whole texts; null and empty texts hold no word."""
    names = [f"p_{c}" for c in chain.categories]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            p = chain.scores(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c) for c in p.T.copy()]], names=["doc_id", *names])

    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    return written(rows.mapInArrow(run, "doc_id long, " + ", ".join(f"{c} double" for c in names)), "toxicity")


def reject(docs: DataFrame, chain: Chain, category: str, at: float = 0.5) -> DataFrame:
    """The rows of `docs`, all columns, whose probability of `category` is below `at`.

    Null and empty texts stay, and every row does where the labels did not tell the category apart.
    """
    c = chain.categories.index(category)
    if not chain.learnt[c]:
        return docs

    @F.pandas_udf("double")
    def probability(text):
        return text.__class__(chain.scores([t if isinstance(t, str) else None for t in text])[:, c], index=text.index, dtype=float)

    text = F.col("text").cast("string")
    return docs.filter(text.isNull() | (text == "") | (probability(text) < at))
