"""Quality scores: random Fourier features over document statistics, ridge regression, isotonic calibration."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import written
from tradeloom.llm.textstats import COUNTS, text_counts

_RATIOS = (
    ("word_chars", "n_words"), ("n_symbols", "n_words"), ("n_dup_lines", "n_lines"), ("n_repeat_words", "n_words"),
    ("n_lines", "n_words"), ("n_distinct", "n_words"), ("n_upper", "n_letters"), ("n_letters", "n_chars"), ("n_digits", "n_chars"),
    ("n_marks", "n_words"), ("n_ends", "n_words"), ("n_runs", "n_words"), ("n_short", "n_words"), ("n_tails", "n_words"),
    ("n_symbols", "word_chars"),
)
FEATURES = 2 + len(_RATIOS)


def features(counts: np.ndarray) -> np.ndarray:
    """Statistics of documents from their counts (columns in the order of COUNTS); all finite."""
    of = dict(zip(COUNTS, counts.T.astype(float)))
    return np.stack([np.log1p(of["n_words"]), np.log1p(of["longest"]), *[of[a] / np.maximum(of[b], 1) for a, b in _RATIOS]], 1)


@dataclass(frozen=True)
class Model:
    """Scaling, Fourier features, ridge weights and the calibration's points."""

    mean: np.ndarray
    scale: np.ndarray
    freq: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    points: np.ndarray
    values: np.ndarray

    def fourier(self, counts: np.ndarray) -> np.ndarray:
        return fourier(counts, self.mean, self.scale, self.freq, self.phase)

    def raw(self, counts: np.ndarray) -> np.ndarray:
        return self.fourier(counts) @ self.weights

    def score(self, counts: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(counts), self.points, self.values), 0, 1)


def fourier(counts: np.ndarray, mean: np.ndarray, scale: np.ndarray, freq: np.ndarray, phase: np.ndarray) -> np.ndarray:
    """sqrt(2 / D) cos(w x + b), and a constant: inner products approximate a Gaussian kernel."""
    x = np.clip((features(counts) - mean) / scale, -6, 6)
    z = np.cos(x @ freq.T + phase) * np.sqrt(2 / len(phase))
    return np.column_stack([z, np.ones(len(x))])


def isotonic(x: np.ndarray, n: np.ndarray, good: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centres and means of the pooled blocks of a non-decreasing fit to good / n at the sorted x."""
    blocks: list[list[float]] = []
    for a, b, c in zip(x, n, good):
        blocks.append([a * b, float(b), float(c)])
        while len(blocks) > 1 and blocks[-2][2] / blocks[-2][1] >= blocks[-1][2] / blocks[-1][1]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    return np.array([b[0] / b[1] for b in blocks]), np.array([b[2] / b[1] for b in blocks])


def fold(key: Column) -> Column:
    """crc32 of the id as text, modulo 5; of a null id that of the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5


def _batch(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in COUNTS], 1).reshape(-1, len(COUNTS))


def train(rows: DataFrame, labels: DataFrame, width: int = 256, gamma: float = 0.03, ridge: float = 1e-3, seed: int = 11) -> Model | None:
    """Model from the counts `rows` (doc_id, COUNTS) and `labels` (doc_id, quality); None without labelled rows.

    Rows of fold 0 are never learnt from; fold 4 calibrates, folds 1 to 3 fit. Every labelled row
    takes part: a partition adds up its share of the normal equations, and only sums, of a size set
    by `width`, are shuffled and reach the driver. Null labels are no labels; where they repeat
    for a document, their mean counts.
    """
    marks = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("double").alias("_y")).dropna().groupBy("_id").agg(
        F.avg("_y").alias("_y"))
    known = written(rows.join(marks, F.col("doc_id") == F.col("_id")).withColumn("_fold", fold(F.col("doc_id"))).filter("_fold != 0").drop("_id"),
                    "labelled")
    rng = np.random.default_rng(seed)
    freq, phase = rng.standard_normal((width, FEATURES)) * np.sqrt(2 * gamma), rng.uniform(0, 2 * np.pi, width)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, FEATURES))
        for batch in batches:
            x = features(_batch(batch))
            total += [np.full(FEATURES, len(x)), x.sum(0), (x * x).sum(0)]
        yield pa.RecordBatch.from_arrays([pa.array(range(FEATURES), pa.int32()), *[pa.array(t) for t in total]], names=["i", "n", "s", "q"])

    sums = known.mapInArrow(moments, "i int, n double, s double, q double").groupBy("i").agg(F.sum("n"), F.sum("s"), F.sum("q")).orderBy("i").collect()
    if not sums or not sums[0][1]:
        return None
    n, s, q = np.array([r[1:] for r in sums]).T
    mean, scale = s / n, np.maximum(np.sqrt(np.maximum(q / n - (s / n) ** 2, 0)), 1e-6)

    def equations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = np.zeros((width + 1, width + 2))
        for batch in batches:
            fit = batch.column("_fold").to_numpy() != 4
            z = fourier(_batch(batch)[fit], mean, scale, freq, phase)
            a += z.T @ np.column_stack([z, batch.column("_y").to_numpy()[fit]])
        yield pa.RecordBatch.from_arrays([pa.array(range(width + 1), pa.int32()), pa.array([r.tobytes() for r in a])], names=["i", "row"])

    def add(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": [key[0]], "row": [np.sum([np.frombuffer(r) for r in part["row"]], 0).tobytes()]})

    # A task sends width + 1 rows; the sums are made row by row of the matrix.
    summed = known.mapInArrow(equations, "i int, row binary").groupBy("i").applyInPandas(add, "i int, row binary").orderBy("i").collect()
    a = np.stack([np.frombuffer(r["row"]) for r in summed])
    rows_fit = max(a[-1, -2], 1.0)
    weights = np.linalg.solve(a[:, :-1] / rows_fit + ridge * np.eye(width + 1) / (width + 1), a[:, -1] / rows_fit)
    plain = Model(mean, scale, freq, phase, weights, np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(plain.raw(_batch(batch))), batch.column("_y")], names=["raw", "y"])

    # Scores in steps of a thousandth, so the calibration sees at most 3000 sums.
    step = F.round(F.greatest(F.least("raw", F.lit(2.0)), F.lit(-1.0)), 3)
    bins = known.filter("_fold = 4").mapInArrow(raw, "raw double, y double").groupBy(step.alias("x")).agg(
        F.count("*").alias("n"), F.sum("y").alias("good")).orderBy("x").collect()
    if not bins:
        return plain
    x, n, good = (np.array([r[c] for r in bins], float) for c in ("x", "n", "good"))
    points, values = isotonic(x, n, good)
    # Ends lie apart, so equal extremes keep their order.
    points = np.concatenate([[min(-1.0, points[0] - 1)], points, [max(2.0, points[-1] + 1)]])
    values = np.concatenate([[values[0] * 0.5], values, [(1 + values[-1]) / 2]])
    return Model(mean, scale, freq, phase, weights, points, values)


def quality(docs: DataFrame, labels: DataFrame, at: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of `docs`, from the whole text alone.

    Null and empty texts have counts of 0 and get a score like others. Repeated rows and null ids
    come out as they go in. Without any label the score is one half.
    """
    rows = written(text_counts(docs), "counts")
    model = train(rows, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = model.score(_batch(batch)) if model else np.full(batch.num_rows, 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(p)], names=["doc_id", "score"])

    scored = rows.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= at).cast("int").alias("predicted"))
