"""Counts over whole texts, one pass per document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tradeloom.llm.common import slices

COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars", "n_lines", "n_distinct", "n_upper",
    "n_letters", "n_digits", "n_marks", "n_ends", "n_runs", "n_short", "longest", "n_tails",
]
SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)

_SPACE = np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8)
_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
_MARKS = np.frombuffer(b".,;:!?", np.uint8)
_STEPS = np.cumprod(np.full(8, 0x9E3779B97F4A7C15, np.uint64))


def repeat_words(words: list[bytes], window: int = 8) -> int:
    """Words inside `window`-word stretches that occur twice or more in the text, the first included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    x = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    h = np.zeros(n, np.uint64)
    for k in range(window):
        h += x[k:k + n] * _STEPS[k]
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    if not same.any():
        return 0
    maybe = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
    # Equal stretches have equal hashes; the reverse is checked on the words themselves.
    seen: dict[tuple, list[int]] = {}
    for i in maybe.tolist():
        seen.setdefault(tuple(words[i:i + window]), []).append(i)
    step = np.zeros(len(words) + 1, np.int64)
    at = np.array([i for places in seen.values() if len(places) > 1 for i in places], np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + window, -1)
    return int(np.count_nonzero(np.cumsum(step)))


def counts(text: str | None) -> list[int]:
    """The numbers named in COUNTS; all 0 for null or empty text (`n_lines` is 1 for empty text)."""
    if text is None:
        return [0] * len(COUNTS)
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    of = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    lines, seen, repeated = text.split("\n"), set(), 0
    for line in lines:
        if line in seen:
            repeated += bool(line.encode("utf-8", "replace").split())
        else:
            seen.add(line)
    n_space, wide = int(of[_SPACE].sum()), int(of[192:].sum())
    letters = int(of[65:91].sum() + of[97:123].sum()) + wide
    return [
        len(words), len(text) - n_space, int(of[_SYMBOLS].sum()), repeated, repeat_words(words), len(text), len(lines),
        len(set(words)), int(of[65:91].sum()), letters, int(of[48:58].sum()), int(of[_MARKS].sum()),
        sum(w[-1] in b".!?" for w in words), sum(a == b for a, b in zip(words, words[1:])), sum(len(w) < 4 for w in words),
        max(map(len, words), default=0), sum(w[-1] in b"#*$%&|<>" for w in words),
    ]


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        rows = np.array([counts(t) for t in batch.column(1).to_pylist()], np.int64).reshape(-1, len(COUNTS))
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c) for c in rows.T.copy()]], names=["doc_id", *COUNTS])


def text_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, counts) of every row of `docs`, whole texts, in its order; other columns are not read."""
    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(_batches, SCHEMA)
