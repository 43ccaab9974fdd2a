"""Spelling variants: words one edit apart, found through a reduced alphabet.

Letters are hashed to a few symbols. Two words one edit apart are, once reduced, equal or one edit
apart, so each word joins the full one-edit neighbourhood of its reduced form with the reduced
vocabulary; the partners are then compared letter by letter. With few symbols a neighbourhood is
small and needs no alphabet of real letters; with many, fewer chance partners remain. The number of
symbols follows the size of the vocabulary.

Reduced words are 64 bit numbers (a polynomial in an odd base), so that the neighbours of many
words are made at once: a chance collision costs one comparison and loses nothing.

Joins are merged, never broadcast: Spark takes the packed words for the size of their neighbourhoods,
which are many times as large, and would gather them in the driver as long as the words are few enough.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import slices, written

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
SPREAD = 0xD6E8FEB86659FD93

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

#: Words counted in a task before they are passed on.
HELD = 200000

#: The bit map of reduced words has 16 bits for each of them, and no more than this power of two (32 MB).
MOST_BITS = 28


def vocabulary(docs: DataFrame, length: int = 6, least: int = 5, every: int = 199) -> DataFrame:
    """(word, n): runs of letters of `length` code points or more that occur `least` times or more.

    Where `every` divides the checksum of `<doc_id>:<run>`, the run loses the letter at that checksum
    modulo its length first. A null doc_id is spelled as nothing, a null text has no runs; repeated rows
    count each.
    """
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % length)

    def batch_of(total: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in slices(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                head = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for word, n in Counter(runs.findall(text.encode().translate(LOWER).decode())).items():
                    h = zlib.crc32(word.encode(), head)
                    if h % every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < length:
                            continue
                    total[word] += n
            if len(total) > HELD:
                yield batch_of(total)
                total = Counter()
        yield batch_of(total)

    rows = docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text")
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def symbols_for(n_words: int, mean_length: float) -> int:
    """So many symbols that words of the mean length have clearly more reduced forms than there are words."""
    return int(min(32, max(2, np.ceil(1.5 * max(n_words, 1) ** (1 / max(mean_length, 1.0))))))


def alphabet(words: DataFrame, symbols: int) -> dict[str, int]:
    """Symbol (1 to `symbols`) of each letter: the next letter by frequency goes to the symbol used least."""
    letters = words.select(F.explode(F.split("word", "")).alias("c")).groupBy("c").count().orderBy(F.desc("count"), "c")
    load, out = [0] * symbols, {}
    for c, n in letters.collect():  # no more rows than the runs' pattern has letters
        at = min(range(symbols), key=lambda i: load[i])
        out[c], load[at] = at + 1, load[at] + n
    return out


def reduced(words: list[str], symbol: dict[str, int]) -> np.ndarray:
    """Symbols of words of one length, a row each."""
    letters = np.array(words, f"U{len(words[0])}").view(np.uint32).reshape(len(words), -1)
    of = np.zeros(int(letters.max()) + 1, np.uint64)
    for c, s in symbol.items():
        if ord(c) < len(of):
            of[ord(c)] = s
    return of[letters]


def powers(n: int) -> np.ndarray:
    return np.array([pow(BASE, i, 1 << 64) for i in range(n)], np.uint64)


def codes(r: np.ndarray) -> np.ndarray:
    """Number of each reduced word: the sum of its symbols times the powers of the base, modulo 2 ** 64."""
    return (r * powers(r.shape[1])).sum(axis=1, dtype=np.uint64)


def neighbours(r: np.ndarray, symbols: int) -> np.ndarray:
    """Numbers of the reduced words at most one edit away from each row of `r`; a row may name one more than once."""
    n, size = r.shape
    p, a = powers(size + 1), np.arange(1, symbols + 1, dtype=np.uint64)
    before = np.zeros((n, size + 1), np.uint64)
    before[:, 1:] = np.cumsum(r * p[:size], axis=1, dtype=np.uint64)
    whole = before[:, -1:]
    other = whole[:, :, None] + (a - r[:, :, None]) * p[:size, None]
    fewer = before[:, :-1] + (whole - before[:, 1:]) * np.uint64(INVERSE)
    more = (before + (whole - before) * np.uint64(BASE))[:, :, None] + a * p[:, None]
    return np.concatenate([whole, other.reshape(n, -1), fewer, more.reshape(n, -1)], axis=1)


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Places and words of each length."""
    sizes = np.array([len(w) for w in words])
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        yield at, [words[i] for i in at]


def place(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys * np.uint64(SPREAD)) >> np.uint64(64 - bits)


def bit_map(keyed: DataFrame, n_words: int) -> tuple[int, np.ndarray]:
    """Bits of the reduced vocabulary, sized by its count; a bit that is not set has no reduced word."""
    bits = min(MOST_BITS, max(10, int(np.ceil(np.log2(16 * max(n_words, 1))))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = place(batch.column(0).to_numpy().view(np.uint64), bits)
            yield pa.RecordBatch.from_arrays([
                pa.array((at >> np.uint64(6)).view(np.int64)), pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], names=["i", "b"])

    rows = keyed.select("key").mapInArrow(run, "i long, b long").groupBy("i").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[rows["i"].to_numpy()] = rows["b"].to_numpy().view(np.uint64)
    return bits, out


def near(words: DataFrame, symbols: int | None = None) -> DataFrame:
    """(word, n, other, other_n) for every two of `words` (word, n) that are one edit apart, both ways round."""
    size = words.agg(F.count("word"), F.coalesce(F.avg(F.length("word")), F.lit(1.0))).first()
    symbols = symbols or symbols_for(size[0], size[1])
    symbol = alphabet(words, symbols)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, all_words = np.zeros(batch.num_rows, np.uint64), batch.column(0).to_pylist()
            for at, some in by_length(all_words):
                key[at] = codes(reduced(some, symbol))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), batch.column(0), batch.column(1)], names=["key", "word", "n"])

    keyed = written(words.select("word", "n").mapInArrow(keys, "key long, word string, n long"), "reduced", 10000)
    bits, known = bit_map(keyed, size[0])

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            for at, some in by_length(batch.column(0).to_pylist()):
                made = np.sort(neighbours(reduced(some, symbol), symbols), axis=1)
                b = place(made, bits)
                good = (known[b >> np.uint64(6)] >> (b & np.uint64(63))) & np.uint64(1) == 1
                good[:, 1:] &= made[:, 1:] != made[:, :-1]
                row = pa.array(at[np.nonzero(good)[0]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made[good].view(np.int64)), batch.column(0).take(row), batch.column(1).take(row)], names=["key", "word", "n"])

    made = words.select("word", "n").mapInArrow(around, "key long, word string, n long")
    met = made.join(keyed.toDF("key", "other", "other_n").hint("merge"), "key")
    return met.filter(one_edit("word", "other")).select("word", "n", "other", "other_n")


def one_edit(a: str, b: str) -> Column:
    return F.levenshtein(F.col(a), F.col(b), 1) == 1


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of each word of `forms` (word, form): the form's form and so on, to the last.

    Each round doubles the steps that a word has gone and ends in a written table.
    """
    now = written(forms.toDF("word", "root"), "roots")
    while True:
        step = now.toDF("_w", "_r")
        further = now.join(step.hint("merge"), now["root"] == step["_w"], "left")
        if not further.filter("_r is not null").limit(1).count():
            return now
        now = written(further.select("word", F.coalesce("_r", "root").alias("root")), "roots")


def variants(words: DataFrame, times: int = 5, symbols: int | None = None) -> DataFrame:
    """`words` (word, n; distinct, not null, not empty) with form, root, n_near and form_n.

    n_near counts the words one edit away. The form is the one of them that occurs most (of equal ones
    the first by code points), if it occurs `times` as often as the word or more. The root follows
    the forms to the last one, and is the word itself where it has none; as `times` is above 1, counts
    grow along the way and no word comes twice.
    """
    if times <= 1:
        raise ValueError("times must be above 1")
    words = written(words.select("word", "n"), "words")
    best = near(words, symbols).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("w"))).alias("b"))
    joined = words.join(best.hint("merge"), "word", "left")
    good = -F.col("b.n") >= times * F.col("n")
    formed = written(joined.select(
        "word", "n", F.when(good, F.col("b.w")).alias("form"), F.when(good, -F.col("b.n")).alias("form_n"), F.coalesce("n_near", F.lit(0)).alias("n_near")), "forms")
    root = roots(formed.filter("form is not null").select("word", "form"))
    return formed.join(root.hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
