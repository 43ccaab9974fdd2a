"""Ranked lexical search by scanning the documents with an automaton of all query terms.

An Aho-Corasick automaton holds every term of the items between two guards. A text is brought to
the same form, words in small letters parted by guards, and one run through it finds every
occurrence of every term, so term frequencies come straight from the text; no index of the
documents is built. The automaton's outputs are term numbers, which map to the items that hold them.

Two scans: the first sums the corpus figures (documents, words, documents of each term), the second
scores and keeps each task's best documents of each item.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.common import numbered, slices, written

#: A-Z in small letters; every other byte that no term holds becomes the guard. Bytes of 128 and more are letters.
FORM = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))

#: Terms and their items that one automaton holds, as pairs; more items are searched in rounds.
MOST_PAIRS = 1 << 20


def formed(text: str | None) -> bytes:
    """The text's UTF-8 with small letters and blanks for whatever parts terms."""
    return (text or "").encode("utf-8", "replace").translate(FORM)


def terms(text: str | None) -> set[bytes]:
    return set(formed(text).split())


#: Automata of this process by the search they belong to; a worker serves many tasks, one search at a time.
_BUILT: dict[str, ahocorasick.Automaton] = {}


class Matcher:
    """Counts terms in texts; the automaton is built once in each process, not sent."""

    def __init__(self, vocabulary: list[bytes]):
        self.vocabulary, self.key = vocabulary, uuid.uuid4().hex

    def automaton(self) -> ahocorasick.Automaton:
        if self.key not in _BUILT:
            _BUILT.clear()
            built = ahocorasick.Automaton()
            for i, term in enumerate(self.vocabulary):
                # Bytes as characters of the same number: guards and terms stay whole bytes.
                built.add_word(" " + term.decode("latin-1") + " ", i)
            built.make_automaton()
            _BUILT[self.key] = built
        return _BUILT[self.key]

    def count(self, text: str | None) -> tuple[int, np.ndarray, np.ndarray]:
        """Words of the text, and the numbers and frequencies of the terms that it holds."""
        plain = formed(text)
        n = len(plain.split())
        if not n or not self.vocabulary:
            return n, np.zeros(0, np.int64), np.zeros(0, np.int64)
        hits = np.fromiter((i for _, i in self.automaton().iter(f" {plain.decode('latin-1')} ")), np.int64)
        found, tf = np.unique(hits, return_counts=True)
        return n, found, tf


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_norm(n: int, n_docs: int, n_words: int) -> int:
    return 100 - 90 + (90 * n * n_docs) // n_words


def query_terms(items: DataFrame) -> DataFrame:
    """(item_id, term) pairs, once each; rows of one item_id are one item, and so are those without one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            pairs = [(i, t) for i, text in zip(ids, texts) for t in terms(text)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.binary())], names=["item_id", "term"])

    rows = items.selectExpr("cast(item_id as long) item_id", "cast(text as string) text")
    return rows.mapInArrow(run, "item_id long, term binary").distinct()


def figures(docs: DataFrame, matcher: Matcher) -> tuple[int, int, np.ndarray]:
    """Documents with a word, words of all documents, and the documents that hold each term."""
    size = len(matcher.vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_docs = n_words = 0
        df = np.zeros(size, np.int64)
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                n, found, _ = matcher.count(text)
                n_docs, n_words = n_docs + (n > 0), n_words + n
                df[found] += 1
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[-2, -1], some]), pa.int64()), pa.array(np.concatenate([[n_docs, n_words], df[some]]), pa.int64())], names=["i", "n"])

    # A row for each term at most.
    sums = {r["i"]: r["n"] for r in docs.mapInArrow(run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect()}
    return sums.get(-2, 0), sums.get(-1, 0), np.array([sums.get(i, 0) for i in range(size)], np.int64)


class Best:
    """The `k` best (score, doc_id) of each item met so far, at most; a null doc_id comes last among equals."""

    NONE = np.iinfo(np.int64).max

    def __init__(self, n_items: int, k: int):
        self.k, self.floor = k, np.zeros(n_items, np.int64)
        self.item, self.score, self.doc = (np.zeros(0, np.int64) for _ in range(3))
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray) -> None:
        good = (score > 0) & (score >= self.floor[item])
        self.waiting.append((item[good], score[good], doc[good]))
        self.held += int(good.sum())
        if self.held > max(50000, 2 * self.k * len(self.floor)):
            self.settle()

    def settle(self) -> None:
        item, score, doc = (np.concatenate([a, *b]) for a, b in zip((self.item, self.score, self.doc), zip(*self.waiting) if self.waiting else ((), (), ())))
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        first = np.searchsorted(item, item, "left")
        rank = np.arange(len(item)) - first
        keep = rank < self.k
        self.item, self.score, self.doc = item[keep], score[keep], doc[keep]
        last = rank == self.k - 1
        self.floor[item[last]] = score[last]
        self.waiting, self.held = [], 0


def scored(docs: DataFrame, matcher: Matcher, of_term: list[list[int]], n_items: int, corpus: tuple[int, int, np.ndarray], k: int) -> DataFrame:
    """(item, doc_id, score) of the best `k` documents of each item (a number) in each task."""
    n_docs, n_words, df = corpus
    weights = np.array([weight(n_docs, int(d)) for d in df], np.int64)
    starts = np.concatenate([[0], np.cumsum([len(o) for o in of_term])]).astype(np.int64)
    owners = np.array([i for o in of_term for i in o], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(n_items, k)
        for batch in slices(batches, 64):
            ids = batch.column(0).to_pylist()
            for doc_id, text in zip(ids, batch.column(1).to_pylist()):
                n, found, tf = matcher.count(text)
                if not len(found):
                    continue
                gain = weights[found] * ((1000000000 * tf) // (1000 * tf + 8 * length_norm(n, n_docs, n_words)))
                # Every term's items, one after the other.
                many = starts[found + 1] - starts[found]
                at = np.repeat(starts[found] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
                items, place = np.unique(owners[at], return_inverse=True)
                score = np.zeros(len(items), np.int64)
                np.add.at(score, place, np.repeat(gain, many))
                best.add(items, score, np.full(len(items), Best.NONE if doc_id is None else doc_id, np.int64))
        best.settle()
        doc = pa.array(best.doc, pa.int64(), mask=best.doc == Best.NONE)
        yield pa.RecordBatch.from_arrays([pa.array(best.item), doc, pa.array(best.score)], names=["item", "doc_id", "score"])

    return docs.mapInArrow(run, "item long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10, most_pairs: int = MOST_PAIRS) -> DataFrame:
    """The `k` best rows of `docs` for each item: item_id, rank, doc_id, score; equal scores by ascending doc_id.

    Items go in rounds of about `most_pairs` (item, term) pairs, which bounds what is collected and
    sent to the tasks; each round scans all documents. Rows of one item_id are one item with the terms
    of all of them. Items without terms, and documents without words (null, empty), take part in
    nothing. Every row of `docs` is a document of its own, also where a doc_id repeats; rows without one
    come last among equals. Other columns are not looked at.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("text").cast("string").alias("text"))
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sized = written(query_terms(items), "query-terms")
    # An item's round: the pairs of the items before it, by the bound.
    count = sized.groupBy("item_id").agg(F.count("term").alias("n"))
    dealt = numbered(count, [], ["item_id"], "query-items", ("n",)).select(
        F.col("item_id").alias("_item"), F.floor(F.col("_before_n") / most_pairs).alias("_round"))
    rounds = written(sized.join(dealt, sized["item_id"].eqNullSafe(dealt["_item"])).drop("_item"), "query-rounds")
    out = None
    for (r,) in sorted(tuple(x) for x in rounds.select("_round").distinct().collect()):
        # About `most_pairs` pairs, or those of one item.
        pairs = rounds.filter(F.col("_round") == r).select("item_id", "term").toArrow().to_pydict()
        ids = sorted(set(pairs["item_id"]), key=lambda i: (i is None, i))
        vocabulary = sorted(set(pairs["term"]))
        item_at, term_at = ({x: i for i, x in enumerate(known)} for known in (ids, vocabulary))
        of_term: list[list[int]] = [[] for _ in vocabulary]
        for i, t in zip(pairs["item_id"], pairs["term"]):
            of_term[term_at[t]].append(item_at[i])
        matcher = Matcher(vocabulary)
        best = scored(named, matcher, of_term, len(ids), figures(texts, matcher), k)
        names = spark.createDataFrame([*enumerate(ids)], "item long, item_id long")
        part = written(best, "best").join(names, "item").select("item", "item_id", "doc_id", "score")
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
        part = part.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
