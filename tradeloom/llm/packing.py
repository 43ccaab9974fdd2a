"""Packing documents into sequences by a grouping genetic algorithm on islands."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.common import in_executor, slices, written

PIECES = "doc_id long, piece int, start long, length long, ids binary"

#: Characters of scripts on which both vocabularies' splitters agree by construction; other texts
#: go to the slower library. So do texts that hold the name of a special token.
_PLAIN = re.compile("[^\x00-ɏ‐-‧‰-⁞₠-₿]|<\\|endoftext\\|>")


@cache
def encoder(path: str, ranks: str | None):
    """text -> ids of the vocabulary file at `path`, without special tokens added.

    `ranks` names the same vocabulary as ranks; with it, plain texts take about a fifth of the time.
    """
    in_executor()
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    encode = lambda text: slow.encode(text, add_special_tokens=False).ids
    if ranks is None:
        return encode
    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    return lambda text: encode(text) if _PLAIN.search(text) else fast.encode_ordinary(text)


def cut(n: int, most: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: one, or full pieces behind a first that may be shorter."""
    if n <= most:
        return [(0, n)]
    first = n % most
    return ([(0, first)] if first else []) + [(i, most) for i in range(first, n, most)]


def tokenize(docs: DataFrame, path: str, ranks: str | None = None, most: int = 2048, end: int = 0) -> DataFrame:
    """Pieces of every row of `docs`: ids of the text (null: empty), then the id `end`; little-endian 32 bit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, ranks)
        for batch in slices(batches):
            out: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.array([*encode(text or ""), end], "<u4")
                for k, (start, length) in enumerate(cut(len(ids), most)):
                    for to, x in zip(out, (doc_id, k, start, length, ids[start:start + length].tobytes())):
                        to.append(x)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds)],
                                             names=["doc_id", "piece", "start", "length", "ids"])

    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(run, PIECES)


class Bins:
    """Bins of one solution while items are put in: open gaps as a bit set, for best fit in one step."""

    def __init__(self, sizes: np.ndarray, cap: int):
        self.sizes, self.cap, self.bin_of = sizes, cap, np.full(len(sizes), -1, np.int64)
        self.n, self.mask, self.at = 0, 0, [[] for _ in range(cap + 1)]

    def keep(self, bin_of: np.ndarray, items: np.ndarray) -> None:
        """Take over `items` with their bins, renumbered behind those there are."""
        names, new = np.unique(bin_of[items], return_inverse=True)
        self.bin_of[items] = new + self.n
        gaps = self.cap - np.bincount(new, self.sizes[items], len(names)).astype(np.int64)
        for k, gap in enumerate(gaps.tolist(), self.n):
            if gap > 0:
                self.at[gap].append(k)
                self.mask |= 1 << gap
        self.n += len(names)

    def fit(self, items: np.ndarray) -> None:
        """Best fit: each item, in the order given, goes where it leaves the smallest gap."""
        at, mask, n, sizes, to = self.at, self.mask, self.n, self.sizes[items].tolist(), []
        for size in sizes:
            fits = mask >> size
            if fits:
                gap = size + (fits & -fits).bit_length() - 1
                k = at[gap].pop()
                if not at[gap]:
                    mask &= ~(1 << gap)
            else:
                gap, k, n = self.cap, n, n + 1
            to.append(k)
            if gap > size:
                at[gap - size].append(k)
                mask |= 1 << (gap - size)
        self.bin_of[items], self.mask, self.n = to, mask, n


def fills(bin_of: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.bincount(bin_of, sizes)


def bound(sizes: np.ndarray, cap: int) -> int:
    """Bins that no solution can do without.

    Items above half a bin lie apart. For each a up to half a bin, those above cap - a take no item of size a or more,
    so the items from a to a half must go into what the other large ones leave or into further bins.
    """
    if not len(sizes):
        return 0
    number = np.bincount(sizes, minlength=cap + 1)
    count, total = (np.concatenate([[0], np.cumsum(x)]) for x in (number, number * np.arange(cap + 1)))
    a, half = np.arange(cap // 2 + 1), cap // 2 + 1  # below index i: sizes less than i
    large = count[cap + 1] - count[half]
    fitting = count[cap - a + 1] - count[half]
    left = fitting * cap - (total[cap - a + 1] - total[half])
    middle = total[half] - total[a]
    return int(large + np.maximum(0, -(-(middle - left) // cap)).max())


def fitness(bin_of: np.ndarray, sizes: np.ndarray, cap: int) -> float:
    """Mean of the eighth power of the fill, from 0 to 1: solutions of many full bins, whose crossing saves others."""
    return float(np.mean((fills(bin_of, sizes) / cap) ** 8))


def worth(bin_of: np.ndarray, sizes: np.ndarray, cap: int) -> float:
    """Fewer bins are better, and of as many, the fitter ones."""
    return fitness(bin_of, sizes, cap) - len(fills(bin_of, sizes)) if len(sizes) else 0.0


def blurred(sizes: np.ndarray, rng: np.random.Generator, noise: float) -> np.ndarray:
    """Decreasing order of sizes that are blurred by `noise`."""
    return np.argsort(-sizes * (1 + noise * rng.random(len(sizes))), kind="stable")


def fresh(sizes: np.ndarray, cap: int, rng: np.random.Generator, noise: float) -> np.ndarray:
    """Best fit in decreasing order of blurred sizes."""
    bins = Bins(sizes, cap)
    bins.fit(blurred(sizes, rng, noise))
    return bins.bin_of


def cross(a: np.ndarray, b: np.ndarray, sizes: np.ndarray, cap: int, rng: np.random.Generator) -> np.ndarray:
    """Child of `a` with well-filled bins of `b`.

    Bins of `a` that share a document with an injected bin go; their other documents are displaced
    and, like those of a share of the emptiest bins, put back by best fit, the largest about first. How
    many bins go and how far the order is blurred is drawn anew for every child.
    """
    fill_a, fill_b = fills(a, sizes), fills(b, sizes)
    full = np.flatnonzero(fill_b >= np.quantile(fill_b, 0.9))
    inject = np.zeros(len(fill_b), bool)
    inject[rng.choice(full, max(1, len(full) // 2), replace=False)] = True
    new = inject[b]
    gone = np.zeros(len(fill_a), bool)
    gone[a[new]] = True
    gone |= (fill_a < np.quantile(fill_a, 0.3 * rng.random())) & (rng.random(len(fill_a)) < 0.7)
    bins = Bins(sizes, cap)
    bins.keep(b, np.flatnonzero(new))
    bins.keep(a, np.flatnonzero(~gone[a] & ~new))
    rest = np.flatnonzero(gone[a] & ~new)
    bins.fit(rest[blurred(sizes[rest], rng, 2 * rng.random())])
    return bins.bin_of


def evolve(sizes: np.ndarray, cap: int, seed: int, elites: list[np.ndarray], size: int = 8, steps: int = 150) -> np.ndarray:
    """Best solution met by a steady population in `steps` crossovers, or at once when no bin can be saved.

    Never worse than any of `elites` nor, without them, than best fit decreasing.
    """
    rng, least = np.random.default_rng(seed), bound(sizes, cap)
    people = list(elites)
    for i in range(size - len(elites)):
        people.append(fresh(sizes, cap, rng, 0.3 * i if not elites else 0.3 * (i + 1)))
        if people[-1].max(initial=-1) + 1 <= least:
            return people[-1]
    score = [fitness(p, sizes, cap) for p in people]
    best = max(people, key=lambda p: worth(p, sizes, cap))
    for _ in range(steps):
        if best.max(initial=-1) + 1 <= least:
            break
        i, j = rng.choice(size, 2, replace=False)
        if score[i] < score[j]:
            i, j = j, i
        child = cross(people[i], people[j], sizes, cap, rng)
        worst, got = int(np.argmin(score)), fitness(child, sizes, cap)
        if got > score[worst]:
            people[worst], score[worst] = child, got
            best = max(best, child, key=lambda p: worth(p, sizes, cap))
    return best


def assign(items: DataFrame, cap: int = 2048, shard_items: int = 16384, islands: int = 3, epochs: int = 3) -> DataFrame:
    """(item, sequence_id, offset) for the rows (item, length) of `items`, lengths 1 to `cap`.

    Items of full length are sequences of their own. The others are dealt by a hash into shards of
    about `shard_items`, so no task grows with the input. A shard is evolved by several islands
    with populations of their own; after an epoch each island's best solution moves to the next
    island of the shard, where it joins the population. The best island's solution is taken.
    Items are told apart by `item`, which must be unique. An empty table gives an empty one.
    """
    full = items.filter(F.col("length") >= cap).select("item", (-1 - F.col("item")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    small = items.filter(F.col("length") < cap)
    shards = max(1, -(-small.count() // shard_items))
    shard = F.pmod(F.xxhash64("item"), F.lit(shards))
    state = small.select("item", "length", shard.alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"))
    state = state.withColumns({"own": F.lit(None).cast("long"), "guest": F.lit(None).cast("long")})
    schema = "item long, length long, shard long, island int, own long, score double"

    def epoch_of(epoch: int):
        def step(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values("item", ignore_index=True)
            sizes = rows["length"].to_numpy(np.int64)
            elites = [rows[c].to_numpy(np.int64) for c in ("own", "guest") if rows[c].notna().all()]
            best = evolve(sizes, cap, int(key[0]) * 1000 + int(key[1]) * 10 + epoch, elites)
            return rows[["item", "length", "shard", "island"]].assign(own=best, score=worth(best, sizes, cap))

        return step

    for epoch in range(epochs):
        state = written(state.groupBy("shard", "island").applyInPandas(epoch_of(epoch), schema), "islands")
        if epoch + 1 < epochs:
            guest = state.select(F.col("item").alias("g_item"), F.pmod(F.col("island") + 1, F.lit(islands)).cast("int").alias("g_island"),
                                 F.col("own").alias("guest"))
            state = state.drop("score").join(guest, (F.col("item") == F.col("g_item")) & (F.col("island") == F.col("g_island"))).drop(
                "g_item", "g_island")
    # One row for each shard and island.
    best = state.groupBy("shard", "island").agg(F.max("score").alias("score")).groupBy("shard").agg(
        F.max_by(F.col("island"), F.struct("score", -F.col("island"))).alias("island"))
    taken = state.join(best, ["shard", "island"])
    before = Window.partitionBy("shard", "own").orderBy("item").rowsBetween(Window.unboundedPreceding, -1)
    packed = taken.select("item", (F.col("shard") * (1 << 24) + F.col("own")).alias("sequence_id"),
                          F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"))
    return full.unionByName(packed)


def pack(pieces: DataFrame, cap: int = 2048) -> DataFrame:
    """`pieces` (rows with a length of 1 to `cap`) with `sequence_id` and `offset`: gapless from 0.

    The pieces are written once with a row number, as repeated documents are rows of their own.
    """
    rows = written(pieces.withColumn("_item", F.monotonically_increasing_id()), "pieces")
    where = assign(rows.select(F.col("_item").alias("item"), "length"), cap)
    return rows.join(where, F.col("_item") == F.col("item")).drop("_item", "item")
