"""N-gram Jaccard join: which documents share nearly all of their word n-grams.

A size-aware join. The n-grams of all sets have one order, and a set's k-prefix is its first
n - ceil(t n) + k ones: two linked sets share at least k n-grams inside both k-prefixes.

* Light sets (n up to a boundary) are joined on the 2-subsets of their 2-prefix. There are few for
  a small set, and unrelated texts hardly share one.
* Heavy sets have too many subsets. They scan the inverted lists of the single n-grams of all
  1-prefixes, light ones near the boundary included. What two sets share of their prefixes bounds
  their overlap: the count c plus what lies outside the prefix must reach what the threshold asks.

The boundary is the one with the least rows to enumerate and scan, by the histogram of set sizes.

Equal sets are one node. First each node is checked against one partner only, the node it meets most
as the heaviest of a list, so groups of copies become components without making all their pairs.
Then all pairs of one list that lie in different components are counted and checked, which finds
every link that can still matter.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import slices, written
from tradeloom.llm.components import stars

_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63,
                  0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0xBF58476D1CE4E5B9], np.uint64)


def shingles(text: str | None, n: int = 4) -> np.ndarray:
    """Sorted 64 bit hashes of the distinct word n-grams; A-Z in small letters.

    A text with fewer words has its whole sequence as one; a text without words has none. Two
    different n-grams get one hash with a chance of 2 ** -64.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.int64)
    x = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    k = min(n, len(words))
    h = np.full(len(words) - k + 1, k, np.uint64)
    for i in range(k):
        h += (x[i:len(words) - k + 1 + i] ^ _MULT[i]) * _MULT[i]
    h = (h ^ (h >> np.uint64(31))) * _MULT[7]
    return np.unique((h ^ (h >> np.uint64(29))).view(np.int64))


def _texts(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))


def common_shingles(docs: DataFrame, n: int, rare: int = 2000) -> np.ndarray:
    """n-grams in about one of `rare` documents or more; they come last in the order.

    Some 8,000 rows at a time are counted by themselves, equal sets once, and n-grams that they hold
    only once are left out of the count. The order decides how long lists get, never what is linked. At
    most `rare` times the mean size of a set are returned, however many documents there are.
    """
    def counted(seen: dict[bytes, np.ndarray]) -> Iterator[pa.RecordBatch]:
        of = np.concatenate([*seen.values(), np.zeros(0, np.int64)])
        for k in range(4):  # a quarter of the hashes at a time takes a quarter of the room
            tokens, times = np.unique(of[of & 3 == k], return_counts=True)
            often = times > 1
            many = np.append(np.zeros(often.sum(), np.int64), len(seen) if k == 0 else 0).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(tokens[often], 0)), pa.array(np.append(times[often], 0).astype(np.int64)), pa.array(many)],
                names=["token", "times", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, np.ndarray] = {}
        size = 0
        for part in slices(batches):
            for text in part.column(0).to_pylist():
                s = shingles(text, n)
                if seen.setdefault(xxhash.xxh3_128_digest(s.tobytes()), s) is s:
                    size += len(s)
            if len(seen) >= 8000 or size >= 4_000_000:
                yield from counted(seen)
                seen, size = {}, 0
        yield from counted(seen)

    counts = written(docs.select(F.col("text").cast("string")).mapInArrow(run, "token long, times long, docs long"), "often")
    total = counts.agg(F.sum("docs")).first()[0] or 0
    often = counts.groupBy("token").agg(F.sum("times").alias("times")).filter(F.col("times") >= max(50, total // rare))
    return np.sort(np.array([r[0] for r in often.select("token").collect()], np.int64))


def prefixes(docs: DataFrame, common: np.ndarray, n: int, percent: int) -> DataFrame:
    """(doc_id, th, sig1, sig2, n, prefix, last) of every row: hash of the text, of the set, its size, its 2-prefix,
    and where its 1-prefix ends in the order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out: list[list] = [[], [], [], [], []]
            for text in batch.column(2).to_pylist():
                s = shingles(text, n)
                sig = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
                last = common[np.minimum(np.searchsorted(common, s), len(common) - 1)] == s if len(common) else np.zeros(len(s), bool)
                size = len(s) - (percent * len(s) + 99) // 100 + 2
                prefix = np.concatenate([s[~last], s[last]])[:size]
                # The 1-prefix has one n-gram less.
                end = {"common": len(s) - int(last.sum()) < size - 1, "token": int(prefix[size - 2])} if len(s) else None
                for to, x in zip(out, (int(sig[0]), int(sig[1]), len(s), prefix, end)):
                    to.append(x)
            kinds = (*[pa.int64()] * 3, pa.list_(pa.int64()), pa.struct([("common", pa.bool_()), ("token", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(x, t) for x, t in zip(out, kinds)]],
                                             names=["doc_id", "th", "sig1", "sig2", "n", "prefix", "last"])

    return _texts(docs).mapInArrow(
        run, "doc_id long, th long, sig1 long, sig2 long, n long, prefix array<long>, last struct<common:boolean,token:long>")


#: Of the shared n-grams that a link needs in a prefix, one in so many is not looked for when pairs are made.
SKIPPED = 2

#: Nodes of one list that a task pairs with the rest of it.
LIST_BLOCK = 512

#: Sets up to this size are measured as light ones at first, larger ones where that may pay.
FIRST_LIGHT = 64

#: Costs are those of one key in so many.
SAMPLED = 64


def list_keys(prefix: np.ndarray, n: int, percent: int, x: int | None, upto: int = FIRST_LIGHT) -> tuple[np.ndarray, np.ndarray]:
    """(subset keys, single keys) under which a set of size n with this 2-prefix is listed, for boundary x.

    Without a boundary both kinds are made, subsets for sizes up to `upto`, for measuring. Sets below 6 n-grams (at 85 percent) link
    with equal ones only, which are one node already, and are listed nowhere.
    """
    none = prefix[:0]
    if n * (100 - percent) < percent:
        return none, none
    two = none
    if n <= (upto if x is None else x):
        i, j = np.triu_indices(len(prefix), 1)
        u = prefix.view(np.uint64)
        two = ((u[i] * _MULT[0]) ^ ((u[j] + _MULT[1]) * _MULT[2])).view(np.int64)
    near = x is None or 100 * n >= percent * (x + 1)
    return two, prefix[:n - (percent * n + 99) // 100 + 1] if near else none


def listed(rows: DataFrame, percent: int, x: int | None, keep, upto: int = FIRST_LIGHT) -> DataFrame:
    """(key, light, row, n, pos) of the lists of `rows`; `pos` is the place of a single n-gram in its prefix.

    `keep` says by numpy which keys to send on.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for row, n, prefix in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                for light, keys in zip((True, False), list_keys(prefix.values.to_numpy(), n, percent, x, upto)):
                    pos = np.flatnonzero(keep(keys))
                    for to, v in zip(out, (keys[pos], np.full(len(pos), light), np.full(len(pos), row), np.full(len(pos), n), pos)):
                        to.append(v)
            kinds = (np.int64, bool, np.int64, np.int64, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, t), *v])) for v, t in zip(out, kinds)],
                                             names=["key", "light", "row", "n", "pos"])

    return rows.filter("n > 0").select("row", "n", "prefix").mapInArrow(run, "key long, light boolean, row long, n long, pos long")


def subsets(n: int, percent: int) -> int:
    """2-subsets of the 2-prefix of a set of size n."""
    k = n - (percent * n + 99) // 100 + 2
    return k * (k - 1) // 2


def boundary(pairs: dict[int, float], scans: dict[int, float], percent: int) -> int:
    """Largest size of a light set, 0 for none; costs by size.

    `pairs`: rows met in the lists of 2-subsets; `scans`: rows met in those of single n-grams. Light
    sets that a heavy one may link with are in both, which the cost of a boundary counts.
    """
    best, least, light = 0, sum(scans.values()), 0.0
    by_size = sorted(scans)
    left = np.concatenate([np.cumsum([scans[n] for n in by_size][::-1])[::-1], [0.0]])
    for x in sorted({*pairs, *scans}):
        light += pairs.get(x, 0.0)
        # Singles are scanned by sizes n with 100 n >= percent (x + 1).
        cost = light + left[bisect_left(by_size, -(-percent * (x + 1) // 100))]
        if cost < least:
            best, least = x, cost
    return best


def measured(rows: DataFrame, percent: int, first: int = FIRST_LIGHT) -> int:
    """The boundary by the lists of one key in 64, over all rows.

    Any size may be the boundary. Subsets are listed up to the size `first`; larger sets count with
    what they cost at least, each subset meeting its own row. Only where a boundary could pay even so
    are larger sets listed, up to twice that size, and so on; then of so few keys that about one row a
    set is listed. One number for each size is collected.
    """
    many = {r["n"]: r["c"] for r in rows.filter("n > 0").groupBy("n").agg(F.count("*").alias("c")).collect()}
    fewest = {n: c * subsets(n, percent) / SAMPLED for n, c in many.items() if n * (100 - percent) >= percent}

    def met(one_in: int) -> list[dict[int, float]]:
        """Rows met in the lists of subsets and of single n-grams, by size, as one key in `SAMPLED` would meet them."""
        some = written(listed(rows, percent, None, lambda k: k % one_in == 0, first), "sampled")
        length = some.groupBy("key", "light").agg(F.count("*").alias("c"))
        cost = some.join(length, ["key", "light"]).groupBy("light", "n").agg(F.sum("c").alias("c")).collect()
        return [{r["n"]: r["c"] * one_in / SAMPLED for r in cost if r["light"] == kind} for kind in (True, False)]

    pairs, scans = met(SAMPLED)
    while True:
        x = boundary({**{n: c for n, c in fewest.items() if n > first}, **pairs}, scans, percent)
        if x <= first:
            return x
        first = 2 * x
        one_in = SAMPLED * max(1, round(sum(c for n, c in fewest.items() if n <= first) / max(1, sum(many.values()))))
        pairs = met(one_in)[0]


def bit_map(values: DataFrame, name: str, bits: int) -> np.ndarray:
    """Which of `bits` cells the values of a column fall into: a filter of fixed size, 32 KB for 262,144 bits."""
    cell = F.pmod(F.col(name), F.lit(bits))
    maps = values.groupBy(F.floor(cell / 32768).alias("k")).agg(F.bitmap_construct_agg(F.pmod(cell, F.lit(32768))).alias("m")).collect()
    out = np.zeros(bits // 8, np.uint8)
    for r in maps:
        got = np.frombuffer(r["m"], np.uint8)
        out[r["k"] * 4096:r["k"] * 4096 + len(got)] = got
    return out


def in_map(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = np.mod(values, len(bits) * 8)
    return ((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)


def postings(rows: DataFrame, nodes: DataFrame, percent: int, bits: int = 1 << 25) -> tuple[int, DataFrame]:
    """The boundary, and the inverted lists of two nodes or more: (key, light, node, n, pos, weight).

    Most n-grams of a 2-prefix are in one set only. Keys are counted first; then a bit map of the
    repeated ones (4 MB) goes to the tasks, and only what it lets through is dealt by key. A node's
    weight is the mean length of its lists: the text that copies were made from has most in common.
    """
    x = measured(rows, percent)
    every = listed(rows, percent, x, lambda k: np.ones(len(k), bool))
    often = written(every.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1").select("key"), "often")
    known = bit_map(often, "key", bits)
    some = listed(rows, percent, x, lambda k: in_map(known, k))
    some = some.join(nodes.select(F.col("node").alias("row")), "row", "left_semi").withColumnRenamed("row", "node")
    some = written(some, "listed")
    # A list of light sets only is of no use to heavy ones.
    long = some.groupBy("key", "light").agg(F.count("*").alias("c"), F.max("n").alias("top")).filter(
        (F.col("c") > 1) & (F.col("light") | (F.col("top") > x))).select("key", "light", "c")
    lists = written(some.join(long, ["key", "light"]), "lists")
    weight = lists.groupBy("node").agg((F.sum("c") / F.first("n")).alias("weight"))
    return x, written(lists.drop("c").join(weight, "node"), "weighted")


def texts_of(docs: DataFrame, nodes: DataFrame, bits: int = 1 << 22) -> DataFrame:
    """(node, text) for `nodes` (node, doc_id, th): a bit map lets few others leave the scan, a join the right ones."""
    wanted = bit_map(nodes, "th", bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            th = batch.column(1).to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(in_map(wanted, th))).rename_columns(["s_doc_id", "s_th", "text"])

    found = _texts(docs.filter("text is not null")).mapInArrow(run, "s_doc_id long, s_th long, text string")
    found = found.join(nodes, found["s_doc_id"].eqNullSafe(nodes["doc_id"]) & (found["s_th"] == nodes["th"]))
    return found.select("node", "text")


def _needed(percent: int) -> Column:
    """Overlap that links sets of sizes na and nb."""
    return F.ceil(percent * (F.col("na") + F.col("nb")) / (100.0 + percent) - 1e-9)


def verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, n: int, percent: int, name: str) -> DataFrame:
    """The pairs (a, b, na, nb) with `far`, their Jaccard distance, and `linked`, by the n-grams of their whole texts.

    Texts are shipped and not sets of hashes, which take three times the room.
    """
    pairs = written(pairs, f"{name}-pairs")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(nodes.select("node", "doc_id", "th"), "node")
    texts = written(texts_of(docs, written(wanted, f"{name}-nodes")), f"{name}-texts")
    both = pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b").select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[str, np.ndarray] = ("", shingles("", n))
        for batch in batches:
            far, good = [], []
            for ta, tb in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if tb != last[0]:
                    last = (tb, shingles(tb, n))
                s = shingles(ta, n)
                shared = len(np.intersect1d(s, last[1], assume_unique=True))
                union = len(s) + len(last[1]) - shared
                far.append(1 - shared / union)
                good.append(100 * shared >= percent * union)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(far, pa.float64()), pa.array(good, pa.bool_())],
                                             names=["a", "b", "far", "linked"])

    return written(both.mapInArrow(run, "a long, b long, far double, linked boolean").distinct(), f"{name}-checked", 200)


def _enough(percent: int, x: int) -> Column:
    """Whether the counted n-grams or subsets that a pair shares leave room for a link."""
    tail = lambda s, k: F.floor((percent * F.col(s) + 99) / 100) - k  # noqa: E731  outside the k-prefix
    single = F.greatest(F.lit(1), _needed(percent) - F.greatest(tail("na", 1), tail("nb", 1)))
    two = F.greatest(F.lit(2), _needed(percent) - F.greatest(tail("na", 2), tail("nb", 2)))
    light = F.greatest("na", "nb") <= x
    return F.when(light, F.col("shared") >= two * (two - 1) / 2).otherwise(F.col("shared") >= single)


def join(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of `docs`: see `grouped`.

    Only components are found; inside one most links are never made. `pairs` gives the links.
    """
    return grouped(docs, n, percent).select("doc_id", "n_shingles", "component_id")


def grouped(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, th, group) for every row of `docs`.

    Two sets link when 100 * intersection >= percent * union. component_id is the smallest doc_id
    that links reach. A text without words is linked with nothing and has its own doc_id. Repeated
    rows are members of one class and all come out. A null doc_id is kept and never the smallest
    unless it is alone. Columns other than doc_id and text are ignored. `th` is the hash of the text
    and `group` names the component, also where a doc_id is repeated with other texts; it is null for
    a text without words.
    """
    rows, nodes = classes(docs, n, percent)
    x, lists = postings(rows, nodes, percent)
    lists = lists.withColumn("comp", F.col("node"))
    # One partner for each node; then components are few, and what they could still share is checked in full.
    first = verified(docs, nodes, partners(lists, percent, x), n, percent, "copies")
    links = first.filter("linked").select("a", "b")
    rest = cross(apart(lists, nodes, links, first, percent), percent, x)
    links = links.union(verified(docs, nodes, rest, n, percent, "rest").filter("linked").select("a", "b"))
    return labelled(rows, nodes, stars(links))


def classes(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The rows with their prefixes, and a node for each different set of n-grams."""
    found = prefixes(docs, common_shingles(docs, n), n, percent).withColumn("row", F.monotonically_increasing_id())
    rows = written(found, "prefixes")
    return rows, written(rows.filter("n > 0").groupBy("sig1", "sig2").agg(
        F.min("doc_id").alias("low"), F.min(F.struct("row", "doc_id", "th", "last")).alias("of"),
    ).select(F.col("of.row").alias("node"), "sig1", "sig2", "low", "of.doc_id", "of.th", "of.last"), "nodes")


def pairs(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """(a_doc_id, b_doc_id, jaccard): every link between two different sets of n-grams.

    A set is named by the smallest doc_id of the rows that have it. No pair is left out because its
    sets are in one component already, so a group of k different near copies gives up to k * k / 2 rows.
    """
    rows, nodes = classes(docs, n, percent)
    x, lists = postings(rows, nodes, percent)
    alpha = F.floor((percent * F.col("n") + 99) / 100)
    tops = lists.groupBy("node", "n").agg(F.count(F.when(~F.col("light"), 1)).alias("c")).select("node", (alpha - 1 + F.col("c")).alias("top"))
    sized = lists.join(lists.groupBy("key", "light").agg(_blocks()), ["key", "light"])
    every = sized.join(tops.join(nodes.select("node", "last"), "node"), "node").withColumns({
        "comp": F.col("node"), "partner": F.lit(None).cast("long"), "far": F.lit(None).cast("double")})
    found = verified(docs, nodes, cross(written(every, "every"), percent, x), n, percent, "links").filter("linked")
    low = nodes.select("node", "low")
    out = found.join(low.toDF("a", "la"), "a").join(low.toDF("b", "lb"), "b")
    return out.select(F.least("la", "lb").alias("a_doc_id"), F.greatest("la", "lb").alias("b_doc_id"), (1 - F.col("far")).alias("jaccard"))


def partners(lists: DataFrame, percent: int, x: int) -> DataFrame:
    """For each node the node of another component that it meets most as the heaviest of a list.

    Sizes must allow a link, and half of the shared keys that a link needs must be seen: other
    nodes may stand first in some of the lists that two share.
    """
    first = lists.groupBy("key", "light").agg(F.max(F.struct("weight", -F.col("node"), "n", "comp")).alias("f"))
    first = first.select("key", "light", (-F.col("f.col2")).alias("b"), F.col("f.n").alias("nb"), F.col("f.comp").alias("cb"))
    met = lists.join(first, ["key", "light"]).filter(
        (F.col("comp") != F.col("cb")) & (100 * F.least("n", "nb") >= percent * F.greatest("n", "nb")))
    met = met.groupBy(F.col("node").alias("a"), "b", F.col("n").alias("na"), "nb").agg((F.count("*") * 2).alias("shared"))
    best = met.filter(_enough(percent, x)).groupBy("a").agg(F.max_by(F.struct("b", "na", "nb"), F.struct("shared", -F.col("b"))).alias("f"))
    return best.select("a", "f.b", "f.na", "f.nb")


def apart(lists: DataFrame, nodes: DataFrame, links: DataFrame, checked: DataFrame, percent: int) -> DataFrame:
    """The lists that hold nodes of several components, with the `comp` of each, its partner and the distance `far` to it.

    `top` is what a node can share at most with a node of another component whose 1-prefix ends
    behind its own in the order: of its 1-prefix, only what these lists hold.
    """
    named = lists.drop("comp").join(stars(links), "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root")
    named = named.join(checked.select(F.col("a").alias("node"), F.col("b").alias("partner"), "far"), "node", "left")
    named = written(named, "named")
    mixed = named.groupBy("key", "light").agg(F.min("comp").alias("low"), F.max("comp").alias("top"), _blocks()).filter("low != top")
    kept = written(named.join(mixed.select("key", "light", "blocks"), ["key", "light"]), "mixed")
    alpha = F.floor((percent * F.col("n") + 99) / 100)
    tops = kept.groupBy("node", "n").agg(F.count(F.when(~F.col("light"), 1)).alias("c")).select("node", (alpha - 1 + F.col("c")).alias("top"))
    return written(kept.join(tops.join(nodes.select("node", "last"), "node"), "node"), "apart")


def _blocks() -> Column:
    return F.ceil(F.count(F.lit(1)) / LIST_BLOCK).cast("int").alias("blocks")


def cross(lists: DataFrame, percent: int, x: int) -> DataFrame:
    """All pairs of nodes of different components that share enough of their lists and may be near enough.

    A list of several `blocks` is paired block by block: one side is dealt to the blocks, the other
    one goes to each of them, so its pairs are made by as many tasks. Both sides of the other lists
    are one shuffle.

    Jaccard distance is a metric: two nodes whose distances to one partner differ by more than a link
    may be far cannot be linked, and a node that was checked against the other one need not be again.
    """
    side = lambda rows, node, *part: rows.select("key", "light", F.col("node").alias(node), *[
        F.col(c).alias(f"{s}{node}") for c, s in (("n", "n"), ("comp", "c"), ("partner", "p"), ("far", "f"), ("top", "t"), ("last", "l"), ("pos", "i"))], *part)
    short, long = lists.filter("blocks = 1"), lists.filter("blocks > 1")
    left = side(long, "a", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("part"))
    right = side(long, "b", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part"))
    both = side(short, "a").join(side(short, "b"), ["key", "light"]).unionByName(left.join(right, ["key", "light", "part"]).drop("part"))
    most = 1 - percent / 100 + 1e-9
    apart_ = (F.col("pa") == F.col("pb")) & (F.abs(F.col("fa") - F.col("fb")) > most)
    known = (F.col("pa") == F.col("b")) | (F.col("pb") == F.col("a"))
    near = ~F.coalesce(apart_, F.lit(False)) & ~F.coalesce(known, F.lit(False))
    fit = (F.col("ca") != F.col("cb")) & (100 * F.col("na") >= percent * F.col("nb")) & (
        (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b"))))
    # Of the node whose prefix ends first, all that is shared and in its prefix is in the other's prefix, too.
    of = lambda c: F.when(F.col("la") <= F.col("lb"), F.col(f"{c}a")).otherwise(F.col(f"{c}b"))
    room = of("t") >= _needed(percent)
    # A link must share a number of its prefix, `least`. The last places, which hold the most common
    # n-grams, can hold as many of these as there are such places: pairs are made in the lists of the
    # places before and must share the others there.
    tail = F.floor((percent * of("n") + 99) / 100) - 1
    least = F.greatest(F.lit(1), _needed(percent) - tail)
    last = F.floor((least - 1) / SKIPPED)
    early = of("i") < of("n") - tail - last
    fit = fit & (F.col("light") | ((F.col("nb") > x) & room & early)) & near
    met = both.filter(fit).withColumn("least", least - last).groupBy("a", "b", "na", "nb", "least").agg(
        F.count("*").alias("shared"))
    two = F.greatest(F.lit(2), _needed(percent) - F.greatest(*[F.floor((percent * F.col(s) + 99) / 100) - 2 for s in ("na", "nb")]))
    enough = F.when(F.col("nb") <= x, F.col("shared") >= two * (two - 1) / 2).otherwise(F.col("shared") >= F.col("least"))
    return met.filter(enough).select("a", "b", "na", "nb")


def labelled(rows: DataFrame, nodes: DataFrame, of: DataFrame) -> DataFrame:
    member = of.union(of.select("root", "root").distinct()).toDF("node", "root")
    low = member.join(nodes.select("node", "low"), "node").groupBy("root").agg(F.min("low").alias("component"))
    comp = member.join(low, "root").select("node", "root", "component")
    classes = nodes.select("node", "sig1", "sig2", "low").join(comp, "node", "left").select(
        F.col("sig1").alias("c1"), F.col("sig2").alias("c2"), F.coalesce("component", "low").alias("component"),
        F.coalesce("root", "node").alias("group"))
    out = rows.join(classes, (F.col("sig1") == F.col("c1")) & (F.col("sig2") == F.col("c2")), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component")).otherwise(
        F.col("doc_id")).alias("component_id"), "th", "group")
