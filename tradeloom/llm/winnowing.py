"""Benchmark decontamination by winnowing: which words of a document repeat a passage of a benchmark item.

A fingerprint is the least hash of the k-word grams in a window of consecutive grams. A window of
`window` words holds `window - k + 1` grams; its least one is the same in the item and in the document,
so every shared span of `window` words or more shares a fingerprint. Fingerprints are joined, and a
common one is extended to both sides, word by word, as far as a window around it can reach.

Items of fewer words are one window of their own length and are joined on it as text. Built-in
functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import written

#: What parts words becomes a space, and A-Z small letters, in one pass; regular expressions take far longer.
PARTING = "".join(chr(i) for i in range(128) if not chr(i).isalnum())
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Words of a text handled at once. Longer texts are cut into overlapping blocks, which no window notices.
BLOCK = 1 << 20

#: Low bits of a gram's code: its place, counted down, so that of equal hashes the last one is the least.
PLACE = (1 << 24) - 1

KEY = ["_k1", "_k2"]


def words(text: Column) -> Column:
    """Words of a text, the runs of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` once A-Z are small letters; none where it is null."""
    plain = F.translate(text.cast("string"), UPPER + PARTING, LOWER + " " * len(PARTING))
    return F.coalesce(F.array_remove(F.split(plain, " "), ""), F.array().cast("array<string>"))


def key(doc_id: Column, text: Column) -> list[Column]:
    """Two hashes of id and text; equal rows have equal results, rows of one id with other texts their own."""
    parts = [F.coalesce(doc_id.cast("string"), F.lit("")), doc_id.isNull(), F.coalesce(text.cast("string"), F.lit("")), text.isNull()]
    return [F.xxhash64(*parts).alias("_k1"), F.hash(*parts).alias("_k2")]


def blocks(rows: DataFrame, keys: list[str], window: int, block: int) -> DataFrame:
    """`keys`, first word `s` and words `b` of each block of the column `w`; windows lie whole in a block."""
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)), F.lit(block))
    cut = F.transform(starts, lambda s: F.struct(s.alias("s"), F.slice(F.col("w"), s + 1, F.lit(block + window - 1)).alias("b")))
    return rows.filter(F.size("w") > 0).select(*keys, F.inline(cut))


def fingerprints(cut: DataFrame, keys: list[str], window: int, k: int) -> DataFrame:
    """`keys`, hash `h`, first word `p` and surroundings (`left`, the number of words before the gram, and `around`,
    the words a window could reach, parted by spaces) of each fingerprint of blocks."""
    span = window - k + 1

    def code(i: Column) -> Column:
        gram = F.xxhash64(*[F.get(F.col("b"), i + j) for j in range(k)])
        return gram.bitwiseAND(F.lit(~PLACE)).bitwiseOR(F.lit(PLACE) - i)

    def least(i: Column) -> Column:
        return F.least(*[F.get(F.col("g"), i + j) for j in range(span)]) if span > 1 else F.get(F.col("g"), i)

    def told(v: Column) -> Column:
        p = (F.lit(PLACE) - v.bitwiseAND(F.lit(PLACE))).cast("int")
        left = F.least(p, F.lit(span - 1))
        around = F.array_join(F.slice(F.col("b"), p - left + 1, left + F.lit(k + span - 1)), " ")
        return F.struct(v.bitwiseAND(F.lit(~PLACE)).alias("h"), (F.col("s") + p).cast("long").alias("p"), left.alias("left"), around.alias("around"))

    long = cut.filter(F.size("b") >= window)
    grams = long.withColumn("g", F.transform(F.sequence(F.lit(0), F.size("b") - k), code))
    least_ = grams.withColumn("f", F.array_distinct(F.transform(F.sequence(F.lit(0), F.size("g") - span), least)))
    return least_.select(*keys, F.inline(F.transform("f", told)))


def whole(cut: DataFrame, keys: list[str], lengths: list[int]) -> DataFrame:
    """`keys`, first word `p`, `size` and words `gram` of every run of as many words as `lengths` name."""
    def runs(m: int) -> Column:
        made = F.transform(F.sequence(F.lit(0), F.size("b") - m), lambda i: F.struct(
            (F.col("s") + i).cast("long").alias("p"), F.lit(m).alias("size"), F.array_join(F.slice(F.col("b"), i + 1, F.lit(m)), " ").alias("gram")))
        return F.when(F.size("b") >= m, made).otherwise(F.array().cast("array<struct<p:bigint,size:int,gram:string>>"))

    return cut.select(*keys, F.inline(F.concat(*[runs(m) for m in lengths])))


def common(a: Column, b: Column) -> Column:
    """Number of first elements that two arrays share."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    end = F.array_position(same, F.lit(False))
    return F.when(end > 0, end - 1).otherwise(F.size(same)).cast("int")


def shared(docs: DataFrame, items: DataFrame, window: int = 10, k: int = 4, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Hits (`_k1`, `_k2`, place `p`, words `lo` to `hi`, `c`) and the items (`c`, `item_id`) of each passage `c`.

    A hit is a span of a document, `hi` exclusive, all of whose words lie in windows that the
    passage's items hold as well. An item's windows are its runs of `window` words; an item of
    fewer words, but not none, is one window. Passages that items share are joined once.
    """
    if not 0 < k <= window <= block <= PLACE - window:
        raise ValueError("0 < k <= window <= block is needed, and a block below 2 ** 24 words")
    span = window - k + 1
    texts = items.select(F.col("item_id").cast("string").alias("item_id"), words(F.col("text")).alias("w"))
    short = written(texts.filter(F.size("w").between(1, window - 1)).select(
        "item_id", F.size("w").alias("size"), F.array_join("w", " ").alias("gram")).distinct(), "short-items")
    long = fingerprints(blocks(texts, ["item_id"], window, block), ["item_id"], window, k)
    # Numbers are written with their passage, so they stay what they are.
    long = written(long.groupBy("h", "left", "around").agg(F.collect_set("item_id").alias("item_ids"), F.count_if(F.col("item_id").isNull()).alias("nameless"))
                   .withColumn("c", F.concat(F.lit("w"), F.monotonically_increasing_id().cast("string"))), "passages")
    found = docs.select(*key(F.col("doc_id"), F.col("text")), words(F.col("text")).alias("w"))
    cut = blocks(found, KEY, window, block)

    theirs = fingerprints(cut, KEY, window, k).join(long.select("h"), "h", "left_semi")
    passages = long.select("h", F.col("left").alias("_left"), F.split("around", " ").alias("_around"), "c")
    met = theirs.withColumn("around", F.split("around", " ")).join(passages, "h")
    before = common(F.reverse(F.slice("around", F.lit(1), F.col("left"))), F.reverse(F.slice("_around", F.lit(1), F.col("_left"))))
    after = common(F.slice("around", F.col("left") + 1, F.lit(k + span)), F.slice("_around", F.col("_left") + 1, F.lit(k + span)))
    hits = met.select(*KEY, "p", "c", before.alias("before"), after.alias("after")).filter(
        (F.col("after") >= k) & (F.col("before") + F.col("after") >= window)
    ).select(*KEY, "p", (F.col("p") - F.col("before")).alias("lo"), (F.col("p") + F.col("after")).alias("hi"), "c")
    members = long.select("c", F.explode("item_ids").alias("item_id"))

    # At most window - 1 numbers.
    lengths = sorted(r[0] for r in short.select("size").distinct().collect())
    if lengths:
        runs = whole(cut, KEY, lengths).join(short.select("gram").distinct(), "gram")
        hits = hits.unionByName(runs.select(*KEY, "p", F.col("p").alias("lo"), (F.col("p") + F.col("size")).alias("hi"), F.concat(F.lit("s"), "gram").alias("c")))
        members = members.unionByName(short.filter("item_id is not null").select(F.concat(F.lit("s"), "gram").alias("c"), "item_id"))
    return written(hits, "hits"), members


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, k: int = 4, block: int = BLOCK) -> DataFrame:
    """Each row of `docs` as doc_id, n_words, n_hit, spans and item_ids.

    `spans` are the hit spans (lo, hi) in words, by their start, which may overlap; n_hit counts their
    words once; item_ids holds, as sorted text, the items with a window in the document. Rows with a
    null or empty text, or without words, have no span. Rows may repeat, and rows of one or of no
    doc_id with different texts are told apart; each is counted for itself. Rows of one item_id are
    one item; an item without an id marks words but is not listed. Other columns are not looked at.
    """
    hits, members = shared(docs, items, window, k, block)
    # Spans around one place overlap, so they are one span; then a document has at most one for each of its words.
    spans = hits.groupBy(*KEY, "p").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    spans = spans.groupBy(*KEY).agg(F.sort_array(F.collect_set(F.struct("lo", "hi"))).alias("spans"))
    named = hits.select(*KEY, "c").distinct().join(members, "c").select(*KEY, "item_id").distinct()
    named = named.groupBy(*KEY).agg(F.sort_array(F.collect_list("item_id")).alias("item_ids"))
    rows = docs.select(F.col("doc_id"), *key(F.col("doc_id"), F.col("text")), F.size(words(F.col("text"))).cast("long").alias("n_words"))
    rows = rows.join(spans.join(named, KEY, "left"), KEY, "left")
    zero = F.struct(F.lit(0).cast("long").alias("upto"), F.lit(0).cast("long").alias("n"))
    n_hit = F.aggregate(F.col("spans"), zero, lambda a, x: F.struct(
        F.greatest(a["upto"], x["hi"]).alias("upto"), (a["n"] + F.greatest(F.lit(0), x["hi"] - F.greatest(a["upto"], x["lo"]))).alias("n")), lambda a: a["n"])
    return rows.select(
        "doc_id", "n_words", F.coalesce(n_hit, F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("spans", F.array().cast("array<struct<lo:bigint,hi:bigint>>")).alias("spans"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))
