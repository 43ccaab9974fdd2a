"""Language of pages and documents: evidence of text, markup, address and host, fused by Bayes' rule."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import slices, unit, written

BUCKETS = 1 << 16

_HIDDEN = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")
_DECLARED = re.compile(r"""(?is)<html\b[^>]*?\blang\s*=\s*["']?([a-z]{2,3})\b""")
_META = re.compile(r"""(?is)<meta\b[^>]*?content-language["'][^>]*?content\s*=\s*["']?([a-z]{2,3})\b""")


def codes(text: str | None) -> np.ndarray:
    """Buckets of the byte trigrams of the text, A-Z in small letters, white space as one blank."""
    raw = np.frombuffer(b" " + b" ".join((text or "").encode("utf-8", "replace").lower().split()) + b" ", np.uint8).astype(np.uint32)
    if len(raw) < 3:
        return np.zeros(0, np.uint32)
    return ((raw[:-2] * 0x9E3B + raw[1:-1] * 0x0653 + raw[2:] * 0x2F) ^ (raw[:-2] << 7)) & (BUCKETS - 1)


def visible(page: str | None) -> str:
    return html.unescape(_HIDDEN.sub(" ", page or ""))


def declared(page: str | None) -> str | None:
    found = _DECLARED.search(page or "") or _META.search(page or "")
    return found[1].lower() if found else None


def address(url: str | None) -> tuple[str | None, str | None, str | None]:
    """(host, domain, suffix): the last two labels are the domain, the last one, and a path that begins
    with two letters, are the suffix. Addresses that cannot be read have none."""
    try:
        parts = urlsplit(url or "")
        host = (parts.hostname or "").lower()
    except ValueError:
        return None, None, None
    if not host:
        return None, None, None
    labels = host.split(".")
    lead = re.match(r"/([a-z]{2})(?:/|$)", parts.path.lower())
    return host, ".".join(labels[-2:]), labels[-1] + (f"/{lead[1]}" if lead else "")


@dataclass(frozen=True)
class Likelihood:
    """Log probability of each bucket in each language."""

    languages: tuple[str, ...]
    table: np.ndarray

    def posterior(self, text: str | None, share: float = 0.25) -> np.ndarray:
        """Of the languages, from the text alone and all alike likely before.

        Neighbouring trigrams say much of the same, so each counts only by a `share`.
        """
        ll = share * self.table[codes(text)].sum(0, dtype=np.float64)
        p = np.exp(ll - ll.max()) if len(ll) else ll
        return p / p.sum() if len(p) else p


def train(docs: DataFrame, most: int = 20000, seed: str = "language") -> Likelihood:
    """Trigram counts by the `lang` of about `most` documents, taken by a hash of doc_id; null languages are no label."""
    known = docs.filter("lang is not null and text is not null").select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    share = min(1.0, most / max(1, known.count()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums: dict[str, np.ndarray] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                sums[lang] += np.bincount(codes(text), minlength=BUCKETS)
            for lang, n in sums.items():
                at = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(n[at])], names=["lang", "bucket", "n"])

    counted = known.filter(unit(F.col("doc_id"), seed) < share).select("lang", "text").mapInArrow(count, "lang string, bucket long, n long")
    got = written(counted, "trigrams").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    names = tuple(sorted(set(got["lang"])))
    table = np.full((BUCKETS, len(names)), 0.5)
    table[got["bucket"].to_numpy(int), got["lang"].map({x: i for i, x in enumerate(names)}).to_numpy(int)] += got["n"].to_numpy(float)
    return Likelihood(names, np.log(table / table.sum(0)).astype(np.float32))


def evidence(docs: DataFrame, pages: DataFrame, model: Likelihood) -> DataFrame:
    """(doc_id, page_id, host, domain, suffix, declared, p): text posterior and keys of every row of both tables.

    A document's host is its source; it has no address and no markup.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for kind, doc_id, page_id, body, url, source in zip(*[c.to_pylist() for c in batch.columns]):
                if kind:
                    keys, said, text = (source, source, None), None, body
                else:
                    keys, said, text = address(url), declared(body), visible(body)
                rows.append((doc_id, page_id, *keys, said, model.posterior(text).tolist()))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 7, kinds)],
                                             names=["doc_id", "page_id", "host", "domain", "suffix", "declared", "p"])

    none = F.lit(None)
    both = docs.select(F.lit(True).alias("kind"), F.col("doc_id").cast("long").alias("doc_id"), none.cast("long").alias("page_id"), F.col("text").cast("string").alias("body"),
                       none.cast("string").alias("url"), F.col("source").cast("string").alias("source")).unionByName(
        pages.select(F.lit(False).alias("kind"), none.cast("long").alias("doc_id"), F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("string").alias("body"),
                     F.col("url").cast("string").alias("url"), none.cast("string").alias("source")))
    schema = "doc_id long, page_id long, host string, domain string, suffix string, declared string, p array<double>"
    return both.mapInArrow(run, schema)


def fuse(rows: DataFrame, languages: tuple[str, ...], strength: float = 4.0, spread: int = 16) -> DataFrame:
    """Add `lang` and `confidence` to the rows of `evidence`.

    Prior: the host's share of each language, smoothed towards its domain's, that towards the whole's.
    Declared language and suffix weigh by how their rows' shares differ from the whole's, smoothed
    alike. Shares are sums of text posteriors, made by grouped aggregation (partial sums, so a hot
    host is no hot task); a row's own posterior is taken out of every sum that judges it. The sums
    are joined in `spread` copies, and the rows of a host are dealt among these. Missing evidence
    says nothing.
    """
    n = len(languages)
    if not n:
        return rows.withColumns({"lang": F.lit(None).cast("string"), "text_lang": F.lit(None).cast("string"), "confidence": F.lit(0.0)}).drop("p")
    p = lambda i: F.element_at("p", i + 1)
    total = rows.agg(*[F.sum(p(i)) for i in range(n)]).first()
    whole = [(x or 0.0) + 1.0 for x in total]
    whole = [x / sum(whole) for x in whole]
    rows = rows.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "page_id", "p"), F.lit(spread)))
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(spread - 1).cast("long")))
    plain = rows
    for level in ("host", "domain", "suffix", "declared"):
        sums = plain.filter(F.col(level).isNotNull()).groupBy(level).agg(F.array(*[F.sum(p(i)) for i in range(n)]).alias(f"_{level}"))
        sums = sums.select(F.col(level).alias("_key"), f"_{level}", salts.alias("_of"))
        rows = rows.join(sums, (F.col(level) == F.col("_key")) & (F.col("_salt") == F.col("_of")), "left").drop("_key", "_of")

    def share(level: str, i: int, parent: Column) -> Column:
        others = F.greatest(F.element_at(f"_{level}", i + 1) - p(i), F.lit(0.0))
        size = F.greatest(sum((F.element_at(f"_{level}", j + 1) for j in range(1, n)), F.element_at(f"_{level}", 1)) - 1, F.lit(0.0))
        return F.coalesce((others + strength * parent) / (size + strength), parent)

    weights = []
    for i in range(n):
        g = F.lit(whole[i])
        prior = share("host", i, share("domain", i, g))
        weights.append(F.greatest(p(i), F.lit(1e-12)) * prior * share("declared", i, g) / g * share("suffix", i, g) / g)
    rows = rows.withColumn("_w", F.array(*weights))
    sure = F.aggregate("_w", F.lit(0.0), lambda a, x: a + x)
    names = F.array(*[F.lit(x) for x in languages])
    top = lambda a: F.element_at(names, F.array_position(a, F.array_max(a)).cast("int"))
    return rows.withColumns({"lang": top(F.col("_w")), "text_lang": top(F.col("p")), "confidence": F.array_max("_w") / sure}).drop(
        "p", "_w", "_salt", "_host", "_domain", "_suffix", "_declared")


def identify(docs: DataFrame, pages: DataFrame, most: int = 20000) -> DataFrame:
    """Language of every document and page: (doc_id, page_id, host, domain, suffix, declared, lang, text_lang, confidence).

    One of doc_id and page_id is null. Likelihoods are learnt from `lang` of a bounded sample of
    documents, which is no evidence for the row itself. Null and empty texts are judged by the other evidence.
    """
    model = train(docs, most)
    return fuse(written(evidence(docs, pages, model), "evidence"), model.languages)
