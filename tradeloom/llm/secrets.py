"""Secrets in texts: sure patterns, and weak parts that count only beside complementary parts."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.llm.common import free, slices, written

ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
#: A text without any of these in small letters holds no match of ASSIGN.
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Kinds in the order of the output; the first three are sure, the others weak.
KINDS = ("assign", "access", "hex", "id", "key", "endpoint")
#: What a kind may be part of: I identifier, S secret, E endpoint.
ROLES = {"assign": "S", "access": "I", "hex": "S", "id": "I", "key": "S", "endpoint": "E"}

WEAK = {
    "id": re.compile(r"""(?ai)\b(?:user(?:_?name)?|login|account|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@+-]{3,}"""),
    "key": re.compile(r"(?a)(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_=-]*[0-9])[A-Za-z0-9+/_=-]{20,}"),
    "endpoint": re.compile(r"""(?ai)\b(?:https?|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[^\x00-\x20"'<>]{3,}|\b\d{1,3}(?:\.\d{1,3}){3}:\d{2,5}\b"""),
}

PARTS = "array<struct<kind:int,start:int,end:int>>"
SCHEMA = f"doc_id long, scope long, scope2 long, base {PARTS}, weak {PARTS}"
_STRUCT = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))


def entropy(text: str) -> float:
    """Bits per character."""
    n = len(text)
    return -sum(c / n * math.log2(c / n) for c in Counter(text).values()) if n else 0.0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the sure patterns, by start, then kind; positions are code points."""
    small, found = text.lower(), []
    if any(name in small for name in _NAMES):
        found = [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(1, m.start(), m.end()) for m in ACCESS.finditer(text)]
    found += [(2, m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[1], x[0]))


def weak_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Weak candidates that lie outside the sure spans."""
    out = []
    for kind, pattern in WEAK.items():
        for m in pattern.finditer(text):
            if kind == "key" and (entropy(m[0]) < 3.5 or not re.search("[A-Za-z]", m[0])):
                continue
            if not any(s < m.end() and m.start() < e for _, s, e in base):
                out.append((KINDS.index(kind), m.start(), m.end()))
    return sorted(out, key=lambda x: (x[1], x[0]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        base, weak = [], []
        for text in batch.column("text").to_pylist():
            base.append(b := base_spans(text or ""))
            weak.append(weak_spans(text or "", b))
        as_parts = lambda rows: pa.array([[dict(zip(("kind", "start", "end"), x)) for x in r] for r in rows], _STRUCT)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("scope"), batch.column("scope2"), as_parts(base), as_parts(weak)],
            names=["doc_id", "scope", "scope2", "base", "weak"])


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, scope, scope2, base, weak): the parts found in each whole text (null: empty).

    A scope is a text; equal texts are one scope, named by two hashes.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), *scope_of("text")).mapInArrow(_scan, SCHEMA)


def scope_of(text: str) -> list[Column]:
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return [F.xxhash64(t).alias("scope"), F.xxhash64(t, F.lit(1)).alias("scope2")]


def links(found: DataFrame, reach: int = 200) -> DataFrame:
    """Pairs of complementary parts at most `reach` code points apart in one scope.

    Complementary are identifier and secret, and endpoint and secret. It is an interval join on
    cells of `reach` code points: a secret goes to the cells that it or its reach touches, from the
    last code point of a part that ends `reach` before it to the first of one that starts `reach`
    behind it, the other part to those it covers, and a pair is made in the first cell they share. Parts of one kind do
    not overlap, so the pairs of a cell are bounded by its width, however long a text is.
    """
    scopes = found.filter((F.size("weak") > 0) & (F.size("weak") + F.size("base") > 1))
    one = scopes.groupBy("scope", "scope2").agg(F.first(F.concat("base", "weak")).alias("parts"))
    roles = F.element_at(F.array(*[F.lit(ROLES[k]) for k in KINDS]), F.col("p.kind") + 1)
    rows = one.select("scope", "scope2", F.explode("parts").alias("p")).select("scope", "scope2", "p", roles.alias("role"))
    cell = lambda c: F.floor(c / F.lit(reach)).cast("long")
    low, high = F.greatest(F.col("p.start") - reach - 1, F.lit(0)), F.col("p.end") + reach
    left = rows.filter("role = 'S'").select("scope", "scope2", F.col("p").alias("secret"), cell(low).alias("s_first"),
                                            F.explode(F.sequence(cell(low), cell(high))).alias("cell"))
    right = rows.filter("role != 'S'").select("scope", "scope2", F.col("p").alias("other"), cell(F.col("p.start")).alias("o_first"),
                                              F.explode(F.sequence(cell(F.col("p.start")), cell(F.col("p.end") - 1))).alias("cell"))
    near = (F.col("other.start") - F.col("secret.end") <= reach) & (F.col("secret.start") - F.col("other.end") <= reach)
    return left.join(right, ["scope", "scope2", "cell"]).filter(
        near & (F.col("cell") == F.greatest("s_first", "o_first"))).select("scope", "scope2", "secret", "other")


def reported(found: DataFrame, reach: int = 200) -> DataFrame:
    """(scope, scope2, linked): the weak parts of a scope that stand beside a complementary part."""
    pairs = links(found, reach)
    sides = pairs.select("scope", "scope2", F.explode(F.array("secret", "other")).alias("p")).filter(F.col("p.kind") >= 3)
    return sides.groupBy("scope", "scope2").agg(F.collect_set("p").alias("linked"))



def find_secrets(docs: DataFrame, reach: int = 200) -> DataFrame:
    """(doc_id, base, linked, all): spans of sure and of linked weak parts for each row of `docs`.

    A null text is empty and has no spans. Repeated rows and equal texts get the same spans; a null
    doc_id is kept. Columns other than doc_id and text are ignored. Spans of different kinds may
    overlap, as each kind is searched by itself.
    """
    found = written(scan(docs), "parts")
    weak = reported(found, reach).withColumnsRenamed({"scope": "r1", "scope2": "r2"})
    # Most rows have no weak part to look up: they need no shuffle.
    plain = found.filter(F.size("weak") == 0).withColumn("linked", F.lit(None).cast(PARTS))
    rows = found.filter(F.size("weak") > 0).join(weak, (F.col("scope") == F.col("r1")) & (F.col("scope2") == F.col("r2")), "left")
    rows = rows.drop("r1", "r2").unionByName(plain)
    linked = F.coalesce(F.col("linked"), F.array().cast(PARTS))
    order = F.transform(F.concat("base", linked), lambda p: F.struct(p["start"], p["kind"], p["end"]))
    spans = F.transform(F.array_sort(order), lambda p: F.struct(p["kind"], p["start"], p["end"]))
    return rows.select("doc_id", "scope", "scope2", "base", linked.alias("linked"), spans.cast(PARTS).alias("spans"))


def spelled(spans: Column) -> Column:
    """`kind:start:end`, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda p: F.concat_ws(
        ":", F.element_at(names, p["kind"] + 1), p["start"].cast("string"), p["end"].cast("string"))), ",")


def mask(docs: DataFrame, by: str = "<secret>", reach: int = 200) -> DataFrame:
    """`docs` with every span replaced by `by`; overlapping spans are replaced as one.

    All columns stay, `n_chars` follows the new text where there is one. Only texts with spans are
    looked up, and no document is dropped.
    """
    scope, scope2, r1, r2, spans, text = free(docs, "_scope", "_scope2", "_r1", "_r2", "_spans", "_text")
    found = find_secrets(docs, reach).filter(F.size("spans") > 0)
    found = found.groupBy("scope", "scope2").agg(F.first("spans").alias(spans)).withColumnsRenamed({"scope": r1, "scope2": r2})
    keyed = docs.withColumns({scope: scope_of("text")[0], scope2: scope_of("text")[1]})
    rows = keyed.join(found, (F.col(scope) == F.col(r1)) & (F.col(scope2) == F.col(r2)), "left")
    names = docs.columns

    @F.pandas_udf(T.StringType())
    def cut(text, spans):
        return text.combine(spans, lambda t, s: t if s is None or t is None else replaced(t, s, by))

    new = rows.withColumn(text, F.when(F.col(spans).isNull(), F.col("text")).otherwise(cut("text", spans)))
    size = F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(F.length(text).cast("long")) if "n_chars" in names else None
    return new.select(*[
        F.col(text).alias("text") if c == "text" else size.alias("n_chars") if c == "n_chars" else F.col(f"`{c}`") for c in names])


def replaced(text: str, spans, by: str) -> str:
    out, at = [], 0
    for s in sorted((p["start"], p["end"]) for p in spans):
        if s[0] >= at:
            out += [text[at:s[0]], by]
        at = max(at, s[1])
    return "".join(out) + text[at:]
