"""The registered queries of this subpackage, one for each operator, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm import ann, jaccard, langid, lexical, mixing, packing, quality, rules, secrets, sharding, spelling, toxicity, winnowing
from tradeloom.llm.common import table, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return add


@query("op1_quality_rules")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.weak_quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "votes", "posterior")


@query("op4_secret_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    of = lambda k: F.size(F.filter("base", lambda p: p["kind"] == k)).cast("long")
    return found.select(
        "doc_id", of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"),
        F.sha2(secrets.spelled(F.col("base")), 256).alias("base_sha256"), secrets.spelled(F.col("spans")).alias("spans"),
        F.size("linked").cast("long").alias("n_linked"))


OP8_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT] AS w
  FROM d GROUP BY source
), f AS (
  SELECT *, sum(source_size) OVER () AS total,
         coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_before,
         sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left,
         row_number() OVER o AS k
  FROM s WINDOW o AS (ORDER BY source_size::DOUBLE / w, encode(source) NULLS LAST)
), k AS (
  SELECT min(k) AS k FROM f WHERE 3 * source_size * w_left >= (total - 3 * full_before) * w
), t AS (
  SELECT f.source, f.source_size, CASE WHEN f.k < k.k THEN (3 * f.source_size)::DOUBLE
         ELSE ((g.total - 3 * g.full_before) * f.w)::DOUBLE / g.w_left::DOUBLE END AS target
  FROM f, k JOIN f AS g ON g.k = k.k
), r AS (
  SELECT d.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) - 1 AS nr,
         (('0x' || substr(md5(coalesce(d.source, '') || '|mix'), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target, (size * (floor((nr + 1) * rate + u) - floor(nr * rate + u)))::BIGINT AS taken FROM r
"""


@query("op8_source_mix", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.mix(written(docs.select("doc_id", "source", mixing.n_words(F.col("text")).alias("size")), "sizes"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


SHARDS = 40


@query("op10_rendezvous_shards")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = sharding.shard(docs, [1.0] * SHARDS, [1.0] * (SHARDS + 1)).drop("text")
    return sharding.slots(rows).select(
        "doc_id", F.col("_size").alias("size"), F.col("_crc32").alias("text_crc32"), F.lit("key").alias("law"),
        F.col("_shard").alias("shard"), F.col("_slot").alias("slot"), F.col("_grown_shard").alias("grown_shard"))


@query("op2_pack_islands")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    """Sequences of at most 2048 tokens; a piece's ids are given by their checksum."""
    pieces = packing.tokenize(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rows = packing.pack(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))
    return rows.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 4 THEN list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))
                                      WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), l AS (
  SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s AS x JOIN s AS y USING (g)
                        WHERE x.doc_id <> y.doc_id GROUP BY ALL) AS p
  JOIN n AS na ON na.doc_id = p.a JOIN n AS nb ON nb.doc_id = p.b WHERE 100 * i >= 85 * (na.n + nb.n - i)
), r(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.other
)
SELECT r.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.other) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""


@query("op9_ngram_jaccard_join", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


#: The labels mark two things; texts that are toxic without being junk are a category of their own.
CATEGORIES = {"junk": "quality = 0", "toxic": "toxic = 1", "toxic_prose": "toxic = 1 and quality = 1"}


def toxic_chain(spark: SparkSession, sf_dir: str, docs: DataFrame) -> toxicity.Chain:
    """Chain fitted on at most about 20,000 labelled documents."""
    return toxicity.train(docs, table(spark, sf_dir, "labels"), CATEGORIES)


@query("op3_toxicity_chain")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chain = toxic_chain(spark, sf_dir, docs)
    learnt = chain.learnt[chain.categories.index("toxic")]
    return toxicity.score(docs, chain).withColumn("toxic", F.lit(learnt) & (F.col("p_toxic") >= 0.5))


@query("op5_one_bit_search")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), "id % 20 = 0")


@query("op6_language_fusion")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages"))


@query("op7_quality_score")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), p AS (
  SELECT DISTINCT item_id, m, unnest(list_transform(range(1, len(w) - m + 2), lambda a: array_to_string(w[a:a + m - 1], ' '))) AS g
  FROM (SELECT *, least(10, len(w)) AS m FROM i WHERE len(w) > 0)
), r AS (
  SELECT doc_id, m, unnest(range(0, len(w) - m + 1)) AS a,
         unnest(list_transform(range(1, len(w) - m + 2), lambda a: array_to_string(w[a:a + m - 1], ' '))) AS g
  FROM d, (SELECT DISTINCT m FROM p) WHERE len(w) >= m
), h AS (
  SELECT doc_id, r.m, a, item_id FROM r JOIN p ON r.g = p.g AND r.m = p.m
), n AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(a, a + m)) AS q FROM h) GROUP BY doc_id
), c AS (
  SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY encode(k)) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS k FROM h) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(len(d.w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""


@query("op11_winnowing", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = winnowing.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS t FROM benchmark
), c AS (
  SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_words FROM d WHERE len(w) > 0
), f AS (
  SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY ALL
), x AS (
  SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight FROM f, c GROUP BY t, n_docs
), m AS (
  SELECT r, doc_id, 10 + (90 * len(w) * n_docs) // n_words AS m FROM d, c WHERE len(w) > 0
), s AS (
  SELECT item_id, r, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM f JOIN x USING (t) JOIN m USING (r) JOIN q USING (t) GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score FROM s WHERE score > 0
QUALIFY rank <= 10
"""


@query("op12_automaton_search", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(0, 256)) AS i)
), r AS (
  SELECT doc_id, w, count(*) AS n, encode(coalesce(doc_id::VARCHAR, '') || ':' || w) AS b FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS w
    FROM documents) WHERE len(w) >= 6 GROUP BY doc_id, w
), h AS (
  SELECT w, n, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(0, octet_length(b)), lambda k: ('0x' || substr(hex(b), 2 * k + 1, 2))::BIGINT)),
                               lambda c, x: xor(t[xor(c, x) % 256 + 1], c >> 8)), 4294967295) AS h
  FROM r, crc
), v AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, (h % len(w))::BIGINT) || substr(w, (h % len(w))::BIGINT + 2) ELSE w END AS word, n FROM h)
  WHERE len(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), d AS (
  SELECT word, n, word AS k, 0 AS i FROM v
  UNION ALL SELECT word, n, unnest(list_transform(range(1, len(word) + 1), lambda i: substr(word, 1, i - 1) || substr(word, i + 1))),
                   unnest(range(1, len(word) + 1)) FROM v
), p AS (
  SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM d AS a JOIN d AS b USING (k)
  WHERE a.word <> b.word AND (a.i = b.i OR a.i = 0 OR b.i = 0)
), f AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, encode(other)) AS top, max(other_n) AS top_n FROM p GROUP BY word
), g AS (
  SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN top_n >= 5 * v.n THEN top END AS form, CASE WHEN top_n >= 5 * v.n THEN top_n END AS form_n
  FROM v LEFT JOIN f USING (word)
), w(word, cur) AS (
  SELECT word, word FROM g UNION ALL SELECT w.word, g.form FROM w JOIN g ON g.word = w.cur WHERE g.form IS NOT NULL
)
SELECT g.word, g.form, w.cur AS root, g.n, g.n_near, g.form_n
FROM g JOIN w ON w.word = g.word JOIN g AS last ON last.word = w.cur AND last.form IS NULL
"""


@query("op13_spelling_variants", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(table(spark, sf_dir, "documents")))
