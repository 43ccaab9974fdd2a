import math
import zlib
from collections import Counter, defaultdict

import xxhash

from edges import EDGES, SCHEMA
from tradeloom.llm import sharding


def plain(doc_id, weights):
    """Lowest -ln(u) / weight; Spark chains xxhash64 over its columns, skipping nulls, from seed 42."""
    text = "" if doc_id is None else str(doc_id)
    best = None
    for i, w in enumerate(weights):
        h = xxhash.xxh64_intdigest(text.encode(), 42)
        h = xxhash.xxh64_intdigest((1 if doc_id is None else 0).to_bytes(4, "little"), h)
        h = xxhash.xxh64_intdigest(i.to_bytes(4, "little"), h)
        if w > 0:
            best = min(best or (math.inf, 0), (-math.log(((h >> 11) + 0.5) / 2 ** 53) / w, i))
    return best[1]


def test_rendezvous(make):
    rows = [(i, f"text {i % 7}") for i in range(3000)]
    weights = [1.0, 2.0, 0.0, 1.0]
    got = sharding.slots(sharding.shard(make(rows), weights, weights + [1.0])).collect()
    assert len(got) == 3000
    for r in got[:400]:
        assert r["_shard"] == plain(r["doc_id"], weights) and r["_grown_shard"] == plain(r["doc_id"], weights + [1.0])
        assert r["_crc32"] == zlib.crc32(r["text"].encode()) and r["_size"] == len(r["text"].encode()) + 16
    moved = [r for r in got if r["_shard"] != r["_grown_shard"]]
    assert moved and all(r["_grown_shard"] == 4 for r in moved)
    sizes = Counter(r["_shard"] for r in got)
    assert 2 not in sizes and abs(sizes[1] - 1500) < 150
    slots = defaultdict(list)
    for r in got:
        slots[r["_shard"]].append(r["_slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_edges(spark, make):
    got = sharding.slots(sharding.shard(make(EDGES), [1.0] * 3)).collect()
    assert len(got) == len(EDGES) and all(r["_grown_shard"] is None for r in got)
    assert {r["_size"] for r in got if r["doc_id"] in (1, 2)} == {16}
    assert len({r["_shard"] for r in got if r["doc_id"] == 5}) == 1
    assert sharding.slots(sharding.shard(spark.createDataFrame([], SCHEMA), [1.0])).count() == 0


def test_no_python(make):
    plan = sharding.slots(sharding.shard(make([(1, "a")]), [1.0] * 40))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
