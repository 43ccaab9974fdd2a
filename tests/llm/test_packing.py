import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from edges import EDGES, LONG, SCHEMA
from tradeloom.llm import packing, queries

PATH, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.mark.parametrize("text", [
    "", "Hello there,  world\n\n it's 12345 ok", "ß é ñ ü ¿qué? ‘x’ — …", "日本語 текст ١٢٣ 😀", "<|endoftext|> a", "a" * 5000, " \t\n \x1c x", LONG[:20000],
    "don't DON'T we'll", " x y　z", "###&&&***$$$%%%!!",
])
def test_both_encoders_agree(text):
    want = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert packing.encoder(PATH, RANKS)(text) == want == packing.encoder(PATH, None)(text)


def test_cut():
    assert packing.cut(5, 8) == [(0, 5)] and packing.cut(8, 8) == [(0, 8)] and packing.cut(17, 8) == [(0, 1), (1, 8), (9, 8)]
    assert packing.cut(16, 8) == [(0, 8), (8, 8)]


def valid(rows, cap=2048):
    """Number of sequences; no overlap, no gap, none too long."""
    at = defaultdict(list)
    for r in rows:
        at[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in at.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= cap
    return len(at)


def test_packed_query(spark, make):
    got = queries.packed(make(EDGES)).collect()
    valid(got)
    tok = Tokenizer.from_file(PATH)
    want = []
    for doc_id, text in [e[:2] for e in EDGES]:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(str(doc_id), k, s, n, zlib.crc32(ids[s:s + n].tobytes())) for k, (s, n) in enumerate(packing.cut(len(ids), 2048))]
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
    assert queries.packed(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("sizes, saved", [
    (np.random.default_rng(4).integers(300, 1000, 2000), 12),  # about three a bin: best fit leaves gaps
    (np.concatenate([np.random.default_rng(4).integers(1, 2049, 1500), np.full(50, 2048), np.full(200, 700)]), 0),
])
def test_islands_beat_plain_best_fit(spark, sizes, saved):
    items = spark.createDataFrame([(int(i), int(s)) for i, s in enumerate(sizes)], "item long, length long")
    rows = packing.assign(items).join(items, "item").collect()
    assert len(rows) == len(sizes)
    used, plain = valid(rows), len(np.unique(packing.fresh(sizes, 2048, np.random.default_rng(1), 0.0)))
    assert packing.bound(sizes, 2048) <= used <= plain - saved


def test_more_epochs_are_never_worse():
    sizes, rng = np.random.default_rng(5).integers(300, 1000, 900), np.random.default_rng(1)
    used = lambda p: int(p.max()) + 1
    plain = packing.fresh(sizes, 2048, rng, 0.0)
    first = packing.evolve(sizes, 2048, 1, [], steps=40)
    guest = packing.evolve(sizes, 2048, 2, [], steps=40)
    later = packing.evolve(sizes, 2048, 3, [first, guest], steps=40)
    assert used(later) <= min(used(first), used(guest)) and max(used(first), used(guest)) <= used(plain)
    assert used(later) < used(plain)


def test_bound_against_all_packings():
    def fewest(items, gaps, cap):
        if not items:
            return len(gaps)
        tries = [fewest(items[1:], [*gaps[:i], g - items[0], *gaps[i + 1:]], cap) for i, g in enumerate(gaps) if g >= items[0]]
        return min([*tries, fewest(items[1:], [*gaps, cap - items[0]], cap)])

    rng = np.random.default_rng(8)
    for cap in (10, 11):
        for _ in range(60):
            sizes = rng.integers(1, cap + 1, rng.integers(1, 7))
            best, least = fewest([*sizes.tolist()], [], cap), packing.bound(sizes, cap)
            assert -(-int(sizes.sum()) // cap) <= least <= best
    assert packing.bound(np.array([], np.int64), 10) == 0


def test_crossover_keeps_every_document():
    rng = np.random.default_rng(6)
    sizes = rng.integers(1, 100, 500)
    a, b = (packing.fresh(sizes, 100, rng, n) for n in (0.0, 0.5))
    child = packing.cross(a, b, sizes, 100, rng)
    assert (child >= 0).all() and packing.fills(child, sizes).max() <= 100
