import re
from collections import Counter

import pytest

from edges import EDGES, SCHEMA
from tradeloom.llm import secrets

HEX = "0123456789abcdef0123456789abcdef"


def plain(text):
    out = []
    for m in re.finditer(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        out += [(0, m.start(), m.end())] * (len(m[2]) >= 8)
    for k, p, n in ((1, "AKIA[A-Z0-9]+", 16), (2, "[0-9a-f]+", 32)):
        out += [(k, m.start(), m.end()) for m in re.finditer(p, text) if m.end() - m.start() >= n]
    return sorted(out, key=lambda x: (x[1], x[0]))


@pytest.mark.parametrize("text", [
    "", f"é token = \"{HEX}\" x", "PassWord:'short' secret=longenough1", "AKIA1234 AKIAABCDEFGH1234 AKIAAKIAAKIAAKIA12", f"z{HEX}{HEX}g {HEX[:31]}",
    f"api_key=token=secret:{HEX} apikey: \"abcdefgh", "ſecret=abcdefghi Ksecret=abcdefghij", "token  =  token = abcdefgh1",
])
def test_base(text):
    assert secrets.base_spans(text) == plain(text)


KEY = "Zx81kQpL0vB7nM3cT5yR"


def found(make, texts, **kw):
    rows = secrets.find_secrets(make(list(enumerate(texts)), **kw)).collect()
    return {r["doc_id"]: [(secrets.KINDS[p["kind"]], p["start"], p["end"]) for p in r["spans"]] for r in rows}


def test_weak_parts_need_company(make):
    far = " lorem" * 60
    got = found(make, [
        f"see {KEY} here", "user = someone and nothing else", f"user = someone then {KEY}", f"user = someone{far} {KEY}",
        f"https://db.example.com/x {KEY}", f"https://db.example.com/x{far}", f"user: bob token = \"{HEX}\"", f"https://a.b/c user: bob {far} {KEY}",
    ])
    kinds = {k: [x[0] for x in v] for k, v in got.items()}
    assert kinds[0] == kinds[1] == kinds[3] == kinds[5] == kinds[7] == []
    assert kinds[2] == ["id", "key"] and kinds[4] == ["endpoint", "key"] and kinds[6] == ["id", "assign", "hex"]


def test_links_equal_brute_force(make):
    import numpy as np
    rng = np.random.default_rng(5)
    pieces = [f" {KEY} ", " user=bob ", " https://h.example/p ", f" token={HEX} ", " word" * 12, " AKIAABCDEFGH1234 "]
    texts = ["".join(rng.choice(pieces, 30)) for _ in range(30)]
    got = found(make, texts, parts=4)
    for i, t in enumerate(texts):
        base = secrets.base_spans(t)
        parts = base + secrets.weak_spans(t, base)
        role = lambda p: secrets.ROLES[secrets.KINDS[p[0]]]
        near = lambda a, b: a[1] - b[2] <= 200 and b[1] - a[2] <= 200 and (role(a) == "S") != (role(b) == "S")
        want = [p for p in parts if p[0] < 3 or any(near(p, q) for q in parts)]
        assert sorted(got[i], key=str) == sorted([(secrets.KINDS[k], s, e) for k, s, e in want], key=str)


def test_every_distance_at_every_place(spark):
    """A secret of 200 code points with an identifier 199, 200 or 201 before or behind it, wherever cells begin."""
    part = lambda kind, start, end: {"kind": kind, "start": start, "end": end}
    rows = []
    for at in range(1000, 1200):
        for gap in (199, 200, 201):
            rows.append((len(rows), gap, [part(0, at, at + 200)], [part(3, at + 200 + gap, at + 210 + gap)]))
            rows.append((len(rows), gap, [part(0, at, at + 200)], [part(3, at - gap - 10, at - gap)]))
    rows.append((len(rows), 200, [part(0, 0, 200)], [part(3, 400, 410)]))
    parts = "array<struct<kind:int,start:int,end:int>>"
    found = spark.createDataFrame(rows, f"scope long, scope2 long, base {parts}, weak {parts}")
    got = Counter(r["scope"] for r in secrets.links(found).select("scope").collect())
    assert got == {i: 1 for i, gap, *_ in rows if gap <= 200}


def test_long_key_with_a_late_digit():
    key = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ-_+/=abcdefgh7"
    assert len(key) == 66 and secrets.weak_spans(f"x {key} y", []) == [(4, 2, 68)]
    assert secrets.weak_spans(f"x {key[:-1]} 7", []) == []


def test_edges(spark, make):
    rows = EDGES + [(20, f"token={HEX} " * 3), (20, f"token={HEX} " * 3), (21, f"user=bob {KEY} " * 500)]
    got = secrets.find_secrets(make(rows)).collect()
    assert len(got) == len(rows)
    assert [len(r["base"]) for r in got if r["doc_id"] == 20] == [6, 6]
    assert secrets.find_secrets(spark.createDataFrame([], SCHEMA)).count() == 0


def test_mask(spark, make):
    rows = EDGES + [(20, f"a token = \"{HEX}\" b user=bob {KEY}"), (20, f"a token = \"{HEX}\" b user=bob {KEY}")]
    docs = make(rows)
    got = secrets.mask(docs)
    assert got.columns == docs.columns
    texts = sorted((str(r["doc_id"]), r["text"], r["n_chars"]) for r in got.collect() if r["text"] is not None)
    want = [(str(i), t if i != 20 else 'a <secret>" b <secret> <secret>') for i, t in [r[:2] for r in rows] if t is not None]
    assert texts == sorted((i, t, len(t)) for i, t in want)
    assert got.count() == len(rows) and secrets.mask(spark.createDataFrame([], SCHEMA)).count() == 0
