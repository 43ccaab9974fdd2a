"""Properties over generated data."""

from datetime import date, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradeloom.operators import dedup, incremental, postings, state
from tradeloom.sources import schemas

few = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
pairs = st.lists(st.tuples(st.integers(0, 4), st.integers(0, 9)), min_size=1, max_size=30)


@few
@given(data=pairs)
def test_dedup_keeps_each_key_once_and_is_idempotent(spark, rows, data):
    df = spark.createDataFrame(data, "k int, v int")
    once = dedup.last_wins(df, ["k"], ["v"])
    assert rows(once) == sorted(((k, max(v for x, v in data if x == k)) for k in {k for k, _ in data}), key=str)
    assert rows(dedup.last_wins(once, ["k"], ["v"])) == rows(once)


@few
@given(old=pairs, new=pairs)
def test_upsert_twice_is_upsert_once(spark, rows, old, new):
    first = dedup.last_wins(spark.createDataFrame(old, "k int, v int"), ["k"], ["v"])
    staged = spark.createDataFrame(new, "k int, v int")
    once = state.upsert(first, staged, ["k"], ["v"])
    want = dict(sorted(old)) | dict(sorted(new))
    assert rows(once) == sorted(want.items(), key=str)
    assert rows(state.upsert(once, staged, ["k"], ["v"])) == rows(once)


@few
@given(data=st.lists(st.tuples(st.sampled_from("AB"), st.integers(0, 500)), min_size=1, max_size=120),
       size=st.integers(1, 20), buckets=st.integers(1, 9))
def test_batches_hold_every_key_once_and_are_full(spark, data, size, buckets):
    df = spark.createDataFrame(data, "owner string, sku int")
    got = incremental.key_batches(df, "owner", "sku", size, buckets=buckets).collect()
    assert sorted((r["owner"], r["sku"]) for r in got) == sorted(set(data))
    for owner in {o for o, _ in data}:
        mine = [r for r in got if r["owner"] == owner]
        counts = {}
        for r in mine:
            counts[r["batch"]] = counts.get(r["batch"], 0) + 1
        last = max(counts)
        assert sorted(counts) == list(range(last + 1))
        assert all(n == size for b, n in counts.items() if b < last) and counts[last] <= size
        assert len({(r["batch"], r["position"]) for r in mine}) == len(mine)


@few
@given(data=st.lists(st.tuples(st.dates(date(2019, 1, 1), date(2024, 12, 31)), st.integers(0, 900)), min_size=1, max_size=20),
       months=st.integers(1, 5))
def test_pieces_cover_the_range_without_gaps(spark, data, months):
    ranges = [(i, d, d + timedelta(days=n)) for i, (d, n) in enumerate(data)]
    df = spark.createDataFrame(ranges, "id int, a date, b date")
    got = incremental.range_pieces(df, "a", "b", months).orderBy("id", "piece").collect()
    for i, first, last in ranges:
        mine = [r for r in got if r["id"] == i]
        assert mine[0]["piece_from"] == first and mine[-1]["piece_to"] == last
        assert all(x["piece_to"] == y["piece_from"] for x, y in zip(mine, mine[1:]))
        assert all(r["piece_from"] < r["piece_to"] for r in mine) or first == last


@few
@given(data=st.lists(st.lists(st.integers(1, 5), max_size=6), min_size=1, max_size=8))
def test_flatten_gives_one_row_per_product(spark, data):
    docs = [(n, skus) for n, skus in enumerate(data)]
    lit = spark.createDataFrame(docs, "n int, skus array<bigint>")
    finance = "transform(array_distinct(skus), s -> named_struct('product_id', s, 'commission_amount', cast(s as double)))"
    pages = lit.select(F.to_json(F.expr(f"""named_struct('result', array(named_struct('posting_number', cast(n as string),
        'created_at', '2024-02-01T00:00:00Z', 'products', transform(skus, s -> named_struct('sku', s)),
        'financial_data', named_struct('products', {finance}))))""")).alias("j")) \
        .select(F.from_json("j", schemas.FBO_PAGE).alias("p")).select("p.result")
    out = postings.flatten_fbo(pages, "O", 1, date(2024, 1, 1)).select("posting_number", "sku", "product_id").collect()
    assert sorted((int(r[0]), r[1]) for r in out) == sorted((n, s) for n, skus in docs for s in skus)
    assert all(r["sku"] == r["product_id"] for r in out)


@few
@given(data=st.lists(st.integers(0, 10**6), min_size=1, max_size=20), since=st.integers(0, 10**6))
def test_cursor_never_goes_back(spark, data, since):
    df = spark.createDataFrame([(n,) for n in data], "n bigint").select(F.timestamp_seconds("n").cast("timestamp_ntz").alias("ts"))
    at = F.timestamp_seconds(F.lit(since)).cast("timestamp_ntz")
    got = incremental.next_cursor(df, "ts", since=at).select(F.unix_micros(F.col("cursor").cast("timestamp"))).first()[0]
    assert got == (max([since, *data]) + 1) * 1_000_000
