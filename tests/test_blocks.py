"""Large files with separators inside their records, read by several tasks."""

import csv
import io
import json
import random

import pyarrow as pa
import pytest

from tradeloom.sources import blocks, landing, pieces

CELLS = ["a", "", "two\nlines", 'say "x"', 'a,b\n\n"c",\n', "тысяча\n5", "x" * 90, '",\n"', "плита 5"]


@pytest.fixture
def small_blocks(spark):
    """Blocks of 100 bytes: a record may lie in several of them."""
    names = {"spark.sql.files.maxPartitionBytes": "100", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k in names:
        spark.conf.unset(k)


def as_csv(data, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(data)
    return out.getvalue()


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_line_breaks_over_blocks(spark, tmp_path, small_blocks, end):
    draw, want = random.Random(3), []
    for n in range(2):
        data = [[f"{n}-{i}", draw.choice(CELLS), draw.choice(CELLS)] for i in range(60)]
        want += data
        (tmp_path / f"f{n}.csv").write_bytes(("﻿" + as_csv([["Номер", "один", "два\nстроки"], *data], end)).encode())
    read = blocks.delimited(spark, str(tmp_path), ["id", "one", "two"])
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    assert content(read) == sorted([(i, a or None, b or None) for i, a, b in want], key=str)
    if end == "\n":  # the whole-file reader keeps the carriage returns of files that also hold bare line breaks
        split, whole = landing.kz_stock_file(spark, str(tmp_path), split=True), landing.kz_stock_file(spark, str(tmp_path))
        assert split.columns == whole.columns and content(split) == content(whole)


def test_a_quote_amid_a_field_is_text(spark, tmp_path, small_blocks):
    data = 'id,size\n' + "".join(f'{i},труба 5" x\n{i}b,"a\n5"" b"\n' for i in range(40))
    (tmp_path / "f.csv").write_text(data, encoding="utf-8")
    want = [r for i in range(40) for r in ((str(i), 'труба 5" x'), (f"{i}b", 'a\n5" b'))]
    assert content(blocks.delimited(spark, str(tmp_path), ["id", "size"])) == sorted(want, key=str)


def test_records_keep_their_order(spark, tmp_path, small_blocks):
    data = [[str(i), "x\n" * (i % 7)] for i in range(50)]
    (tmp_path / "f.csv").write_text("\n\n" + as_csv([["id", "t"], *data]))
    got = blocks.delimited_records(spark, str(tmp_path)).filter("not _head").orderBy("_block", "_at").collect()
    assert [r["value"].split(",")[0] for r in got] == [d[0] for d in data]


def test_a_field_that_stays_open_takes_the_rest(spark, tmp_path, small_blocks):
    (tmp_path / "f.csv").write_text('id,t\n1,a\n2,"open\n' + "3,b\n" * 30)
    got = dict(content(blocks.delimited(spark, str(tmp_path), ["id", "t"])))
    assert got.keys() == {"1", "2"} and got["2"].endswith("3,b")


def test_empty_and_header_only_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("")
    (tmp_path / "b.csv").write_text("id,t\n")
    assert content(blocks.delimited(spark, str(tmp_path), ["id", "t"])) == []


def elements(draw, n):
    texts = ["a", "", 'q"}{', "b\\", '\\"}]', "}\n{", "[{", "тысяча", "x" * 80]
    return [{"id": f"{n}-{i}", "t": draw.choice(texts), "in": [{"k": draw.choice(texts)} for _ in range(draw.randrange(3))]} for i in range(50)]


@pytest.mark.parametrize("indent", [None, 2])
def test_json_arrays_over_blocks(spark, tmp_path, small_blocks, indent):
    draw, want = random.Random(5), []
    for n in range(2):
        data = elements(draw, n)
        want += data
        (tmp_path / f"p{n}.json").write_text(json.dumps(data, indent=indent, ensure_ascii=n == 0) + "\n" * n, encoding="utf-8")
    (tmp_path / "empty.json").write_text("[]")
    (tmp_path / "one.json").write_text('{"id": "alone", "t": "}", "in": [{"k": "1"}, {"k": "2"}]}')
    want.append({"id": "alone", "t": "}", "in": [{"k": "1"}, {"k": "2"}]})
    schema = "id string, t string, `in` array<struct<k string>>"
    read = blocks.json_rows(spark, str(tmp_path), schema, "_corrupt")
    got = [(r["id"], r["t"], [k["k"] for k in r["in"]]) for r in read.filter("_corrupt is null").collect()]
    assert sorted(got) == sorted((e["id"], e["t"], [k["k"] for k in e["in"]]) for e in want)
    order = [r["id"] for r in read.orderBy("page").collect() if r["id"].startswith("0-")]
    assert order == [f"0-{i}" for i in range(50)] and read.filter("_corrupt is not null").count() == 0


def test_an_array_cut_off_gives_its_rest_as_unreadable(spark, tmp_path, small_blocks):
    (tmp_path / "p.json").write_text(json.dumps([{"id": str(i)} for i in range(30)])[:-4])
    rows = blocks.json_rows(spark, str(tmp_path), "id string", "_corrupt").orderBy("page").collect()
    assert [r["id"] for r in rows[:-1]] == [str(i) for i in range(29)] and rows[-1]["_corrupt"] == '{"id": "2'


def test_pages_of_one_large_array(spark, land, small_blocks):
    rows = [{"srid": f"s{i}", "barcode": '}"{'} for i in range(40)]
    folder = land("wb", rows)
    split = landing.strict(landing.pages(spark, folder, "wb_orders", split=True))
    whole = landing.strict(landing.pages(spark, folder, "wb_orders"))
    assert split.columns == whole.columns and content(split.drop("page")) == content(whole.drop("page"))
    assert [r[0] for r in split.orderBy("page").select("srid").collect()] == [r["srid"] for r in rows]


@pytest.mark.parametrize("kind", ["csv", "json"])
def test_pieces_are_neither_ordered_nor_shuffled(spark, tmp_path, small_blocks, kind):
    """F2 (csv), F3 (json): no task holds the pieces of a whole block, and no text is shuffled but that of crossing records."""
    texts = ['x\n"y",', "a" * 30, '"}{[\\']
    if kind == "csv":
        (tmp_path / "a.csv").write_text(as_csv([[str(i), texts[i % 3]] for i in range(60)]))
        read = blocks.delimited_records(spark, str(tmp_path))
    else:
        (tmp_path / "a.json").write_text(json.dumps([{"id": i, "t": texts[i % 3]} for i in range(60)]))
        read = blocks.json_rows(spark, str(tmp_path), "id int, t string", "_corrupt")
    assert read.count() == 60
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = read._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    above = plan[:plan.index("FileScan text")]
    assert not any(step in above for step in ("Window", "Sort", "Exchange hash", "Aggregate"))
    assert plan.count("FileScan text") == 1


def test_files_that_are_cut_otherwise_than_before_fail(spark, tmp_path, small_blocks):
    (tmp_path / "a.json").write_text(json.dumps([{"id": i} for i in range(60)]))
    read = blocks.json_rows(spark, str(tmp_path), "id int", "_corrupt")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    with pytest.raises(Exception, match="other blocks than before"):
        read.count()


def test_a_document_is_read_once_for_its_fields(spark, land):
    """filters on fields stay above the rows; below, each would read the text anew."""
    folder = land("wb", [{"srid": f"s{i}", "barcode": "1"} for i in range(3)])
    rows = landing.strict(landing.pages(spark, folder, "wb_orders", split=True)).filter("srid is not null and barcode = '1'")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 2 and rows.count() == 3  # once for records inside blocks, once for crossing ones


def test_effects_of_json_pieces():
    """Against a reader that goes from byte to byte; backslashes count inside texts only."""
    def read(text, inside):
        depth, escaped = 0, False
        for c in text:
            if inside and escaped:
                escaped = False
            elif inside and c == "\\":
                escaped = True
            elif c == '"':
                inside = not inside
            elif not inside and c in "{[":
                depth += 1
            elif not inside and c in "}]":
                depth -= 1
        return inside, depth

    draw = random.Random(9)
    for n in (1, 2, 50):
        for _ in range(100):
            some = ["".join(draw.choice('"""{}[]a,ж') + draw.choice(["", "", "\\" * draw.randrange(4) + '"']) for _ in range(draw.randrange(9))) for _ in range(n)]
            some = [t.replace("}", "") + "}" for t in some]
            batch = pa.RecordBatch.from_arrays([pa.array(["left out", *some])[1:]], names=["value"])
            found = pieces.of_json(batch, *pieces.texts(batch.column("value")))
            want = [(*read(t, False), *read(t, True)) for t in some]
            assert [(o, d, i, e) for o, i, d, e in zip(*(x.tolist() for x in found))] == want
            for entered in (False, True):
                state, states = entered, [entered]
                for t in some:
                    state = read(t, state)[0]
                    states.append(state)
                assert pieces.states(found[0], found[1], entered).tolist() == states
