from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tradeloom.session import shared_dir
from tradeloom.sources import landing, sinks


def write(path, text, encoding="utf-8"):
    path.write_text(text, encoding=encoding)
    return str(path)


def test_unreadable_pages_are_kept_apart(spark, land, rows):
    folder = land("x", {"items": [{"id": "1", "quantity": 2}]}, '{"items": [broken')
    pages = landing.pages(spark, folder, "erp_stock").cache()
    assert [r[0].split("|")[2] for r in rows(landing.good(pages), "page")] == ["p0.json"]
    assert [r[0].split("|")[2] for r in rows(landing.bad(pages), "page")] == ["p1.json"]
    with pytest.raises(Exception, match="unreadable page: .*p1.json"):
        landing.strict(pages).collect()
    pages.unpersist()


def test_owner_folder_becomes_a_column(spark, land, tmp_path, rows):
    (tmp_path / "in").mkdir()
    land("in/owner=A", {"items": [{"id": "1", "name": "n"}]})
    land("in/owner=B", {"items": []})
    pages = landing.pages(spark, str(tmp_path / "in"), "erp_items")
    assert rows(landing.good(pages).selectExpr("owner", "size(items)")) == [("A", 1), ("B", 0)]


def test_documents_by_line(spark, land, rows):
    folder = land("l", '{"items":[{"id":"1"}]}\n{"items":[{"id":"2"}]}\n')
    pages = landing.good(landing.pages(spark, folder, "erp_items", lines=True))
    assert sorted(r[0] for r in pages.selectExpr("items[0].id").collect()) == ["1", "2"]


def test_report_files(spark, tmp_path, rows):
    columns = [f"c{i}" for i in range(12)]
    head, row = ";".join(columns), ";".join(f'"v{i};x"' for i in range(12))
    write(tmp_path / "orders_fbo_20240101_20240331.csv", f"{head}\n{row}\n", "utf-8-sig")
    write(tmp_path / "orders_fbs_20240101_20240331.csv", f"{head}\n{row}\n{row.replace('v9', 'w9')}\n", "utf-8-sig")
    write(tmp_path / "other.csv", f"{head}\n{row.replace('v9', 'z9')}\n")
    out = landing.report_files(spark, str(tmp_path), columns)
    assert rows(out, "scheme", "c9", "period_from") == [
        ("FBO", "v9;x", date(2024, 1, 1)), ("FBS", "v9;x", date(2024, 1, 1)), ("FBS", "w9;x", date(2024, 1, 1))]
    assert rows(landing.report_ids(spark, str(tmp_path))) == [("v9;x",), ("w9;x",), ("z9;x",)]


def test_staged_text_keeps_texts_as_they_are(spark, tmp_path, rows):
    path = write(tmp_path / "s.tsv", '00123\tNA\t1\n007\t"a\t""b"""\t2\nx\tNone\tbad\n')
    df = landing.staged_text(spark, path, "barcode string, name string, n int").cache()
    assert rows(df.filter("_corrupt is null"), "barcode", "name", "n") == [("00123", "NA", 1), ("007", 'a\t"b"', 2)] or \
        rows(df.filter("_corrupt is null"), "barcode", "name", "n") == [("007", 'a\t"b"', 2), ("00123", "NA", 1)]
    assert rows(df.filter("_corrupt is not null"), "_corrupt") == [("x\tNone\tbad",)]
    df.unpersist()


def test_control_table(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    spark.createDataFrame([("WB", "A")], "source string, owner string").write.parquet(path)
    assert rows(landing.control_table(spark, path)) == [("WB", "A")]


def frame(spark, *data):
    return spark.createDataFrame(data, "owner string, n int")


def test_load_and_replace_slices(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    sinks.replace_slices(frame(spark, ("A", 1), ("B", 2)), path, ["owner"])
    sinks.replace_slices(frame(spark, ("A", 3), ("A", 4)), path, ["owner"], hot_files=4)
    sinks.replace_slices(frame(spark, ("A", 3), ("A", 4)), path, ["owner"], hot_files=4)
    assert rows(spark.read.parquet(path), "owner", "n") == [("A", 3), ("A", 4), ("B", 2)]
    sinks.replace_slices(frame(spark, (None, 7)), path, ["owner"])
    # A came back empty, the rows without an owner came back new.
    sinks.replace_slices(frame(spark, (None, 8)), path, ["owner"], slices=[{"owner": "A"}, {"owner": None}, {"owner": "never seen"}])
    assert rows(spark.read.parquet(path), "owner", "n") == [("B", 2), (None, 8)]
    sinks.load(frame(spark, ("C", 5)), str(tmp_path / "u"))
    sinks.load(frame(spark, ("C", 6)), str(tmp_path / "u"))
    sinks.append(frame(spark, ("C", 7)), str(tmp_path / "u"))
    assert rows(spark.read.parquet(str(tmp_path / "u"))) == [("C", 6), ("C", 7)]


def test_a_failing_load_leaves_the_asked_slices(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    sinks.replace_slices(frame(spark, ("A", 1), ("B", 2)), path, ["owner"])
    bad = frame(spark, ("A", 9)).withColumn("n", F.raise_error(F.lit("no match")).cast("int"))
    with pytest.raises(Exception, match="no match"):
        sinks.replace_slices(bad, path, ["owner"], slices=[{"owner": "A"}, {"owner": "B"}])
    assert rows(spark.read.parquet(path), "owner", "n") == [("A", 1), ("B", 2)]
    sinks.replace_slices(frame(spark, ("A", 3)), path, ["owner"], hot_files=3, slices=[{"owner": "A"}, {"owner": "B"}, {"owner": "A"}])
    assert rows(spark.read.parquet(path), "owner", "n") == [("A", 3)]


def test_require_rows(spark, tmp_path):
    df, path = frame(spark, ("A", 1)), str(tmp_path / "r")
    sinks.write_split(df, path, 10, empty="no data")
    with pytest.raises(ValueError, match="no data"):
        sinks.write_split(df.filter("n > 1"), path, 10, empty="no data")
    sinks.write_split(df.filter("n > 1"), path, 10)
    assert sinks.rows_per_file(30) == 1048576


def test_export_quotes_every_field(spark, tmp_path):
    sinks.export(spark.createDataFrame([("a;b", 1), (None, 2)], "`Номер.` string, n int").coalesce(1), str(tmp_path / "e"))
    (file,) = Path(tmp_path / "e").glob("*.csv")
    assert file.read_text(encoding="utf-8").splitlines() == ['"Номер.";"n"', '"a;b";"1"', '"";"2"']


def test_export_sections(spark, tmp_path):
    sinks.export_sections([frame(spark, ("A", 1)), frame(spark, ("B", 2))], str(tmp_path / "r"))
    assert spark.read.option("header", "true").option("sep", ";").csv(str(tmp_path / "r")).count() == 2
    assert sorted(p.name for p in (tmp_path / "r").iterdir()) == ["section=0", "section=1"]


def test_split_files_lose_no_row(spark, tmp_path):
    path = str(tmp_path / "s")
    sinks.write_split(spark.range(1001).coalesce(1), path, 100)
    assert len(list(Path(path).glob("*.parquet"))) == 11
    assert spark.read.parquet(path).distinct().count() == 1001


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_capped_files(spark, tmp_path, rows):
    path, limit = str(tmp_path / "c"), 1000
    sizes = [1 + i * 7 % 60 for i in range(900)] + [90, 99, 100, 101, 300, 499, 500, 501, 990, 994] * 6
    data = [(i, "é" * (n // 2) if i % 3 == 0 else "x" * n) for i, n in enumerate(sizes)] + [(2000, None), (2001, ""), (2002, 'a\t"b')]
    df = spark.createDataFrame(data, "id int, t string").repartition(5)
    sinks.write_capped(df, path, limit)
    found = [f.stat().st_size for f in Path(path).rglob("*.txt")]
    assert max(found) <= limit and sum(found) > 10 * limit
    # Most files are well filled where rows are small.
    assert sum(s > 800 for s in found) >= 20
    back = landing.staged_text(spark, path, "id int, t string").filter("_corrupt is null")
    assert rows(back, "id", "t") == sorted(((i, t or None) for i, t in data), key=str)
    with pytest.raises(Exception, match="larger than 50 bytes"):
        sinks.write_capped(df, str(tmp_path / "d"), 50)
    sinks.write_capped(df.limit(0), str(tmp_path / "e"), 50)
    assert not list((tmp_path / "e").rglob("*.txt")) or sum(f.stat().st_size for f in (tmp_path / "e").rglob("*.txt")) == 0


def test_readable_and_unreadable_pages_in_folders(spark, land, tmp_path, rows):
    folder = land("x", {"items": [{"id": "1", "quantity": 2}]}, '{"items": [broken', {"items": []})
    landing.split(landing.pages(spark, folder, "erp_stock"), str(tmp_path / "good"), str(tmp_path / "bad"))
    assert spark.read.parquet(str(tmp_path / "good")).count() == 2
    assert [r[0].split("|")[2] for r in rows(spark.read.parquet(str(tmp_path / "bad")), "page")] == ["p1.json"]
