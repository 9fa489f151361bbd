import codecs
import csv
import io
import random

import pytest

from tidemark import config as C
from tidemark.sources import csv_history

CSV = "olist_orders_dataset.csv"


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()

    def write(content: bytes, name: str = CSV):
        (folder / name).write_bytes(content)
        return str(folder)

    return write


def load(lake, folder, batch_id, table="orders", name=CSV):
    return csv_history.load_history(lake, folder, batch_id, {name: table})


@pytest.mark.parametrize("quoted_break", [False, True])
def test_text_rules(lake, raw, quoted_break):
    note = b'"two\nlines"' if quoted_break else b"plain"
    folder = raw(
        codecs.BOM_UTF8 + b'id,note,more\n1,NA,\n\n2,"",x\n3,"say ""hi""",null\n4,'
        + note + b", s \n5,short\n"
    )
    assert csv_history.spans_lines(lake.spark, f"{folder}/{CSV}") is quoted_break
    summary = load(lake, folder, "b1").collect()
    assert [(r.table_name, r.row_count) for r in summary] == [("orders", 5)]
    df = lake.read("bronze", "orders")
    assert df.columns == ["id", "note", "more", *C.LINEAGE]
    assert all(f.dataType.simpleString() == "string" for f in df.schema.fields)
    rows = {r.id: (r.note, r.more) for r in df.collect()}
    assert rows["1"] == ("NA", None)
    assert rows["2"] == (None, "x")
    assert rows["3"] == ('say "hi"', "null")
    assert rows["4"] == ("two\nlines" if quoted_break else "plain", " s ")
    assert rows["5"] == ("short", None)
    first = df.first()
    assert (first._source_file, first._batch_id) == (CSV, "b1")


@pytest.mark.parametrize("block", [64, 1 << 20])
def test_large_files_with_breaks_are_read_in_parallel(spark, raw, block):
    rng = random.Random(5)
    pieces = ["plain", '"quo""ted"', '"two\nlines"', '"a,b"', "", '""', '"x\n\n""\n,y"', "NA", " s "]
    body = "".join(
        f"{n},{rng.choice(pieces)},{rng.choice(pieces)}\n" + ("\n" if n % 17 == 0 else "")
        for n in range(400)
    ) + "short,1\n"
    path = raw(codecs.BOM_UTF8 + b"id,a,b\n" + body.encode()) + f"/{CSV}"
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    try:
        parallel = csv_history.read_csv_text(spark, path)
        assert parallel.columns == ["id", "a", "b"]
        got = sorted(map(tuple, parallel.collect()), key=str)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    expected = [tuple(c or None for c in r) for r in csv.reader(io.StringIO(body)) if r]
    assert got == sorted([(*r, None) if len(r) == 2 else r for r in expected], key=str)


def test_one_record_rule_for_header_blank_lines_and_line_ends(spark, raw):
    body = b'"i\nd",a\r\n\r\n1,"x\r\ny"\r\n   \r\n2,""\r\n'
    df = csv_history.read_csv_text(spark, raw(body) + f"/{CSV}")
    assert df.columns == ["i\nd", "a"]
    assert sorted(map(tuple, df.collect()), key=str) == [("1", "x\r\ny"), ("2", None)]


def test_unclosed_quote_is_an_error(spark, raw):
    path = raw(b'id,a\n1,"x\n2,y\n') + f"/{CSV}"
    with pytest.raises(ValueError, match="never closed"):
        csv_history.read_csv_text(spark, path)


def test_reload_replaces_and_failure_keeps_the_old_rows(lake, raw):
    load(lake, raw(b"a,b\n1,2\n3,4\n"), "b1")
    load(lake, raw(b"a,b\n5,6\n"), "b2")
    assert [r.a for r in lake.read("bronze", "orders").collect()] == ["5"]
    with pytest.raises(Exception, match="too many cells"):
        load(lake, raw(b"a,b\n7,8\n9,10,11\n"), "b3")
    assert [r.a for r in lake.read("bronze", "orders").collect()] == ["5"]
    assert lake.drop_old_versions("bronze", "orders") == ["version=b1", "version=b3"]
    assert [r.a for r in lake.read("bronze", "orders").collect()] == ["5"]


def test_missing_file_is_named(lake, tmp_path):
    with pytest.raises(FileNotFoundError, match=CSV):
        load(lake, str(tmp_path), "b1")


def test_column_order_follows_the_header(lake, raw):
    load(lake, raw(b"order_status,order_id\ncreated,1\n"), "b1")
    r = lake.read("bronze", "orders").first()
    assert (r.order_id, r.order_status) == ("1", "created")


def test_row_count_is_verified(lake, spark, monkeypatch):
    from pyspark.sql import Observation

    monkeypatch.setattr(Observation, "get", {"rows": 99})
    with pytest.raises(ValueError, match="row count mismatch"):
        lake.replace("bronze", "t", spark.range(3), "v1")
    assert not lake.state("bronze", "t").exists


def test_a_version_is_written_once(lake, spark):
    lake.replace("bronze", "t", spark.range(3), "v1")
    with pytest.raises(ValueError, match="already committed"):
        lake.replace("bronze", "t", spark.range(4), "v1")


def test_registry_covers_all_files():
    assert len(C.HISTORY_FILES) == 9 and len(set(C.HISTORY_FILES.values())) == 9


@pytest.mark.parametrize("rows", [1, 7, 10_000])
def test_records_over_blocks_and_batches(spark, raw, rows):
    """Records longer than a block, files without a record's end in their first blocks, blank lines before the header."""
    long = "\n".join(f"line {i}" for i in range(60))
    body = f'\n  \nid,a\n1,"{long}"\n2,x\n\n3,"y\n"\n4,"{long}\n\n"\n'
    folder = raw(body.encode())
    raw(b'id,a\n5,"two\nlines"\n', "other.csv")
    confs = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.execution.arrow.maxRecordsPerBatch": str(rows)}
    for key, value in confs.items():
        spark.conf.set(key, value)
    try:
        df = csv_history.read_csv_text(spark, folder)
        got = sorted(map(tuple, df.collect()))
    finally:
        for key in confs:
            spark.conf.unset(key)
    assert got == [("1", long), ("2", "x"), ("3", "y\n"), ("4", f"{long}\n\n"), ("5", "two\nlines")]


def test_lines_are_not_shuffled(spark, raw):
    """Windows and exchanges see one row a block, and the pieces of records that leave their block."""
    plan = csv_history.logical_records(spark, raw(b'id,a\n1,"x\ny"\n') + f"/{CSV}")._jdf.queryExecution().sparkPlan()

    def windows(node):
        if node.nodeName() == "Window":
            yield node.child().output().mkString(",")
        children = node.children()
        for i in range(children.size()):
            yield from windows(children.apply(i))

    found = list(windows(plan))
    assert found and not any("value#" in columns for columns in found)
