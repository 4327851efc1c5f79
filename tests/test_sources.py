"""CSV and Parquet scans, sinks and landing."""

from __future__ import annotations

from types import SimpleNamespace

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from textpipe.functions.text import NA_TOKENS
from textpipe.sources import local, scratch
from textpipe.sources.corpus import (
    land_corpus,
    read_split,
    scan_corpus,
    scan_csv,
    write_csv,
    write_split,
)
from textpipe.sources.scratch import scratch_path

TRICKY = [
    "plain",
    'says "hello", twice',
    "line one\nline two",
    "  outer spaces  ",
    "back\\slash \\n",
    "carriage\r\nreturn",
    '"',
    "comma, comma",
    "trailing\\",
    "é ж 日本",
]


def test_csv_round_trip(spark, tmp_path):
    rows = [(i, text, i % 4) for i, text in enumerate(TRICKY)]
    write_csv(spark.createDataFrame(rows, "doc_id long, text string, label int"), str(tmp_path / "c"))
    back = scan_csv(spark, str(tmp_path / "c"))
    assert back.dtypes == [("doc_id", "string"), ("text", "string"), ("label", "int")]
    typed = scan_csv(spark, str(tmp_path / "c"), types={"doc_id": "bigint", "label": "int"})
    assert typed.dtypes == [("doc_id", "bigint"), ("text", "string"), ("label", "int")]
    assert sorted(map(tuple, typed.collect())) == rows


def test_csv_with_text_ids(spark, tmp_path):
    rows = [(f"abc-{i}", "a text", i % 4) for i in range(8)]
    write_csv(spark.createDataFrame(rows, "doc_id string, text string, label int"), str(tmp_path / "c"))
    assert sorted(map(tuple, scan_csv(spark, str(tmp_path / "c")).collect())) == rows


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aN\",\n\r \\\t'é\u00a0#", min_size=1, max_size=12), min_size=20, max_size=60))
def test_csv_round_trip_property(spark, texts):
    rows = [(i, text, i % 4) for i, text in enumerate(texts)]
    path = scratch_path(spark, "csv")
    write_csv(spark.createDataFrame(rows, "doc_id long, text string, label int"), path)
    expected = [(i, None if text in NA_TOKENS else text, label) for i, text, label in rows]
    typed = scan_csv(spark, path, types={"doc_id": "bigint", "label": "int"})
    assert sorted(map(tuple, typed.collect())) == expected


def test_csv_binds_by_name_and_reads_na(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text('label,text\n0,NA\n1,""\n2,\n3,"a ""b"", c\nd"\n,"   "\n', encoding="utf-8")
    got = scan_csv(spark, str(path)).select("text", "label").collect()
    assert [tuple(r) for r in got] == [
        (None, 0), (None, 1), (None, 2), ('a "b", c\nd', 3), ("   ", None)
    ]


def test_csv_is_divided_if_the_caller_says_so(spark, tmp_path):
    rows = [(i, f'cell "{i}", plain', i % 4) for i in range(2000)]
    flat, types = str(tmp_path / "flat"), {"doc_id": "bigint", "label": "int"}
    write_csv(spark.createDataFrame(rows, "doc_id long, text string, label int").coalesce(1), flat)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        divided, whole = (scan_csv(spark, flat, m, types) for m in (False, True))
        assert divided.rdd.getNumPartitions() > 8 and whole.rdd.getNumPartitions() == 1
        assert sorted(map(tuple, divided.collect())) == sorted(map(tuple, whole.collect())) == rows
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("n_files", [1, 20])
def test_csv_is_read_alike_however_many_files(spark, tmp_path, n_files):
    """A cell over two lines, and a lone quote in an unquoted cell on each of them."""
    for k in range(n_files):
        text = 'size,text,more,label\n5" pipe,"line one\nline two",6" pipe,1\n'
        (tmp_path / f"{k}.csv").write_text(text, encoding="utf-8")
    got = scan_csv(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in got] == [('5" pipe', "line one\nline two", '6" pipe', 1)] * n_files


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_csv_bad_number_fails(spark, tmp_path, ansi):
    path = tmp_path / "raw.csv"
    path.write_text("text,label\na,one\n", encoding="utf-8")
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="Not a valid int: one"):
            scan_csv(spark, str(path)).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_csv_with_another_header_in_a_later_file_fails(spark, tmp_path):
    (tmp_path / "a.csv").write_text("text,label\nx,1\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("label,text\n1,x\n", encoding="utf-8")
    with pytest.raises(Exception, match="CSV header"):
        scan_csv(spark, str(tmp_path)).collect()


def test_json_corpus(spark, tmp_path):
    path = tmp_path / "raw.json"
    path.write_text('{"label": 1, "text": "a\\nb", "more": 0}\n{"text": null, "label": 2}\n', encoding="utf-8")
    found = scan_corpus(spark, str(path), "json")
    assert found.dtypes == [("label", "int"), ("more", "bigint"), ("text", "string")]
    rows = [(None, 2), ("a\nb", 1)]
    assert sorted(map(tuple, found.select("text", "label").collect()), key=str) == sorted(rows, key=str)
    given = scan_corpus(spark, str(path), "json", "text string, label int")
    assert sorted(map(tuple, given.collect()), key=str) == sorted(rows, key=str)
    path.write_text('{"label": "x", "text": "a"}\n', encoding="utf-8")
    with pytest.raises(Exception, match="Not a valid int: x"):
        scan_corpus(spark, str(path), "json").collect()
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        scan_corpus(spark, str(path), "json", "text string, label int").collect()


def test_missing_path(spark, tmp_path):
    for fmt in ("csv", "parquet", "json"):
        with pytest.raises(FileNotFoundError, match="File not found: .*nowhere"):
            scan_corpus(spark, str(tmp_path / "nowhere"), fmt)


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_landing_adds_unique_ids_and_replaces(spark, tmp_path, fmt):
    path = str(tmp_path / "raw")
    for n in (50, 20):
        rows = spark.createDataFrame([("same text", i % 2) for i in range(n)], "text string, label int")
        land_corpus(rows.repartition(4), path, fmt)
        back = scan_corpus(spark, path, fmt)
        id_type = "string" if fmt == "csv" else "bigint"
        assert dict(back.dtypes) == {"doc_id": id_type, "text": "string", "label": "int"}
        assert back.count() == n == back.select("doc_id").distinct().count()


def test_split_table_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "split")
    rows = [(i, f"t{i}", i % 3, "train" if i % 5 else "test") for i in range(20)]
    write_split(spark.createDataFrame(rows, "doc_id long, text string, label int, split string"), path)
    test = read_split(spark, path, "test")
    assert test.columns == ["doc_id", "text", "label"] and test.count() == 4
    plan = test._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_broadcast_is_behind_a_check_of_the_bytes(spark, monkeypatch):
    """Few rows with long terms are too much, more rows with short ones are not."""
    monkeypatch.setattr(local, "BROADCAST_BYTES", 1000)
    schema = StructType([StructField("id", LongType()), StructField("name", StringType())])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for n, name, node in ((20, "x", "BroadcastHashJoin"), (3, "x" * 500, "SortMergeJoin")):
            rows = [(i, name) for i in range(n)]
            joined = spark.range(30).join(local.small_table(spark, rows, schema), "id")
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert node in plan and "LocalTableScan" in plan and joined.count() == n
            table = spark.createDataFrame(rows, schema)
            size = local.measured_bytes(table)
            assert size == n * (8 + len(name))
            assert (local.broadcast_if_small(table, size) is table) == (size > 1000)
        assert local.local_table(spark, [], schema).count() == 0
        assert local.measured_bytes(local.local_table(spark, [], schema)) == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def session(shared=None, checkpoint_dir=None, master="local[2]"):
    conf = SimpleNamespace(get=lambda name, default: shared or default)
    context = SimpleNamespace(getCheckpointDir=lambda: checkpoint_dir, master=master)
    return SimpleNamespace(conf=conf, sparkContext=context)


def test_scratch_follows_the_session(spark, monkeypatch):
    monkeypatch.setattr(scratch, "_made", [])
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    on_yarn = {"master": "yarn"}
    assert scratch_path(session("hdfs:/shared/", **on_yarn), "x").startswith("hdfs:/shared/x-")
    assert scratch_path(session(None, "hdfs:/c/1", **on_yarn), "x").startswith("hdfs:/c/1/x-")
    for master in ("yarn", "local-cluster[2,1,512]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_path(session(master=master), "x")
    assert scratch_path(session(), "x").startswith("file:///")


def test_scratch_is_deleted_where_it_is(spark, monkeypatch):
    monkeypatch.setattr(scratch, "_made", [])
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    scratch.delete_scratch(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
