from dataclasses import dataclass

import pytest
from pyspark.sql import functions as F

from postloom.sources import files
from postloom.streaming.dedup import drop_repeats


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", 'x "quoted"\nnext, line', None), ("b", "", "z")], "profile_id string, post_text string, subreddit string")
    for quote_all in (False, True):
        files.write_csv(df.coalesce(1), str(tmp_path / f"c{quote_all}"), quote_all)
        back = files.read_csv(spark, str(tmp_path / f"c{quote_all}"))
        assert [r.post_text for r in back.orderBy("profile_id").collect()][0] == 'x "quoted"\nnext, line'
        assert back.columns == ["profile_id", "post_text", "subreddit"]
        assert files.with_arrival(back.withColumn("_x", F.lit(1))).columns == ["idx", "profile_id", "post_text", "subreddit"]


def test_append_and_maps(spark, tmp_path):
    df = spark.createDataFrame([("AI", "a", "b")], "domain string, raw_label string, canonical string")
    assert files.append_by_key(df, str(tmp_path / "m"), "domain") == [] and files.append_by_key(df, str(tmp_path / "m"), "domain") == ["AI"]
    (tmp_path / "map.json").write_text('{"AI": {"x": "y", "z": "y"}}')
    assert files.read_map(spark, str(tmp_path / "map.json")).count() == 2
    files.write_domains(df, str(tmp_path / "d"))
    files.write_domains(df.withColumn("domain", F.lit("Career")), str(tmp_path / "d"))
    assert spark.read.parquet(str(tmp_path / "d")).count() == 2
    files.reset_domains(spark, str(tmp_path / "d"), ["AI"], str(tmp_path / "e"))
    assert [r.domain for r in spark.read.parquet(str(tmp_path / "e")).collect()] == ["Career"]


def test_progress_and_config(spark, tmp_path):
    p = str(tmp_path / "p")
    assert files.read_progress(spark, p, "idx bigint, status string").count() == 0
    files.append_progress(spark.createDataFrame([(1, "ok", 2)], "idx bigint, status string, _k int"), p)
    assert files.read_progress(spark, p, "idx bigint, status string").collect()[0].status == "ok"

    @dataclass
    class C:
        size: int = 20
        name: str = "x"

    (tmp_path / "c.json").write_text('{"size": 5, "other": 1}')
    assert files.load_config(C, str(tmp_path / "c.json")) == C(5, "x") and files.load_config(C, str(tmp_path / "none")) == C()
    assert "(none)" in files.report("t", {"empty": spark.createDataFrame([], "a int")})


def test_stream_drops_repeats(spark, tmp_path):
    rows = spark.createDataFrame([("2024-01-01 00:00:00", "a", "x"), ("2024-01-01 00:01:00", "a", "x "), ("2024-01-01 00:02:00", "b", "x")], "ts string, profile_id string, post_text string").withColumn("ts", F.col("ts").cast("timestamp"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    query = drop_repeats(stream, "ts").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_map_round_trip(spark, tmp_path):
    rows = [("AI", "a \n{b", "c"), ("AI", "é \"q\"", "d"), ("Career", "a", None), ("AI", "a \n{b", "b"), (None, "x", "y"), ("AI", None, "y")]
    df = spark.createDataFrame(rows, "domain string, raw_label string, canonical string")
    files.write_map(df, str(tmp_path / "m"))
    want = [("AI", "a \n{b", "b"), ("AI", "é \"q\"", "d"), ("Career", "a", None)]
    assert sorted(tuple(r) for r in files.read_map(spark, str(tmp_path / "m")).collect()) == want
    import json

    for indent in (None, 2):
        (tmp_path / "one.json").write_text(json.dumps({"AI": {"a": "b"}, "Career": {"c": "d"}}, indent=indent))
        assert sorted(tuple(r) for r in files.read_map(spark, str(tmp_path / "one.json")).collect()) == [("AI", "a", "b"), ("Career", "c", "d")]
    files.write_map(df.limit(0), str(tmp_path / "none"))
    assert files.read_map(spark, str(tmp_path / "none")).count() == 0


def test_too_many_known_keys(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "MAX_KEYS", 2)
    df = spark.range(3).withColumnRenamed("id", "k")
    assert files.append_by_key(df, str(tmp_path / "k"), "k") == []
    with pytest.raises(ValueError):
        files.append_by_key(df, str(tmp_path / "k"), "k")
    assert spark.read.parquet(str(tmp_path / "k")).count() == 3
