"""Sources, sinks, staging and topic options."""

import glob
import os
from unittest import mock

import pytest

from stationcast import session, sinks, sources
from stationcast.operators import document_messages


def test_files_and_partitions_of_a_table(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "CAST(id % 3 AS INT) AS part")
    sinks.write_table(df.coalesce(1), str(tmp_path / "a"), max_records=300)
    assert len(glob.glob(str(tmp_path / "a" / "*.snappy.parquet"))) == 4
    sinks.write_table(df.repartition(8), str(tmp_path / "c"), merge_small=True)
    assert len(glob.glob(str(tmp_path / "c" / "*.snappy.parquet"))) == 1
    sinks.write_table(df, str(tmp_path / "b"), partition_by=["part"])
    assert len(glob.glob(str(tmp_path / "b" / "part=*" / "*.parquet"))) == 3
    sinks.write_table(df.where("id < 10"), str(tmp_path / "b"), partition_by=["part"])
    assert spark.read.parquet(str(tmp_path / "b")).count() == 10


def test_csv_keeps_text_and_reads_empty_as_null(spark, tmp_path):
    rows = [("2016-01-01 00:00:00", "007", None), ("2016-01-01 01:00:00", "1.50", "x")]
    df = spark.createDataFrame(rows, "datetime string, Chicago string, `New York` string")
    sinks.write_csv(df, str(tmp_path / "c"))
    one = sources.read_measure(spark, str(tmp_path / "c"), "New York", "humidity")
    assert sorted(map(tuple, one.collect()), key=str) == sorted(
        [("2016-01-01 00:00:00", None), ("2016-01-01 01:00:00", "x")], key=str
    )
    two = sources.read_measure(spark, str(tmp_path / "c"), "Chicago", "humidity")
    assert {r["humidity"] for r in two.collect()} == {"007", "1.50"}
    with pytest.raises(ValueError, match="Boston"):
        sources.read_measure(spark, str(tmp_path / "c"), "Boston", "humidity")


def test_only_the_chosen_city_is_read(spark, tmp_path):
    df = spark.createDataFrame([("a", "1", "2")], "datetime string, Chicago string, Boston string")
    sinks.write_csv(df, str(tmp_path / "c"))
    plan = sources.read_measure(spark, str(tmp_path / "c"), "Chicago", "humidity")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<datetime:string,Chicago:string>" in text


def test_station_filter_reaches_the_document_scan(spark, tmp_path):
    spark.createDataFrame([('{"from_station_id": 7, "latitude": "1"}',)], "value string").write.text(
        str(tmp_path / "d")
    )
    documents = sources.read_documents(spark, str(tmp_path / "d"))
    plan = documents.where("from_station_id = 7")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(from_station_id,7)" in plan
    assert document_messages(documents).first()["value"] == '{"from_station_id":7,"latitude":"1"}'


def test_staged_tables_lie_in_the_shared_folder_and_have_no_lineage(spark):
    staged = session.stage(spark.range(10).repartition(3), "numbers")
    assert staged.count() == 10
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Range" not in plan
    folder = spark.conf.get("spark.checkpoint.dir")
    assert all(path.removeprefix("file://").startswith(folder) for path in staged.inputFiles())


def test_cluster_without_a_shared_folder_is_refused():
    cluster = mock.Mock()
    cluster.conf.get.return_value = None
    for master in ("spark://host:7077", "local-cluster[3,2,1024]", "yarn"):
        cluster.sparkContext.master = master
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.shared_folder(cluster)
    for master in ("local", "local[*]", "local[8]"):
        cluster.sparkContext.master = master
        assert session.shared_folder(cluster)


def test_staged_tables_of_a_job_are_deleted(spark, tmp_path):
    with session.staging(spark):
        inner = session.stage(spark.range(3), "numbers")
        files = [path.removeprefix("file://") for path in inner.inputFiles()]
        inner.write.parquet(str(tmp_path / "result"))
        assert all(map(os.path.exists, files)) and files
    assert not any(map(os.path.exists, files))
    assert spark.read.parquet(str(tmp_path / "result")).count() == 3
    outside = session.stage(spark.range(3), "numbers")
    assert outside.count() == 3


class Recorder:
    """Stands in for a reader or writer and notes what it is told."""

    def __init__(self):
        self.calls = {}

    def format(self, name):
        self.calls["format"] = name
        return self

    def option(self, key, value):
        self.calls[key] = value
        return self

    def load(self):
        return mock.Mock()

    def save(self):
        self.calls["saved"] = True


def test_topic_is_read_from_its_start():
    """Options only: the connector is not part of a plain Spark distribution."""
    fake = mock.Mock(read=Recorder(), readStream=Recorder())
    with mock.patch("stationcast.sources.predictions.F"):
        sources.read_topic(fake, "host:9092", "rentals")
        sources.read_topic(fake, "host:9092", "rentals", streaming=True, max_records=5000)
    assert fake.read.calls == {
        "format": "kafka",
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "rentals",
        "startingOffsets": "earliest",
    }
    assert fake.readStream.calls["maxOffsetsPerTrigger"] == 5000
    with pytest.raises(ValueError, match="max_records"):
        sources.read_topic(fake, "host:9092", "rentals", max_records=5000)


def test_topic_gets_one_value_per_document():
    writer = Recorder()
    with mock.patch("stationcast.sinks.writers.document_messages") as messages:
        messages.return_value = mock.Mock(write=writer)
        sinks.write_topic(mock.sentinel.documents, "host:9092", "rentals")
    messages.assert_called_once_with(mock.sentinel.documents, True)
    assert writer.calls == {
        "format": "kafka", "kafka.bootstrap.servers": "host:9092", "topic": "rentals", "saved": True,
    }
