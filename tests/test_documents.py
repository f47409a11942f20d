"""Prediction documents: nesting, JSON, files, lookup and stream."""

import json

import pytest
from pyspark.sql import functions as F

from stationcast import operators as ops
from stationcast import sinks, sources, streaming
from stationcast.schemas import PREDICTION_DOCUMENT

SCORED_SCHEMA = (
    "from_station_id int, latitude string, longitude string, mean_dpcapacity_start double, "
    "mean_dpcapacity_end double, sum_subscriber bigint, sum_customer bigint, date string, "
    "part_time string, prediction double, weather_description_mf string, week_days string, "
    "holiday string, humidity double, pressure double, temperature double, wind_speed double"
)


def scored_rows():
    rows = []
    for station in (1, 2, 3):
        for date in ("2019-07-04", "2019-07-03"):
            for i, part in enumerate(("Night", "Afternoon", "Morning", "Early Morning")):
                rows.append(
                    (station, "41.8", "-87.6", 15.0, 11.0, 5, 4, date, part,
                     [2.9, -1.7, float("nan"), None][i], "Clear", "Monday", "no",
                     50.0, None if i == 0 else 1000.0, 290.0, 1.5)
                )
    return rows


@pytest.fixture
def documents(spark):
    return ops.prediction_documents(
        spark.createDataFrame(scored_rows(), SCORED_SCHEMA).repartition(5)
    )


def test_lists_are_sorted_and_predictions_cut_toward_zero(documents):
    rows = documents.collect()
    assert len(rows) == 3
    for row in rows:
        assert [d["date"] for d in row["dates"]] == ["2019-07-03", "2019-07-04"]
        for day in row["dates"]:
            got = [(p["part_time"], p["bicycle_rentals"]) for p in day["info"]]
            assert got == [("Afternoon", -1), ("Early Morning", None), ("Morning", None), ("Night", 2)]


def test_schema_is_the_declared_one(documents):
    def plain(schema):
        return json.dumps(schema.jsonValue()).replace('"nullable": false', '"nullable": true').replace(
            '"containsNull": false', '"containsNull": true'
        )

    assert plain(documents.schema) == plain(PREDICTION_DOCUMENT)


def test_one_shuffle_serves_both_levels(documents):
    plan = documents._jdf.queryExecution().executedPlan().toString()
    tail = plan.split("Initial Plan")[-1]
    assert tail.count("Exchange hashpartitioning(from_station_id") == 1


def test_flattened_documents_give_back_the_scored_rows(spark, documents):
    flat = (
        documents.select("from_station_id", F.explode("dates").alias("d"))
        .select("from_station_id", "d.date", F.explode("d.info").alias("i"))
        .select("from_station_id", "date", "i.part_time")
    )
    got = sorted(tuple(r) for r in flat.collect())
    assert got == sorted((r[0], r[7], r[8]) for r in scored_rows())


def test_null_fields_are_left_out_unless_asked_for(documents):
    text = ops.document_messages(documents.where("from_station_id = 1")).first()["value"]
    night = json.loads(text)["dates"][0]["info"][3]
    assert "pressure" not in night and night["bicycle_rentals"] == 2
    full = ops.document_messages(documents, ignore_null_fields=False).first()["value"]
    assert json.loads(full)["dates"][0]["info"][3]["pressure"] is None


@pytest.mark.parametrize(("station", "count"), [(None, 3), (2, 1), ("2", 1), (99, 0)])
def test_lookup(documents, station, count):
    found = ops.lookup_predictions(documents, station).collect()
    assert len(found) == count
    if station is not None:
        assert all(json.loads(r["value"])["from_station_id"] == int(station) for r in found)


def test_lookup_takes_no_expression(documents):
    with pytest.raises(ValueError):
        ops.lookup_predictions(documents, "1 OR 1 = 1")


def test_files_and_stream_give_the_batch_result(spark, documents, tmp_path):
    expected = sorted(map(str, documents.collect()))
    sinks.write_documents(documents, str(tmp_path / "json"))
    assert sorted(map(str, sources.read_documents(spark, str(tmp_path / "json")).collect())) == expected

    ops.document_messages(documents).write.text(str(tmp_path / "messages"))
    batch = streaming.read_predictions(spark.read.text(str(tmp_path / "messages")))
    assert sorted(map(str, batch.collect())) == expected

    def drained():
        stream = streaming.read_predictions(
            streaming.stream_messages(spark, str(tmp_path / "messages"), max_files=1)
        )
        return streaming.drain(stream, str(tmp_path / "table"), str(tmp_path / "progress"))

    assert sorted(map(str, drained().collect())) == expected
    # Nothing new: a second run with the same checkpoint adds nothing.
    assert drained().count() == 3
    extra = documents.where("from_station_id = 1").withColumn("from_station_id", F.lit(4))
    ops.document_messages(extra).write.mode("append").text(str(tmp_path / "messages"))
    assert sorted(r["from_station_id"] for r in drained().collect()) == [1, 2, 3, 4]


def test_raw_messages_stay_text(spark):
    messages = spark.createDataFrame([(bytearray(b'{"a":1}'),)], "value binary")
    assert streaming.read_predictions(messages, raw=True).first()["value"] == '{"a":1}'
