"""The rental model and the jobs from CSV to documents."""

import csv
import json
import math

import pytest
from pyspark.sql import functions as F

from stationcast import plans
from stationcast.jobs import ingest, lookup, predict, train
from stationcast.plans import model as ml
from stationcast.schemas import TRAINING_COLUMNS
from tests.fixtures import hourly_weather, skewed_trips

FRAME_SCHEMA = (
    "date string, from_station_id int, latitude string, longitude string, "
    "mean_dpcapacity_start double, mean_dpcapacity_end double, sum_subscriber bigint, "
    "sum_customer bigint, part_time string, holiday string, week_days string, "
    "weather_description_mf string, month int, humidity double, pressure double, "
    "temperature double, wind_speed double, bicycle_rentals bigint"
)


def frame_rows(n=200):
    parts = ["Early Morning", "Morning", "Afternoon", "Night"]
    days = ["Monday", "Tuesday", "Sunday"]
    return [
        (f"2016-07-{i % 28 + 1:02d}", i % 9, "41.8", "-87.6", 15.0, 11.0, 10 * (i % 9), i % 9,
         parts[i % 4], "yes" if i % 28 == 3 else "no", days[i % 3], ["Clear", "Rain"][i % 2],
         7, float(40 + i % 30), None if i % 7 == 0 else 1000.0 + i % 5, 290.0 + i % 10, 1.0 * (i % 6),
         1 + (i % 4) * 3 + i % 9)
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(frame_rows(), FRAME_SCHEMA).persist()


@pytest.fixture(scope="module")
def fitted(frame):
    return plans.fit_model(plans.rental_stages(seed=1), frame)


def test_imputer_fills_null_and_nan_with_the_mean(spark):
    df = spark.createDataFrame(
        [(1.0, None), (3.0, 4.0), (float("nan"), 8.0), (None, 6.0)], "humidity double, pressure double"
    )
    got = ml.imputer().fit(df).transform(df).collect()
    assert [r["humidity_input"] for r in got] == [1.0, 3.0, 2.0, 2.0]
    assert [r["pressure_input"] for r in got] == [6.0, 4.0, 8.0, 6.0]


def test_categories_are_numbered_by_frequency_then_name(frame):
    got = ml.indexer().fit(frame).transform(frame)
    pairs = {(r[0], r[1]) for r in got.select("holiday", "holiday_indexed").distinct().collect()}
    assert pairs == {("no", 0.0), ("yes", 1.0)}
    pairs = dict(got.select("part_time", "part_time_indexed").distinct().collect())
    assert pairs == {"Afternoon": 0.0, "Early Morning": 1.0, "Morning": 2.0, "Night": 3.0}


def test_vector_has_the_fourteen_inputs_in_order(frame, fitted):
    row = plans.score(fitted, frame).first()
    assert len(row["features"]) == len(ml.FEATURES) == 14
    assert row["features"][9] == row["from_station_id"]
    assert row["features"][5] == row["humidity_input"]


def test_trees_use_the_defaults(fitted):
    trees = fitted.stages[-1]
    assert trees.getNumTrees == 20
    assert trees.getOrDefault("maxDepth") == 5
    assert trees.getOrDefault("labelCol") == "bicycle_rentals"


def test_model_beats_the_mean(frame, fitted):
    error = plans.evaluate(fitted, frame).first()["rmse"]
    spread = frame.agg(F.stddev_pop("bicycle_rentals")).first()[0]
    assert 0 <= error < spread / 2


def test_rmse_is_the_root_of_the_mean_square(spark):
    df = spark.createDataFrame([(1.0, 4), (2.0, 2)], "prediction double, bicycle_rentals int")
    assert plans.rmse(df).first()["rmse"] == math.sqrt(4.5)


def test_unseen_category_fails_or_is_kept(frame, fitted):
    strange = frame.limit(1).withColumn("weather_description_mf", F.lit("Lava"))
    with pytest.raises(Exception, match="(?i)unseen"):
        plans.score(fitted, strange).collect()
    lenient = plans.fit_model(plans.rental_stages("keep"), frame)
    assert plans.plain_predictions(lenient, strange).count() == 1


def test_other_measures_can_be_imputed(frame):
    gaps = frame.withColumn("wind_speed", F.when(F.col("date") != "2016-07-01", F.col("wind_speed")))
    with pytest.raises(Exception, match="(?i)null"):
        plans.fit_model(plans.rental_stages(), gaps)
    all_four = plans.rental_stages(imputed=("humidity", "pressure", "temperature", "wind_speed"))
    assert plans.plain_predictions(plans.fit_model(all_four, gaps), gaps).count() == gaps.count()


def test_split_is_complete_and_repeatable(frame):
    a, b = plans.split_frame(frame, seed=2)
    again, _ = plans.split_frame(frame.repartition(11), seed=2)
    assert a.count() + b.count() == frame.count()
    assert sorted(map(str, a.collect())) == sorted(map(str, again.collect()))


def write_csv(path, header, rows):
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(header)
        out.writerows([["" if v is None else v for v in row] for row in rows])


def test_jobs_from_csv_to_lookup(spark, tmp_path):
    """The four jobs in a row, on a third of the trips at one station."""
    t = {n: str(tmp_path / n) for n in ("trips", "weather", "model", "documents", "answer", "export")}
    trips = skewed_trips(1500)
    header = ["starttime", "usertype", "from_station_id", "latitude_start", "longitude_start",
              "dpcapacity_start", "dpcapacity_end", "extra"]
    write_csv(tmp_path / "trips.csv", header, [(*r, "kept") for r in trips])
    weather = hourly_weather()
    phrases = {"Clear": "sky is clear", "Clouds": "few clouds", "Rain": "LIGHT RAIN"}
    columns = {"humidity": 1, "pressure": 2, "temperature": 3, "weather_description": 4, "wind_speed": 5}
    args = []
    for name, position in columns.items():
        values = [(r[0], "9", phrases.get(r[position], r[position])) for r in weather]
        write_csv(tmp_path / f"{name}.csv", ["datetime", "Elsewhere", "Chicago"], values)
        args += [f"--{name.replace('_', '-')}", str(tmp_path / f"{name}.csv")]

    ingest.main(["--trips", str(tmp_path / "trips.csv"), *args, "--city", "Chicago",
                 "--out-trips", t["trips"], "--out-weather", t["weather"], "--max-records", "400"])
    stored = spark.read.parquet(t["trips"])
    assert stored.count() == len(trips) and "extra" in stored.columns
    assert len(stored.inputFiles()) >= 4
    table = spark.read.parquet(t["weather"])
    assert sorted(map(tuple, table.collect()), key=str) == sorted(
        [(r[0], r[1], r[2], r[3], r[4], r[5]) for r in weather], key=str
    )

    train.main(["--trips", t["trips"], "--weather", t["weather"], "--first-year", "2013",
                "--last-year", "2019", "--model", t["model"], "--handle-invalid", "keep",
                "--export", t["export"]])
    exported = spark.read.option("header", True).csv(t["export"])
    assert exported.columns == list(TRAINING_COLUMNS) and exported.count() > 100

    items = [
        {"dt_txt": f"2016-07-{11 + h // 24:02d} {h % 24:02d}:00:00",
         "main": {"temp": 290 + h % 9, "pressure": 1000, "humidity": 50},
         "weather": [{"description": "clear sky"}], "wind": {"speed": 3.5}}
        for h in range(0, 120, 3)
    ]
    (tmp_path / "payload.json").write_text(json.dumps({"list": items}))
    predict.main(["--trips", t["trips"], "--forecast", str(tmp_path / "payload.json"),
                  "--first-year", "2016", "--last-year", "2016", "--model", t["model"],
                  "--out", t["documents"]])
    lookup.main(["--documents", t["documents"], "--station", "1", "--out", t["answer"]])
    answer = spark.read.text(t["answer"]).collect()
    assert len(answer) == 1
    document = json.loads(answer[0]["value"])
    assert document["from_station_id"] == 1
    assert len(document["dates"]) == 5
    assert [len(d["info"]) for d in document["dates"]] == [4] * 5
    lookup.main(["--documents", t["documents"], "--out", t["answer"]])
    stations = {r[2] for r in trips}
    assert spark.read.text(t["answer"]).count() == len(stations)


def test_jobs_with_a_stored_profile(spark, tmp_path):
    """Trips parsed once, profile in its own table: the same frame, and no trips for a forecast."""
    t = {n: str(tmp_path / n) for n in ("trips", "stations", "wide", "weather", "old", "model", "documents")}
    header = ["starttime", "usertype", "from_station_id", "latitude_start", "longitude_start",
              "dpcapacity_start", "dpcapacity_end"]
    trips = skewed_trips(900)
    write_csv(tmp_path / "trips.csv", header, trips)
    weather = hourly_weather()
    series = {}
    for name, at in {"humidity": 1, "pressure": 2, "temperature": 3, "weather_description": 4, "wind_speed": 5}.items():
        series[name] = str(tmp_path / f"{name}.csv")
        write_csv(series[name], ["datetime", "Chicago"], [(r[0], r[at]) for r in weather])
    source = str(tmp_path / "trips.csv")
    ingest.run(spark, source, series, "Chicago", t["old"], t["weather"])
    ingest.run(spark, source, series, "Chicago", t["trips"], t["weather"], t["stations"], t["wide"], 100)
    wide, old = (spark.read.parquet(t[n]) for n in ("wide", "old"))
    assert sorted(map(str, wide.collect())) == sorted(map(str, old.select(*wide.columns).collect()))
    years = range(2016, 2017)
    errors = [
        train.run(spark, t[n], t["weather"], years, t["model"], handle_invalid="keep", stations=s).first()[0]
        for n, s in (("trips", t["stations"]), ("old", None))
    ]
    assert errors[0] == pytest.approx(errors[1])

    item = {"dt_txt": "2016-07-12 09:00:00", "main": {"temp": -0.04, "pressure": 1000, "humidity": 50},
            "weather": [{"description": "clear sky"}], "wind": {"speed": 3.5}}
    (tmp_path / "payload.json").write_text(json.dumps({"list": [item]}))
    found = predict.documents(spark, str(tmp_path / "payload.json"), years, t["model"], t["stations"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert t["trips"] not in plan and t["wide"] not in plan
    assert found.count() == len({r[2] for r in trips})
    assert found.first()["dates"][0]["info"][0]["temperature"] == 0.0


def test_predict_needs_one_target():
    base = ["--stations", "t", "--forecast", "f", "--first-year", "1", "--last-year", "1", "--model", "m"]
    with pytest.raises(SystemExit):
        predict.main(base)
    with pytest.raises(SystemExit):
        predict.main([*base, "--out", "o", "--servers", "s", "--topic", "t"])
