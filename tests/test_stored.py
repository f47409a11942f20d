"""Keyed tables, batches, counted weather, the grid, tree walks, the ledger and the latest documents."""

import csv
import datetime
import json
import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from stationcast import operators as ops
from stationcast import plans, sinks, sources, streaming
from stationcast.functions import easter_sunday
from stationcast.jobs import ingest, lookup, predict, train
from stationcast.operators.joins import grid_shape
from stationcast.plans import model as ml
from stationcast.sources import keyed
from tests.fixtures import TRIP_SCHEMA, hourly_weather, skewed_trips


# Keyed tables -----------------------------------------------------------------------------


def keyed_rows(spark, folder, count=20_000, slices=16, **options):
    df = spark.range(count).select((F.col("id") * 7 % 5003).alias("k"), F.col("id").alias("v"), F.lit("x").alias("a b"))
    sinks.write_keyed(df, folder, "k", slices=slices, **options)
    return df


def collected(df, metric):
    """The rows of a frame, and what its scans say of themselves; a frame is asked only once."""
    rows = df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    scans = [leaves.apply(i).metrics() for i in range(leaves.size())]
    return rows, sum(s.apply(metric).value() for s in scans if s.contains(metric))


def test_lookup_reads_few_files(spark, tmp_path):
    df = keyed_rows(spark, str(tmp_path / "t"))
    table = sources.KeyedTable(spark, str(tmp_path / "t"))
    found = table.lookup(spark.createDataFrame([(5,), (6,), (5,), (4999,), (None,), (99_999,)], "x int"))
    found, files = collected(found, "numFiles")
    assert sorted(map(tuple, found)) == sorted(map(tuple, df.where("k IN (5, 6, 4999)").collect()))
    assert files == 2 and collected(table.read(), "numFiles")[1] >= 16


def test_lookup_reads_few_row_groups(spark, tmp_path):
    """Within a file, bounds and Bloom filters leave row groups out: their rows never reach the filter."""
    keyed_rows(spark, str(tmp_path / "t"), count=400_000, slices=2, row_group_bytes=64 << 10)
    table = sources.KeyedTable(spark, str(tmp_path / "t"))
    rows, read = collected(table.lookup(spark.createDataFrame([(17,)], "x int")), "numOutputRows")
    assert len(rows) == 400_000 // 5003 + 1 and len(rows) <= read < 40_000


def test_lookup_of_many_keys_joins(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "MOST_VALUES", 10)
    df = keyed_rows(spark, str(tmp_path / "t"))
    table = sources.KeyedTable(spark, str(tmp_path / "t"))
    wanted = df.select("k").where("k BETWEEN 100 AND 300")
    found = table.lookup(wanted)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, df.where("k BETWEEN 100 AND 300").collect()))
    assert found.columns == df.columns


def test_hot_missing_and_text_keys(spark, tmp_path):
    """A key with most rows lies in several slices; rows without a key are stored and not found."""
    df = spark.range(3000).select(
        F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"),
    )
    sinks.write_keyed(df, str(tmp_path / "t"), "k", slices=12)
    table = sources.KeyedTable(spark, str(tmp_path / "t"))
    assert len(table.slices_of(["hot"])) > 3
    assert table.read().count() == 3000
    wanted = spark.createDataFrame([("hot",), ("3",), (None,)], "x string")
    assert table.lookup(wanted).count() == df.where("k IN ('hot', '3')").count()
    with pytest.raises(ValueError):
        sinks.write_keyed(df.withColumn("slice", F.lit(1)), str(tmp_path / "u"), "k")


def test_empty_keyed_table_and_replacement(spark, tmp_path):
    folder = str(tmp_path / "t")
    df = keyed_rows(spark, folder)
    sinks.write_keyed(df.limit(0), folder, "k")
    table = sources.KeyedTable(spark, folder)
    assert table.read().count() == 0 and table.read().columns == df.columns
    assert table.lookup(df.select("k").limit(3)).count() == 0
    # One file fewer or more: what was there is gone.
    sinks.write_keyed(df.where("k < 10"), folder, "k", slices=3)
    assert sources.KeyedTable(spark, folder).read().count() == df.where("k < 10").count()


# Batches ----------------------------------------------------------------------------------


def rows(df):
    return sorted(str(r) for r in df.collect())


def test_batches_add_up_and_replays_change_nothing(spark, tmp_path):
    flagged = ops.usertype_flags(spark.createDataFrame(skewed_trips(), TRIP_SCHEMA))
    first, second = flagged.where(F.xxhash64("starttime", "usertype") % 2 == 0), flagged.where(
        F.xxhash64("starttime", "usertype") % 2 != 0
    )
    folder, source = str(tmp_path / "batches"), str(tmp_path / "first")
    first.write.parquet(source)
    plans.add_batch(spark.read.parquet(source), folder, "a")
    plans.add_batch(second, folder, "b")
    whole = rows(ops.station_profile(flagged))
    profile = plans.batched_profile(spark, folder)
    assert rows(profile) == whole
    # The trips of a batch are read when it is added, and never again.
    assert not [f for f in profile.inputFiles() if source in f]
    plans.add_batch(second, folder, "b")
    assert rows(plans.batched_profile(spark, folder)) == whole
    assert rows(plans.merge_tallies(plans.read_batches(spark, folder))) == rows(ops.trip_tally(flagged))
    # A batch is corrected by adding it again, to nothing as well.
    plans.add_batch(second.limit(0), folder, "b")
    assert rows(plans.batched_profile(spark, folder)) == rows(ops.station_profile(first))
    with pytest.raises(ValueError):
        plans.add_batch(second, folder, "../c")


def test_compacted_batches(spark, tmp_path):
    flagged = ops.usertype_flags(spark.createDataFrame(skewed_trips(), TRIP_SCHEMA))
    for name in "ab":
        plans.add_batch(flagged, str(tmp_path / "x"), name)
    plans.compact(spark, str(tmp_path / "x"), str(tmp_path / "y"), "ab")
    both = flagged.union(flagged)
    assert rows(plans.batched_profile(spark, str(tmp_path / "y"))) == rows(ops.station_profile(both))
    counts = [plans.read_batches(spark, str(tmp_path / n)).count() for n in "xy"]
    assert counts[0] == 2 * counts[1]


# Counted weather ---------------------------------------------------------------------------


def repeated(spark, times):
    """An hour that comes ``times`` times in every series, with two readings each, and a single one."""
    hot, cold = "2020-01-01 05:00:00", "2020-01-01 06:00:00"
    series = {}
    for name in ("humidity", "pressure", "temperature", "wind_speed"):
        values = [(hot, str(k % 2)) for k in range(times)] + [(cold, None)]
        series[name] = spark.createDataFrame(values, f"datetime string, {name} string")
    texts = [(hot, "mist" if k % 2 else "fog") for k in range(times)] + [(cold, "clear sky")]
    series["weather_description"] = spark.createDataFrame(texts, "datetime string, weather_description string")
    return series


def test_counted_weather_is_bounded_and_expands_to_the_same_rows(spark):
    series = repeated(spark, 4)
    counted = plans.ingest_counted_weather(series)
    assert rows(plans.plain_weather(counted)) == rows(plans.ingest_weather(series))
    assert [r.rows for r in counted.orderBy("datetime").collect()] == [4**5, 1]
    # The plain table would have 3 ** 5 * 10 ** 5 rows for the hour.
    many = plans.ingest_counted_weather(repeated(spark, 30)).orderBy("datetime").collect()
    assert [r.rows for r in many] == [30**5, 1] and [len(r.humidity) for r in many] == [2, 1]


def test_tally_of_counted_weather(spark):
    from stationcast.plans.features import counted_tally

    series = repeated(spark, 6)
    expected = plans.series_tally(series)
    got = counted_tally(plans.ingest_counted_weather(series))
    assert got.columns == expected.columns and rows(got) == rows(expected)


# Grid -------------------------------------------------------------------------------------


@pytest.mark.parametrize("many, few", [(1, 1), (0, 5), (1000, 1), (1, 1000), (10**9, 500), (10**6, 10**6), (7, 10**7)])
def test_grid_follows_the_sizes(many, few):
    r, c = grid_shape(many, few, pairs_per_cell=1000)
    cells = max(1, math.ceil(many * few / 1000))
    assert r <= max(1, many) and c <= max(1, few)
    if many and few and cells <= min(many, few) ** 2:
        assert cells <= r * c < 2 * cells + r + c
        # No other shape of as many cells copies much less.
        best = 2 * math.sqrt(many * few * cells)
        assert many * c + few * r <= 1.5 * best + many + few


def test_grid_pairs_everything_once_over_many_tasks(spark):
    many = spark.range(101).select(F.col("id").alias("a"))
    few = spark.range(37).select(F.col("id").alias("b"), F.lit(1).alias("a b"))
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = ops.grid_join(many, few, ["a"], pairs_per_cell=100)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        found = joined.select("a", "b", F.spark_partition_id().alias("p")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sorted((r.a, r.b) for r in found) == [(a, b) for a in range(101) for b in range(37)]
    cells = math.prod(grid_shape(101, 37, 100))
    assert cells >= 37 and 25 <= len({r.p for r in found}) <= cells
    assert "Broadcast" not in plan and "Cartesian" not in plan
    assert ops.grid_join(many.limit(0), few, ["a"]).count() == 0


# Trees ------------------------------------------------------------------------------------


def test_trees_walked_by_joins_predict_as_the_model(spark, tmp_path):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    df = spark.range(400).select(
        (F.col("id") * 37 % 101).cast("double").alias("x"),
        F.concat(F.lit("c"), (F.col("id") % 7).cast("string")).alias("c"),
        ((F.col("id") * 37 % 101) * (F.col("id") % 7) + F.col("id") % 3).cast("double").alias(ml.LABEL),
    )
    stages = [
        StringIndexer(inputCol="c", outputCol="i", handleInvalid="keep"),
        VectorAssembler(inputCols=["x", "i"], outputCol="features", handleInvalid="keep"),
        GBTRegressor(labelCol=ml.LABEL, maxIter=6, maxDepth=4, seed=3),
    ]
    fitted = Pipeline(stages=stages).fit(df)
    path = str(tmp_path / "model")
    sinks.save_model(fitted, path)
    odd = spark.createDataFrame([(float("nan"), "c1"), (-0.0, "unseen"), (1e9, "c6")], "x double, c string")
    scored = fitted.transform(df.select("x", "c").union(odd).union(df.select("x", "c").limit(5)))
    vectors = scored.select("c", F.col("prediction").alias("expected"), vector_to_array("features").alias("features"))
    depth = plans.tree_depth(spark, path)
    assert depth == 4
    walked = plans.score_by_joins(vectors, plans.read_trees(spark, path), depth).collect()
    assert len(walked) == 408
    assert all(abs(r.prediction - r.expected) <= 1e-9 for r in walked)


def test_tree_walks_sort_no_rows_for_their_sums(spark, tmp_path):
    """Of a walking row only number and features travel; sums are hashed, other columns joined after."""
    vectors = spark.createDataFrame([("a", [1.0]), ("a", [1.0]), (None, [5.0])], "c string, features array<double>")
    nodes = [(0, 0, 0.0, 1, 2, 0, -1, [2.0], 1.0), (0, 1, 7.0, -1, -1, -1, -1, [], 1.0), (0, 2, 9.0, -1, -1, -1, -1, [], 1.0)]
    schema = "tree int, node int, prediction double, left int, right int, feature int, categories int, values array<double>, weight double"
    walked = plans.score_by_joins(vectors, spark.createDataFrame(nodes, schema), 1)
    assert "SortAggregate" not in walked._jdf.queryExecution().executedPlan().toString()
    assert walked.columns == ["c", "prediction"]
    assert sorted(map(tuple, walked.collect()), key=str) == [("a", 7.0), ("a", 7.0), (None, 9.0)]


# Ledger -----------------------------------------------------------------------------------


def test_ledger_counts_in_the_scan_of_the_write(spark, tmp_path):
    values = [("2020-01-01 05:00:00", "1", "3"), ("no time", None, " "), (None, "x", "1e2"), ("", "9" * 12, "nan")]
    df = spark.createDataFrame(values * 10, "starttime string, from_station_id string, dpcapacity_start string").repartition(3)
    ledger = ops.Ledger()
    watched = ledger.watch(df)
    watched.write.parquet(str(tmp_path / "t"))
    watched.count()
    got = {(r["column"], r["reason"]): r["rows"] for r in ledger.rows(spark).collect()}
    assert got == {
        ("starttime", "missing"): 10, ("starttime", "blank"): 10, ("starttime", "malformed"): 10,
        ("from_station_id", "missing"): 10, ("from_station_id", "blank"): 0, ("from_station_id", "malformed"): 20,
        ("dpcapacity_start", "missing"): 0, ("dpcapacity_start", "blank"): 10, ("dpcapacity_start", "malformed"): 0,
    }
    assert spark.read.parquet(str(tmp_path / "t")).count() == 40


def test_ledger_of_no_rows(spark):
    ledger = ops.Ledger({"a": "int"})
    ledger.watch(spark.createDataFrame([], "a string, b string")).count()
    assert set(ledger.counts().values()) == {0} and len(ledger.counts()) == 3


# Latest documents -------------------------------------------------------------------------


def message(station, run, mark):
    return json.dumps({"from_station_id": station, "sum_customer": mark, "run": run})


def test_latest_documents_survive_replays_disorder_and_restarts(spark, tmp_path):
    source, table, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))

    def arrive(name, messages):
        spark.createDataFrame([(m,) for m in messages], "value string").coalesce(1).write.text(f"{source}/{name}")

    def drained():
        stream = streaming.newer_documents(streaming.stream_messages(spark, f"{source}/*", max_files=1))
        changes = streaming.drain(stream, table, progress)
        found = streaming.latest_documents(changes).collect()
        assert len(found) == len({r.from_station_id for r in found})
        return {r.from_station_id: (r.run, r.sum_customer) for r in found}, changes.count()

    arrive("1", [message(1, 5, 50), message(2, 4, 40), message(3, None, 9), "no json", message(None, 9, 9)])
    first, changes = drained()
    assert first == {1: (5, 50), 2: (4, 40), 3: (None, 9)} and changes == 3
    # A new query on the same progress: an older run, a replay, a newer run, and a new station.
    arrive("2", [message(1, 4, 41), message(1, 5, 50), message(2, 7, 70), message(2, 6, 60), message(3, 1, 10)])
    arrive("3", [message(4, 1, 1), message(2, 7, 70)])
    second, changes = drained()
    assert second == {1: (5, 50), 2: (7, 70), 3: (1, 10), 4: (1, 1)} and changes == 6
    assert drained() == (second, 6)


# Movable feasts ---------------------------------------------------------------------------


def plain_easter(year):
    """By epact and golden number, as tables give it."""
    golden, century = year % 19 + 1, year // 100 + 1
    sun, moon = 3 * century // 4 - 12, (8 * century + 5) // 25 - 5
    epact = (11 * golden + 20 + moon - sun) % 30
    epact += epact == 24 or (epact == 25 and golden > 11)
    full = 44 - epact
    full += 30 * (full < 21)
    day = full + 7 - (5 * year // 4 - sun - 10 + full) % 7
    return datetime.date(year, 3, 1) + datetime.timedelta(days=day - 1)


def test_easter_of_eight_centuries(spark):
    found = spark.range(1583, 2400).select(F.col("id").alias("y"), easter_sunday("id").alias("d")).collect()
    assert all(r.d == plain_easter(r.y) for r in found)


def test_region_with_movable_feasts(spark):
    found = ops.holiday_calendar(spark, [2024, 2025], ops.GERMANY).collect()
    got = {(str(r.date), r.name) for r in found}
    assert len(got) == len(found) == 18
    for day, name in (("2024-03-29", "Karfreitag"), ("2025-04-21", "Ostermontag"), ("2024-05-09", "Christi Himmelfahrt"),
                      ("2025-06-09", "Pfingstmontag"), ("2024-12-26", "Zweiter Weihnachtstag")):
        assert (day, name) in got


# Jobs -------------------------------------------------------------------------------------


def write_lines(path, header, lines):
    with open(path, "w", newline="") as f:
        csv.writer(f).writerows([header, *lines])


def test_jobs_by_batches_with_ledger_counted_weather_and_keyed_documents(spark, tmp_path):
    t = {n: str(tmp_path / n) for n in ("trips", "batches", "stations", "weather", "ledger", "model", "documents", "answer")}
    header = [f.split()[0] for f in TRIP_SCHEMA.split(", ")]
    trips = skewed_trips(900)
    weather = hourly_weather(repeat=(5, 7))
    args = []
    for name, at in {"humidity": 1, "pressure": 2, "temperature": 3, "weather_description": 4, "wind_speed": 5}.items():
        write_lines(tmp_path / f"{name}.csv", ["datetime", "Chicago"], [(r[0], r[at]) for r in weather])
        args += [f"--{name.replace('_', '-')}", str(tmp_path / f"{name}.csv")]
    for batch, part in (("a", trips[:500]), ("b", trips[500:])):
        write_lines(tmp_path / "trips.csv", header, part)
        ingest.main(["--trips", str(tmp_path / "trips.csv"), *args, "--city", "Chicago", "--out-trips", f"{t['trips']}/{batch}",
                     "--out-weather", t["weather"], "--out-stations", t["stations"], "--batches", t["batches"],
                     "--batch", batch, "--out-ledger", f"{t['ledger']}/{batch}", "--counted"])
    ledger = spark.read.parquet(f"{t['ledger']}/a", f"{t['ledger']}/b").groupBy("column", "reason").agg(F.sum("rows").alias("n"))
    found = {(r["column"], r["reason"]): r.n for r in ledger.collect()}
    assert found["dpcapacity_end", "malformed"] == sum(r[6] == "bad" for r in trips)
    # The CSV reader gives an empty field as a missing one.
    assert found["dpcapacity_end", "missing"] == sum(r[6] == "" for r in trips)
    flagged = ops.usertype_flags(spark.createDataFrame(trips, TRIP_SCHEMA))
    assert rows(spark.read.parquet(t["stations"])) == rows(ops.station_profile(flagged))

    whole = spark.read.parquet(f"{t['trips']}/a").union(spark.read.parquet(f"{t['trips']}/b"))
    sinks.write_table(whole, f"{t['trips']}/all")
    train.run(spark, f"{t['trips']}/all", t["weather"], range(2016, 2017), t["model"], handle_invalid="keep",
              stations=t["stations"])
    holidays = ops.holiday_calendar(spark, [2016])
    series = sources.read_measures(spark, {a[2:].replace("-", "_"): b for a, b in zip(args[::2], args[1::2], strict=True)}, "Chicago")
    counted = plans.batched_training_frame(spark, t["batches"], sources.read_weather(spark, t["weather"]), holidays)
    assert rows(counted) == rows(plans.training_frame_from_trips(flagged, plans.ingest_weather(series), holidays))

    item = {"dt_txt": "2016-07-12 09:00:00", "main": {"temp": 2.0, "pressure": 1000, "humidity": 50},
            "weather": [{"description": "clear sky"}], "wind": {"speed": 3.5}}
    (tmp_path / "payload.json").write_text(json.dumps({"list": [item]}))
    predict.main(["--stations", t["stations"], "--forecast", str(tmp_path / "payload.json"), "--first-year", "2016",
                  "--last-year", "2016", "--model", t["model"], "--out", t["documents"], "--keyed"])
    (tmp_path / "wanted.txt").write_text("1\n2\nx\n99999\n2\n")
    for extra, expected in (["--station", "1"], {1}), (["--stations", str(tmp_path / "wanted.txt")], {1, 2}), ([], None):
        lookup.main(["--documents", t["documents"], "--keyed", *extra, "--out", t["answer"]])
        got = [json.loads(r.value)["from_station_id"] for r in spark.read.text(t["answer"]).collect()]
        assert len(got) == len(set(got)) and set(got) == (expected or {int(r[2]) for r in trips})
    with pytest.raises(SystemExit):
        lookup.main(["--documents", "d", "--stations", "s", "--out", "o"])
    with pytest.raises(SystemExit):
        ingest.main(["--trips", "t", *args, "--city", "C", "--out-trips", "o", "--out-weather", "w", "--batch", "b"])
