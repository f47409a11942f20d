"""Weather categories and the alignment of measure series."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Phrases of the weather service, by category.
WEATHER_PHRASES = {
    "Thunderstorm": [
        "thunderstorm with light rain",
        "thunderstorm with rain",
        "thunderstorm with heavy rain",
        "light thunderstorm",
        "thunderstorm",
        "heavy thunderstorm",
        "ragged thunderstorm",
        "thunderstorm with light drizzle",
        "thunderstorm with drizzle",
        "thunderstorm with heavy drizzle",
        "proximity thunderstorm with rain",
        "proximity thunderstorm with drizzle",
        "proximity thunderstorm",
    ],
    "Drizzle": [
        "light intensity drizzle",
        "drizzle",
        "heavy intensity drizzle",
        "light intensity drizzle rain",
        "drizzle rain",
        "heavy intensity drizzle rain",
        "shower rain and drizzle",
        "heavy shower rain and drizzle",
        "shower drizzle",
    ],
    "Rain": [
        "light rain",
        "moderate rain",
        "heavy intensity rain",
        "very heavy rain",
        "extreme rain",
        "freezing rain",
        "light intensity shower rain",
        "shower rain",
        "heavy intensity shower rain",
        "ragged shower rain",
        "proximity shower rain",
    ],
    "Snow": [
        "light snow",
        "snow",
        "heavy snow",
        "sleet",
        "light shower sleet",
        "shower sleet",
        "light rain and snow",
        "rain and snow",
        "light shower snow",
        "shower snow",
        "heavy shower snow",
    ],
    "Atmosphere": [
        "mist",
        "smoke",
        "haze",
        "sand/ dust whirls",
        "fog",
        "sand",
        "dust",
        "Ash volcanic ash",
        "squalls",
        "tornado",
    ],
    "Clear": ["clear sky"],
    "Clouds": ["few clouds", "scattered clouds", "broken clouds", "overcast clouds"],
}

# Categories whose phrases must match in exact case, and the category of
# everything else. All other descriptions are compared in lower case, so a phrase that
# is not in lower case itself ("Ash volcanic ash") is never met and gets the default.
CASE_SENSITIVE = {"Thunderstorm"}
DEFAULT_CATEGORY = "Clouds"

# Spelling used in history but not by the forecast service.
HISTORIC_SPELLING = {"sky is clear": "clear sky"}


def vocabulary_rows() -> list[tuple[str, str, bool]]:
    return [
        (phrase, category, category in CASE_SENSITIVE)
        for category, phrases in WEATHER_PHRASES.items()
        for phrase in phrases
    ]


def weather_vocabulary(spark: SparkSession) -> DataFrame:
    """The default lookup table: phrase, category, and whether case matters."""
    values = ", ".join(
        f"('{phrase}', '{category}', {str(exact).lower()})"
        for phrase, category, exact in vocabulary_rows()
    )
    return spark.sql(f"SELECT * FROM VALUES {values} AS v(phrase, category, case_sensitive)")


def classify_weather(
    df: DataFrame,
    vocabulary: DataFrame | None = None,
    column: str = "weather_description",
    out: str = "weather_condition",
) -> DataFrame:
    """Add the category of a weather description; unknown and NULL get the default.

    Of several rows of a phrase in the lookup table, the one that ignores case counts, then
    the first category, so no row of the frame is multiplied. The table's size is known to the planner, which
    broadcasts it while it is below the threshold, so the frame keeps its partitioning.
    """
    if vocabulary is None:
        vocabulary = weather_vocabulary(df.sparkSession)
    entry = F.min(F.struct("case_sensitive", "category"))
    lookup = (
        vocabulary.groupBy(F.col("phrase").alias("_phrase"))
        .agg(entry.alias("_entry"))
        .select(
            "_phrase",
            F.col("_entry.category").alias("_category"),
            F.col("_entry.case_sensitive").alias("_exact"),
        )
    )
    accepted = ~F.col("_exact") | (F.col(column) == F.col("_phrase"))
    return (
        df.join(lookup, F.lower(F.col(column)) == F.col("_phrase"), "left")
        .withColumn(out, F.when(accepted, F.col("_category")).otherwise(DEFAULT_CATEGORY))
        .drop("_phrase", "_category", "_exact")
    )


def align_series(series: list[DataFrame], key: str = "datetime") -> DataFrame:
    """Put series side by side on their common times.

    A time that one series lacks drops out, a repeated time multiplies. All joins use
    the same key, so each series is shuffled once at most.
    """
    return reduce(lambda left, right: left.join(right, key), series)


def count_readings(series: DataFrame, measure: str, key: str = "datetime") -> DataFrame:
    """One row per time: ``measure`` as its distinct readings, each with its number of ``rows``.

    The readings are counted before they are gathered, so a time that repeats a reading often
    holds it once. They are sorted, a missing one first.
    """
    counted = series.groupBy(key, measure).agg(F.count(F.lit(1)).alias("rows"))
    pairs = F.array_sort(F.collect_list(F.struct(F.col(measure).alias("reading"), "rows")))
    return counted.groupBy(key).agg(pairs.alias(measure))


def expand_readings(counted: DataFrame, measures: list[str], rows: str = "rows") -> DataFrame:
    """The rows that counted readings stand for: every combination of readings, as often as it is counted."""
    wide, columns = counted, [name for name in counted.columns if name not in (*measures, rows)]
    times = F.lit(1).cast("long")
    for name in measures:
        wide = wide.withColumn(f"_{name}", F.explode(name))
        times = times * F.col(f"_{name}.rows")
    if "category_rows" in columns:
        columns.remove("category_rows")
        times = times * F.col("category_rows")
    readings = [F.col(f"_{name}.reading").alias(name) for name in measures]
    single = wide.select(*columns, *readings, F.explode(F.sequence(F.lit(1).cast("long"), times)).alias("_copy"))
    return single.drop("_copy")
