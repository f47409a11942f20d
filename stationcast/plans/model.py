"""The rental model: preparation stages, boosted trees, scoring and error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationcast.functions import keyed_share
from stationcast.schemas import SLOT_KEYS

LABEL = "bicycle_rentals"
# Categories the model is given, and measures whose gaps are filled.
CATEGORIES = ("part_time", "holiday", "week_days", "weather_description_mf", "month")
IMPUTED = ("humidity", "pressure")
# Order of the model's inputs.
FEATURES = (
    "part_time",
    "holiday",
    "month",
    "week_days",
    "weather_description_mf",
    "humidity",
    "pressure",
    "temperature",
    "wind_speed",
    "from_station_id",
    "mean_dpcapacity_start",
    "mean_dpcapacity_end",
    "sum_subscriber",
    "sum_customer",
)


def _input_name(feature: str, imputed: Sequence[str]) -> str:
    if feature in CATEGORIES:
        return f"{feature}_indexed"
    return f"{feature}_input" if feature in imputed else feature


def imputer(imputed: Sequence[str] = IMPUTED) -> Imputer:
    """Fill NULL and NaN with the mean of the training rows."""
    return Imputer(inputCols=list(imputed), outputCols=[f"{name}_input" for name in imputed])


def indexer(handle_invalid: str = "error") -> StringIndexer:
    """Number the categories by falling frequency, all columns in one pass."""
    return StringIndexer(
        inputCols=list(CATEGORIES),
        outputCols=[f"{name}_indexed" for name in CATEGORIES],
        handleInvalid=handle_invalid,
    )


def assembler(imputed: Sequence[str] = IMPUTED) -> VectorAssembler:
    return VectorAssembler(
        inputCols=[_input_name(name, imputed) for name in FEATURES], outputCol="features"
    )


def rental_stages(
    handle_invalid: str = "error",
    imputed: Sequence[str] = IMPUTED,
    seed: int | None = None,
) -> Pipeline:
    """Imputer, indexer, feature vector and boosted regression trees, not yet fitted.

    ``handle_invalid="keep"`` scores categories the training rows did not have;
    ``imputed`` may name further measures to fill.
    """
    trees = GBTRegressor(labelCol=LABEL)
    if seed is not None:
        trees = trees.setSeed(seed)
    return Pipeline(stages=[imputer(imputed), indexer(handle_invalid), assembler(imputed), trees])


def split_frame(
    df: DataFrame, train_percent: int = 70, seed: int = 0, keys: Sequence[str] = SLOT_KEYS
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows, divided by a hash of the keys."""
    share = keyed_share(keys, seed)
    return df.where(share < train_percent), df.where(share >= train_percent)


def fit_model(stages: Pipeline, train: DataFrame) -> PipelineModel:
    return stages.fit(train)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``prediction`` and the model's intermediate columns."""
    return model.transform(df)


def plain_predictions(model: PipelineModel, df: DataFrame) -> DataFrame:
    """The columns of ``df`` and the prediction, without the intermediate ones."""
    return score(model, df).select(*df.columns, "prediction")


def rmse(predictions: DataFrame) -> DataFrame:
    """One row with the root mean squared error."""
    error = F.col("prediction") - F.col(LABEL)
    return predictions.agg(F.sqrt(F.avg(error * error)).alias("rmse"))


def evaluate(model: PipelineModel, test: DataFrame) -> DataFrame:
    return rmse(score(model, test))
