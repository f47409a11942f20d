from stationcast.plans.features import (
    demand_frame,
    hourly_demand,
    scoring_frame,
    series_tally,
    training_frame,
    training_frame_from_trips,
    weather_tally,
)
from stationcast.plans.ingest import (
    ingest_counted_weather,
    ingest_trips,
    ingest_weather,
    plain_weather,
)
from stationcast.plans.model import (
    evaluate,
    fit_model,
    plain_predictions,
    rental_stages,
    rmse,
    score,
    split_frame,
)
from stationcast.plans.incremental import (
    add_batch,
    batched_profile,
    batched_training_frame,
    compact,
    merge_tallies,
    read_batches,
)
from stationcast.plans.trees import read_trees, score_by_joins, tree_depth

__all__ = [
    "add_batch",
    "batched_profile",
    "batched_training_frame",
    "compact",
    "demand_frame",
    "evaluate",
    "fit_model",
    "hourly_demand",
    "ingest_counted_weather",
    "ingest_trips",
    "ingest_weather",
    "merge_tallies",
    "plain_predictions",
    "plain_weather",
    "read_batches",
    "read_trees",
    "rental_stages",
    "rmse",
    "score",
    "score_by_joins",
    "scoring_frame",
    "series_tally",
    "split_frame",
    "training_frame",
    "training_frame_from_trips",
    "tree_depth",
    "weather_tally",
]
