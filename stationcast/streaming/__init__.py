from stationcast.streaming.predictions import (
    drain,
    read_predictions,
    stream_messages,
    stream_predictions,
)
from stationcast.streaming.latest import latest_documents, newer_documents, run_messages

__all__ = [
    "drain",
    "latest_documents",
    "newer_documents",
    "read_predictions",
    "run_messages",
    "stream_messages",
    "stream_predictions",
]
