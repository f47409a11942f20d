from stationcast.sinks.writers import (
    save_model,
    write_csv,
    write_documents,
    write_table,
    write_topic,
)
from stationcast.sinks.keyed import write_keyed

__all__ = [
    "save_model",
    "write_csv",
    "write_documents",
    "write_keyed",
    "write_table",
    "write_topic",
]
