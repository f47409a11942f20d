"""Command-line jobs for spark-submit: ingest, train, predict, lookup."""
