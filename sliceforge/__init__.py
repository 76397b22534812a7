"""Spark-native analytics for program graphs: ingest, diff, graph, slice and validate."""
