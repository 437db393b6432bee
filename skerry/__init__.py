"""Retrieval analytics as Spark jobs: vector ranking, event sequences, intervals, text and data contracts."""
