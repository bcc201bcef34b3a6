"""Spark-first media signal analytics: collect, clean, enrich, score and emit."""
