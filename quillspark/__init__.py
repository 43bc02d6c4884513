"""Spark-first engine for curating annotated bilingual text corpora."""
