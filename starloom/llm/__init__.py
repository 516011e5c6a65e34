"""Operators of a training-data pipeline. Nothing outside this subpackage imports it, save
``__spark_entry__`` and ``corpus_pipeline``."""
