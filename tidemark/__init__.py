"""Spark operators for time-stamped experimental data and for text corpora."""
