"""corpusgauge: audit, prepare and compare machine-learning corpora held as parquet relations."""
