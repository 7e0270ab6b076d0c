"""almanac: a PySpark-native engine for dated text corpora and model-evaluation data."""
