"""corpusloom: a PySpark-native engine for curating text corpora and instruction data."""
