"""Sluice: a PySpark-native engine for curating question banks and text corpora."""
