"""Tessera: a PySpark-native engine for curating measurement data and text corpora."""
