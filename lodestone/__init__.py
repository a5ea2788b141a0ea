"""Lodestone: a Spark-native engine for curating catalogues of entities found on the web."""

__version__ = "0.1.0"
