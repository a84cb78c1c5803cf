"""panelloom: a Spark-native engine for panel-survey harmonisation and training-data preparation."""

__version__ = "0.1.0"
