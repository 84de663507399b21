"""A PySpark-native engine for document corpora and their processing telemetry."""
