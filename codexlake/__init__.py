"""codexlake: a PySpark-native engine for digital-library catalogues."""
