"""quire: a PySpark-native engine for long-form text (novels, scanned volumes)."""
