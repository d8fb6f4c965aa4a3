"""A PySpark-native engine for curating paired text-and-speech corpora."""
