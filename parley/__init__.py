"""A PySpark-native engine for conversational training corpora."""
