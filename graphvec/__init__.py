"""PySpark-native knowledge-graph, vector and text operators."""
