"""Table layouts.  Attribute values are JSON texts, so 1 and "1" differ."""

from __future__ import annotations

from pyspark.sql import types as T

NODES = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("ord", T.LongType()), T.StructField("type", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("updated_at", T.TimestampType()), T.StructField("props", T.MapType(T.StringType(), T.StringType())),
])
EDGES = T.StructType([
    T.StructField("src", T.StringType()), T.StructField("dst", T.StringType()), T.StructField("key", T.StringType()), T.StructField("ord", T.LongType()),
    T.StructField("relationship_name", T.StringType()), T.StructField("relationship_type", T.StringType()),
    T.StructField("updated_at", T.TimestampType()), T.StructField("props", T.MapType(T.StringType(), T.StringType())),
])
POINTS = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("text", T.StringType()), T.StructField("vector", T.ArrayType(T.FloatType())), T.StructField("payload", T.StringType()),
])
EDGE_KEY = ["src", "dst", "key"]
