"""Schemas of the tables that the operators read and write."""

from __future__ import annotations

from pyspark.sql import types as T

STAGE = T.StructType([T.StructField("name", T.StringType()), T.StructField("config", T.StringType())])

ITEM = T.StructType(
    [
        T.StructField("source", T.StringType(), False),
        T.StructField("url", T.StringType(), False),
        T.StructField("video_processor", T.ArrayType(STAGE), False),
        T.StructField("channel_ids", T.ArrayType(T.StringType()), False),
        T.StructField("art_style", T.ArrayType(T.StringType())),
        T.StructField("art_genre", T.ArrayType(T.StringType())),
        T.StructField("art_media", T.ArrayType(T.StringType())),
        T.StructField("is_playlist", T.BooleanType()),
        T.StructField("only_channel_vid", T.BooleanType()),
    ]
)
