"""Frames derived from the given tables by fixed arithmetic.

The tables hold no images, videos or benchmark files, so each job reads facts
computed from real keys and texts. Every view has the same text as check SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .registry import Tables


def media(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    height = F.when(k % 97 == 0, F.lit(10)).otherwise(24 + (k * 37) % 3000)
    name = F.concat(F.lit("m"), k.cast("string"), F.when(k % 3 == 0, ".JPG").otherwise(".png"))
    return t.part.select(
        k.alias("media_id"),
        height.cast("bigint").alias("height"),
        (24 + (k * 91) % 4000).alias("width"),
        (8 + (k * 53) % 5000).alias("total_frames"),
        F.when(F.col("p_size") % 3 == 0, 24.0).when(F.col("p_size") % 3 == 1, 25.0)
        .otherwise(30.0).alias("fps"),
        name.alias("file_name"),
        F.when(k % 5 == 0, F.concat(F.lit("http://host/"), name))
        .when(k % 5 == 1, F.concat(F.lit("https://host/"), name))
        .when(k % 5 == 2, F.concat(F.lit("file:///store/"), name))
        .when(k % 5 == 3, F.concat(F.lit("data:image/png;base64,"), F.base64(F.col("p_name").cast("binary"))))
        .otherwise(F.concat(F.lit("store/"), name)).alias("uri"),
    )


MEDIA_SQL = """
media AS (
  SELECT p_partkey AS media_id,
         CAST(CASE WHEN p_partkey % 97 = 0 THEN 10 ELSE 24 + (p_partkey * 37) % 3000 END AS BIGINT) AS height,
         24 + (p_partkey * 91) % 4000 AS width,
         8 + (p_partkey * 53) % 5000 AS total_frames,
         CASE p_size % 3 WHEN 0 THEN 24.0::DOUBLE WHEN 1 THEN 25.0::DOUBLE ELSE 30.0::DOUBLE END AS fps,
         'm' || p_partkey || CASE WHEN p_partkey % 3 = 0 THEN '.JPG' ELSE '.png' END AS file_name,
         CASE p_partkey % 5
           WHEN 0 THEN 'http://host/m' || p_partkey || CASE WHEN p_partkey % 3 = 0 THEN '.JPG' ELSE '.png' END
           WHEN 1 THEN 'https://host/m' || p_partkey || CASE WHEN p_partkey % 3 = 0 THEN '.JPG' ELSE '.png' END
           WHEN 2 THEN 'file:///store/m' || p_partkey || CASE WHEN p_partkey % 3 = 0 THEN '.JPG' ELSE '.png' END
           WHEN 3 THEN 'data:image/png;base64,' || base64(encode(p_name))
           ELSE 'store/m' || p_partkey || CASE WHEN p_partkey % 3 = 0 THEN '.JPG' ELSE '.png' END
         END AS uri
  FROM part)"""
