"""Where a media item comes from, its inline payload and its cache name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The video file endings a chat history recognises.
VIDEO_ENDINGS = (".mp4", ".avi", ".mkv", ".mov", ".wmv", ".flv", ".webm", ".mpeg")


def uri_kind(uri: Column) -> Column:
    return (
        F.when(uri.startswith("http://") | uri.startswith("https://"), "http")
        .when(uri.startswith("file://"), "file")
        .when(uri.startswith("data:image"), F.when(uri.contains("base64,"), "data").otherwise("invalid"))
        .otherwise("local")
    )


def uri_path(uri: Column) -> Column:
    """File path of file:// and local items."""
    kind = uri_kind(uri)
    return F.when(kind == "file", F.substring(uri, F.lit(8), F.length(uri))).when(kind == "local", uri)


def data_payload(uri: Column) -> Column:
    """Decoded bytes of a base64 data item."""
    start = F.locate("base64,", uri)
    encoded = F.substring(uri, start + 7, F.length(uri))
    return F.when(uri_kind(uri) == "data", F.unbase64(encoded))


def data_uri(path: Column, content: Column) -> Column:
    ending = F.lower(F.element_at(F.split(path, r"\."), -1))
    kind = F.when(ending == "jpg", "jpeg").otherwise(ending)
    return F.concat(F.lit("data:image/"), kind, F.lit(";base64,"),
                    F.regexp_replace(F.base64(content), r"\s", ""))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def cache_key(uri: Column, *parameters: Column) -> Column:
    digest = F.md5(uri.cast("binary"))
    return F.concat_ws("_", digest, *[p.cast("string") for p in parameters])


def is_video_file(name: Column) -> Column:
    lowered = F.lower(name)
    hit = F.lit(False)
    for ending in VIDEO_ENDINGS:
        hit = hit | lowered.endswith(ending)
    return hit
