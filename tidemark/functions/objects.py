"""Expressions on object names and payloads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the folder whose children name the class of an asset.
LABEL_FOLDER = "flower_photos"


def path_label(path: Column, folder: str = LABEL_FOLDER) -> Column:
    """Folder right below ``folder``, or the parent folder when that is absent."""
    below = F.regexp_extract(path, rf"(?:^|/){folder}/([^/]+)/", 1)
    parent = F.regexp_extract(path, r"([^/]+)/[^/]+$", 1)
    return F.when(below != "", below).otherwise(parent)


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)$", 1)


def plain_path(path: Column) -> Column:
    """Path with one slash after the scheme: readers differ in how many they write."""
    return F.regexp_replace(path, "^([A-Za-z0-9]+):/+", "$1:/")


def base64_text(content: Column) -> Column:
    """Base64 in one line; Spark's own function breaks lines after 76 characters."""
    return F.replace(F.base64(content), F.lit("\r\n"), F.lit(""))


def bytes_of_base64(text: Column) -> Column:
    """Decoded bytes; NULL instead of an error for text that is not base64."""
    return F.try_to_binary(text, F.lit("base64"))


def epoch_timestamp(seconds: Column) -> Column:
    """Epoch seconds, whole or fractional, as a timestamp."""
    return F.timestamp_seconds(seconds.cast("double"))
