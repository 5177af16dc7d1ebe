"""Paths, names, links and row ids."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from scorewatch import constants as K


def strip_storage_prefix(path: Column) -> Column:
    """Remove the storage scheme at the start of a path, at most once."""
    return F.regexp_replace(path, "^" + re.escape(K.STORAGE_PREFIX), "")


def file_stem(filename: Column, suffix: str = K.IMAGE_SUFFIX) -> Column:
    """File name without its suffix."""
    return F.regexp_replace(filename, re.escape(suffix) + "$", "")


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def parent_name(path: Column) -> Column:
    """Name of the folder that holds the file."""
    return F.regexp_extract(path, "([^/]+)/[^/]+$", 1)


def image_link(image_id: Column, prefix: str = K.IMAGE_LINK_PREFIX) -> Column:
    """Link to the viewer, NULL when there is no image id."""
    return F.when(image_id.isNotNull() & (image_id != ""), F.concat(F.lit(prefix), image_id))


def preview(identifier: Column, chars: int = K.ID_PREVIEW_CHARS) -> Column:
    return F.substring(identifier, 1, chars)


def version_suffix(served_name: Column) -> Column:
    """Second dash-separated part of a served model name, NULL when there is none."""
    return F.get(F.split(served_name, "-"), F.lit(1))


def derived_id(prefix: str, *keys: Column) -> Column:
    """Row id computed from the row's own key, so a retried task or batch repeats the same id.

    128 bits of the key's digest. Separators inside a part are escaped and a NULL part is marked, so
    different keys never give one text.
    """
    escaped = [F.regexp_replace(k.cast("string"), r"([|\\\\])", r"\\\\$1") for k in keys]
    text = F.concat_ws("|", *[F.coalesce(k, F.lit("\\N")) for k in escaped])
    return F.concat(F.lit(prefix), F.substring(F.sha2(text, 256), 1, K.ID_HEX_DIGITS))
