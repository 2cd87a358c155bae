"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Title prefixes that say where the talk's name stands, as
# (prefix, separator, piece); any other title uses the default.
TITLE_RULES = [("SESSION", "|", 2), ("Series", "|", 2), ("[Luton", "-", 1)]
TITLE_DEFAULT = ("|", 1)

# Fixed value: the watch page of a video.
WATCH_URL = "https://www.youtube.com/watch?v=%s"


def starts_with_ci(text: Column, prefix: str) -> Column:
    """Case-insensitive prefix test; only ``%`` and ``_`` would be special in ``prefix``."""
    return text.ilike(prefix + "%")


def trimmed_piece(text: Column, separator: str, n: int) -> Column:
    """The n-th piece, without outer spaces; ``''`` when there is none."""
    return F.trim(F.split_part(text, F.lit(separator), F.lit(n)))


def clean_title(raw: Column) -> Column:
    """Talk name inside a raw video title; the first matching rule decides."""
    title = trimmed_piece(raw, *TITLE_DEFAULT)
    for prefix, separator, n in reversed(TITLE_RULES):
        title = F.when(starts_with_ci(raw, prefix), trimmed_piece(raw, separator, n)).otherwise(title)
    return title


def blank_if_null(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def watch_url(video_id: Column) -> Column:
    return F.format_string(WATCH_URL, video_id.cast("string"))


def bucket_label(lower: Column, upper: Column) -> Column:
    return F.concat_ws("-", lower.cast("string"), upper.cast("string"))


def file_stem(path: Column, suffix: str = "txt") -> Column:
    """File name without folders and without the suffix."""
    return F.regexp_extract(path, rf"([^/]+)\.{suffix}$", 1)
