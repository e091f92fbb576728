"""Streaming forms of the operators that keep what they have seen."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import strip, text_or_empty


def drop_repeats(posts: DataFrame, time_col: str, delay: str = "1 day", per_profile: bool = True) -> DataFrame:
    """Posts whose text (of the same profile, or of any) wasn't seen within the delay; state older than the watermark is dropped."""
    keyed = posts.withColumns({"_profile": strip(text_or_empty("profile_id")) if per_profile else F.lit(""), "_text": F.md5(strip(text_or_empty("post_text")))})
    return keyed.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(["_profile", "_text"]).drop("_profile", "_text")


def windowed_counts(events: DataFrame, time_col: str, key: str, width: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    """Events of each key per window; late ones count up to the watermark."""
    g = events.withWatermark(time_col, delay).groupBy(F.window(time_col, width).alias("w"), key).agg(F.count("*").alias("events"))
    return g.select(F.col("w.start").alias("start"), key, "events")
