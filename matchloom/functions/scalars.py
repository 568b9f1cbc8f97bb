"""Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400
#: Timestamp formats of the sources, in the order in which they are tried.
ISO_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss.[SSSSSS][SSSSS][SSSS][SSS][SS][S]'Z'", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd")


def last_element(a: Column) -> Column:
    """Of a cumulative list; null if empty or null."""
    return F.try_element_at(a, F.lit(-1))


def length(a: Column) -> Column:
    """Null for a null list (not collected), 0 for an empty one (none)."""
    return F.when(a.isNotNull(), F.size(a)).cast("long")


def count_where(a: Column, test) -> Column:
    return length(F.filter(a, test))


def epoch(text: Column) -> Column:
    """Epoch seconds of an ISO text, in UTC; null if no format fits."""
    return F.unix_seconds(F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in ISO_FORMATS]))


def iso_date(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd")


def days_between(later: Column, earlier: Column) -> Column:
    return (later - earlier) / F.lit(SECONDS_PER_DAY)


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, 100.0 * part / whole).otherwise(0.0)


def filled(value: Column, otherwise: Column) -> Column:
    """value, or the other one where it is null or empty."""
    return F.coalesce(F.nullif(value, F.lit("")), otherwise)


def contains_text(value: Column, pattern: str) -> Column:
    return F.lower(F.coalesce(value, F.lit(""))).contains(pattern.lower())


def sampled(match_id: Column, share: float, modulus: int = 10_000) -> Column:
    """Whether an id is in the subsample: by its remainder, so the same ids every time."""
    return F.lit(True) if share >= 1.0 else F.pmod(match_id, F.lit(modulus)) < F.lit(share * modulus)


def medal(tier: Column) -> Column:
    return F.floor(tier / 10)


def stars(tier: Column) -> Column:
    return tier % 10


def walk_key(source: Column, label: Column) -> Column:
    return F.concat_ws(":", source, label)


def in_walks(selectors: list[str], source: Column | None = None, label: Column | None = None) -> Column:
    """Rows of any of the walks, each given as `label` or `source:label` (split at the last colon)."""
    source, label = F.col("source") if source is None else source, F.col("label") if label is None else label
    out = F.lit(False)
    for text in selectors:
        left, colon, right = text.rpartition(":")
        left, right = left.strip(), right.strip()
        if not right or (colon and not left):
            raise ValueError(f"not a walk: {text!r}")
        out = out | ((source == left) & (label == right) if colon else label == right)
    return out
