"""ID19-ID22: publication dates and calendar labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KST = "Asia/Seoul"

_FORMATS = (
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XXX",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]",
    "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS]",
    "yyyy-MM-dd",
    "d MMM yyyy HH:mm:ss Z",
    "d MMM yyyy HH:mm:ss z",
    "d MMM yyyy HH:mm Z",
    "d MMM yyyy",
)


def parse_timestamp(raw: Column) -> Column:
    """Lenient feed date: ISO with or without offset, plain date, RFC 822; anything else is null."""
    value = F.trim(F.regexp_replace(raw, r"^(?i)[a-z]{3,9},\s*", ""))
    return F.coalesce(*[F.try_to_timestamp(value, F.lit(fmt)) for fmt in _FORMATS])


def kst_date(ts: Column) -> Column:
    return F.to_date(F.from_utc_timestamp(ts, KST))


def kst_hour(ts: Column) -> Column:
    return F.hour(F.from_utc_timestamp(ts, KST))


def calendar_date(label: Column) -> Column:
    """A valid ``yyyy-MM-dd`` label as a date, else null."""
    shaped = F.regexp_like(label, F.lit(r"^\d{4}-\d{2}-\d{2}$"))
    return F.to_date(F.when(shaped, F.try_to_timestamp(label, F.lit("yyyy-MM-dd"))))


def calendar_age(label: Column, today: Column) -> Column:
    return F.date_diff(calendar_date(today), calendar_date(label))


def iso_week(day: Column) -> Column:
    return F.concat(
        F.extract(F.lit("YEAROFWEEK"), day).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(day).cast("string"), 2, "0")
    )


def site_publication_date(first_published: Column, published: Column, edition_published: Column) -> Column:
    return F.coalesce(first_published, published, edition_published)


def clamp_published(source_ts: Column, edition_ts: Column) -> Column:
    """Future source dates fall back to the edition time; least() ignores nulls, so a missing date stays missing."""
    return F.when(source_ts.isNotNull(), F.least(source_ts, edition_ts)).otherwise(edition_ts)


def age_days(ts: Column, now: Column) -> Column:
    return (F.unix_micros(now) - F.unix_micros(ts)) / F.lit(86400000000.0)
