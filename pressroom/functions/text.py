"""String, URL, date-text and JSON expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def url_path(url: Column) -> Column:
    """Path part of a URL, by plain pattern: optional scheme, optional host, then
    everything up to ``?``, ``#`` or the ``;parameters`` of the last segment."""
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    return F.regexp_replace(path, r";[^/]*$", "")


def strip_query_suffix(path: Column) -> Column:
    """Drop social-media parameters glued on with ``&``."""
    return F.substring_index(path, "&", 1)


def strip_leading_zeros(text: Column) -> Column:
    return F.regexp_replace(text, r"^0+(?=.)", "")


def parse_publish_date(text: Column, fraction_required: bool = False) -> Column:
    """``2022-03-04T05:06:07Z`` or ``2022-03-04T05:06:07.891Z`` as a UTC instant."""
    with_fraction = F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSSSSX"))
    shaped = F.when(text.rlike(r"^[0-9-]+T[0-9:]+\.[0-9]{1,6}Z$"), with_fraction)
    if fraction_required:
        return shaped
    plain = F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ssX"))
    return F.coalesce(shaped, F.when(text.rlike(r"^[0-9-]+T[0-9:]+Z$"), plain))


def to_utc(text: Column) -> Column:
    """ISO text with or without an offset as a UTC instant; NULL when unreadable."""
    return text.try_cast("timestamp")


def headline(meta_title: Column, basic: Column) -> Column:
    """The search title unless it is missing or empty, else the plain one."""
    return F.coalesce(F.nullif(meta_title, F.lit("")), basic)


def starts_with_any(text: Column, prefixes) -> Column:
    found = F.lit(False)
    for prefix in prefixes:
        found = found | text.startswith(prefix)
    return found


def lacks_json_keys(keys: Column, *wanted: str) -> Column:
    """True when one of ``wanted`` is not among ``keys`` (``json_object_keys`` of a text);
    a key with a null value is there."""
    return F.array_size(F.array_except(F.array(*[F.lit(w) for w in wanted]), keys)) > 0
