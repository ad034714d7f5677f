"""Text-to-value parsing of wire fields (prices and times).

* P1 price text -> double. ``strict=True`` keeps fail-fast parity (malformed
  text raises, whatever the ANSI setting); ``strict=False`` yields NULL for
  quarantine.
* P2 ISO-8601 text with offset -> epoch millis (price event time).
* P3 lenient weight time: text lacking ``T`` or lacking ``Z`` has its spaces
  replaced by ``T`` and a ``Z`` appended (UTC) before parsing, so a
  ``+01:00`` offset ends up with an extra ``Z`` and does not parse.
* P4 epoch millis -> event timestamp: Spark's ``timestamp_millis``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _has_zone(text: Column) -> Column:
    """Text ends with a zone designator: ``Z``, ``+HH:MM`` or ``+HH:MM:SS``.

    Character checks instead of a regular expression: this runs once per
    tick. The cast that follows validates the rest.
    """
    def ch(pos):
        return F.substring(text, pos, 1)
    sign = F.lit("+"), F.lit("-")
    hh_mm = ch(-6).isin(*sign) & (ch(-3) == ":")
    hh_mm_ss = ch(-9).isin(*sign) & (ch(-6) == ":") & (ch(-3) == ":")
    return text.endswith("Z") | hh_mm | hh_mm_ss


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_price(text, strict: bool = True) -> Column:
    """Price text -> double (Java-like: ``1d``, ``0x1p3``, padding, ``NaN``).

    ``strict`` raises on malformed text whatever the ANSI setting.
    """
    text = _c(text)
    v = text.try_cast("double")
    if not strict:
        return v
    return F.when(v.isNotNull() | text.isNull(), v).otherwise(
        F.raise_error(F.concat(F.lit("malformed number: "), text)).cast("double"))


def iso_offset_to_ts(text, strict: bool = False) -> Column:
    """ISO offset date-time text -> TIMESTAMP.

    Lenient: NULL when the date, the ``T`` or the zone is missing or the text does not
    parse (a time alone would be read as today's, a space as a ``T``). Strict:
    such text raises (fail fast, like the original's timestamp assigner).
    """
    text = _c(text)
    whole = (F.substring(text, 11, 1) == "T") & _has_zone(text)      # date, T, time, zone
    v = F.when(whole, text.try_cast("timestamp"))
    if not strict:
        return v
    return F.when(v.isNotNull() | text.isNull(), v).otherwise(
        F.raise_error(F.concat(F.lit("unparseable offset date-time: "), text)).cast("timestamp"))


def iso_offset_to_millis(text) -> Column:
    return F.unix_millis(iso_offset_to_ts(text))


def lenient_weight_time(text) -> Column:
    """Normalised text of P3 (before parsing)."""
    text = _c(text)
    needs_zone = ~(text.contains("T") & text.contains("Z"))
    return F.when(needs_zone, F.concat(F.translate(text, " ", "T"), F.lit("Z"))).otherwise(text)


def lenient_weight_time_to_ts(text, strict: bool = False) -> Column:
    return iso_offset_to_ts(lenient_weight_time(text), strict=strict)


def lenient_weight_time_to_millis(text, strict: bool = False) -> Column:
    return F.unix_millis(lenient_weight_time_to_ts(text, strict=strict))


def to_ntz(ts) -> Column:
    """TIMESTAMP -> TIMESTAMP_NTZ (UTC wall clock) for zone-free outputs."""
    return _c(ts).cast("timestamp_ntz")
