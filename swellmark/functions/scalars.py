"""Scalar column expressions. All of them stay inside whole-stage codegen."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a tone may look like. Guards `try_cast`, which also takes '1.5d' and the like.
NUMBER = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:nan|inf|infinity))\s*$"

#: Signs trimmed from urls and headers.
BLANKS = " \t\n\r\x0b\x0c\x85\xa0"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_non_empty(columns: Sequence[Column | str]) -> Column:
    """First value that is neither null nor ''. Blanks count as a value."""
    if not columns:
        return F.lit(None).cast("string")
    return F.coalesce(*[F.nullif(_col(c), F.lit("")) for c in columns])


def stripped(c: Column | str) -> Column:
    """Without blanks of any kind at both ends."""
    return F.trim(_col(c), F.lit(BLANKS))


def day_key(c: Column | str) -> Column:
    """Digits only, then the first eight, as an integer; null where none are left."""
    digits = F.regexp_replace(_col(c), "[^0-9]", "")
    return F.left(digits, F.lit(8)).try_cast("int")


def day_text(c: Column | str) -> Column:
    """The first eight characters of a day."""
    return F.substring(_col(c).cast("string"), 1, 8)


def parse_day(c: Column | str) -> Column:
    """First eight characters read as yyyyMMdd; null where they are no date."""
    return F.try_to_date(day_text(c), "yyyyMMdd")


def parse_ts(c: Column | str) -> Column:
    """Text to a timestamp without time zone; null where it is none."""
    return _col(c).try_cast("timestamp_ntz")


def parse_tone(c: Column | str) -> Column:
    """Text to double; null where it is no plain number."""
    text = _col(c)
    return F.when(text.rlike(NUMBER), stripped(text).try_cast("double"))


def conflict_intensity(c: Column | str) -> Column:
    """Sentiment turned around: high means bad. A sign flip, not an absolute value."""
    return _col(c) * F.lit(-1)


def hash_uniform(keys: Sequence[Column | str], seed: int, stream: int = 0) -> Column:
    """A number in (0, 1) that depends on the row's keys only, so reruns and retries agree."""
    bits = F.xxhash64(*[_col(k) for k in keys], F.lit(seed), F.lit(stream))
    return (F.shiftrightunsigned(bits, 11).cast("double") + F.lit(0.5)) / F.lit(float(2**53))


def text_uniform(keys: Sequence[Column | str], seed: int, stream: int = 0) -> Column:
    """As `hash_uniform`, from the MD5 of the keys' texts: other engines can draw the same number.

    The text is the keys, the seed and the stream, joined by '|', a null key being
    empty. The first 13 hex digits are the number's 52 bits.
    """
    parts = [F.coalesce(_col(k).cast("string"), F.lit("")) for k in keys]
    digest = F.md5(F.concat_ws("|", *parts, F.lit(str(seed)), F.lit(str(stream))))
    bits = F.conv(F.left(digest, F.lit(13)), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(2**52))


def hash_normal(keys: Sequence[Column | str], mean: float, sd: float, seed: int = 0) -> Column:
    """A reproducible normal draw per row (Box-Muller over two uniforms of the keys' texts)."""
    radius = F.sqrt(F.lit(-2.0) * F.log(text_uniform(keys, seed, 1)))
    angle = F.lit(2.0 * math.pi) * text_uniform(keys, seed, 2)
    return F.lit(float(mean)) + F.lit(float(sd)) * radius * F.cos(angle)


def rounded(c: Column | str, digits: int = 2, half_even: bool = True) -> Column:
    """Round for display. By default scaled, ties to even, and scaled back, as numpy does."""
    if half_even:
        scale = F.lit(10.0**digits)
        return F.rint(_col(c) * scale) / scale
    return F.round(_col(c), digits)


def without_nan(c: Column | str) -> Column:
    """NaN becomes null, so that both are missing values."""
    return F.nanvl(_col(c).cast("double"), F.lit(None).cast("double"))
