"""Scalar expressions shared by the feature jobs. All are built-in functions, so they stay in generated code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKET_SECONDS = 300
WINDOW_SECONDS = 3600
#: Fixed value: the namespace of derived event ids.
EVENT_NAMESPACE = "6f9b1c623f525a419d7e000000000001"


def derived_user_id(data_id: Column) -> Column:
    """T for ids of the test split, U for others, then the id's digits padded to seven."""
    prefix = F.when(F.lower(data_id).like("test%"), "T").otherwise("U")
    digits = F.regexp_replace(data_id, "[^0-9]", "")
    padded = F.when(F.length(digits) < 7, F.lpad(digits, 7, "0")).otherwise(digits)
    return F.concat(prefix, padded)


def epoch_seconds(ts: Column) -> Column:
    return F.unix_micros(ts) / F.lit(1e6)


def from_epoch(seconds: Column) -> Column:
    return F.timestamp_micros(F.round(seconds * 1e6).cast("long"))


def bucket_start(seconds: Column) -> Column:
    """The start, in epoch seconds, of the five-minute bucket that holds ``seconds``."""
    return (F.floor(seconds / BUCKET_SECONDS) * BUCKET_SECONDS).cast("long")


def window_cutoff(seconds: Column) -> Column:
    """The oldest bucket start that still counts towards the hour that ends in the bucket of ``seconds``."""
    return bucket_start(seconds) - (WINDOW_SECONDS - BUCKET_SECONDS)


def seconds_between(first: Column, last: Column) -> Column:
    """Second boundaries crossed, as a warehouse's date_diff counts them."""
    return F.unix_seconds(last) - F.unix_seconds(first)


def guarded_ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def hash_shard(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(shards)).cast("int")


def tolerant_cast(raw: Column, kind: str, default: object) -> Column:
    """``raw`` text as float, int (truncated) or str; the default where that fails."""
    if kind == "str":
        return F.coalesce(raw, F.lit(default))
    number = raw.try_cast("double")
    value = number.cast("long") if kind == "int" else number
    return F.coalesce(value, F.lit(default).cast("long" if kind == "int" else "double"))


def close(a: Column, b: Column, tolerance: float) -> Column:
    """Equal within the tolerance, absolutely or relative to ``a``; two nulls are equal."""
    near = F.abs(a - b) <= F.greatest(F.lit(tolerance), F.abs(a) * tolerance)
    return F.coalesce(near, a.isNull() & b.isNull())


def version_of(day: Column) -> Column:
    """A version name vYYYYMMDD from a date in one of several spellings; null if none fits."""
    spellings = ("yyyy-MM-dd", "yyyyMMdd", "yyyy/MM/dd", "dd-MM-yyyy")
    parsed = F.coalesce(*(F.try_to_timestamp(day, F.lit(f)) for f in spellings))
    return F.concat(F.lit("v"), F.date_format(parsed, "yyyyMMdd"))


def date_of(version: Column) -> Column:
    return F.to_date(F.try_to_timestamp(F.substring(version, 2, 8), F.lit("yyyyMMdd")))


def json_key_count(text: Column) -> Column:
    return F.coalesce(F.size(F.json_object_keys(text)), F.lit(0))


def digest_int(text: Column, modulus: Column, hex_digits: int = 8) -> Column:
    """The first hex digits of a SHA-256 as a number modulo ``modulus``."""
    return F.conv(F.substring(F.sha2(text, 256), 1, hex_digits), 16, 10).cast("long") % modulus


def uuid5(name: Column, namespace: str = EVENT_NAMESPACE) -> Column:
    """RFC 4122 version 5 id of ``name``: SHA-1 of namespace and name with version and variant bits set."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace)), name.cast("binary")))
    variant = F.lower(F.conv((F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(3) + 8).cast("string"), 10, 16))
    parts = (
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )
    return F.concat_ws("-", *parts)


def payload_text(columns: dict[str, Column]) -> Column:
    """name=value pairs in the order of names; nulls and NaN are written out."""
    pair = lambda k: F.concat(F.lit(f"{k}="), F.coalesce(columns[k].cast("string"), F.lit("null")))
    return F.concat_ws("\u001e", *(pair(k) for k in sorted(columns)))


def row_fingerprint(identity: list[Column], columns: dict[str, Column]) -> Column:
    """SHA-256 over identity and payload: changes if, and only if, either does."""
    return F.sha2(F.concat_ws("\u001f", *(c.cast("string") for c in identity), payload_text(columns)), 256)


def clip(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def number_or(x: Column, default: Column | float) -> Column:
    """``x``, or the default where it is null or NaN."""
    default = default if isinstance(default, Column) else F.lit(float(default))
    return F.coalesce(F.when(~F.isnan(x), x), default)


def total(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)
