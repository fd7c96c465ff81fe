"""Column helpers that stay inside whole-stage code generation."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNIT = 4294967295.0
_EXACT_BELOW = "1e15D"  # a larger double carries no hundredths to round


def rnd_sql(value: str, digits: int) -> str:
    """SQL text that rounds a double half up on its ten-digit decimal form.

    Going through a decimal first makes the last bits of a floating sum, which
    depend on the order of partial aggregates, irrelevant to the result.
    """
    exact = f"cast(round(cast({value} as decimal(28,10)), {digits}) as double)"
    return f"if(abs({value}) < {_EXACT_BELOW}, {exact}, {value})"


def share_sql(part: str, whole: str) -> str:
    """SQL text for part / whole as a double, null when ``whole`` is 0."""
    return f"try_divide(cast({part} as double), cast({whole} as double))"


def int64_sql(value: str) -> str:
    """SQL text casting to bigint, halves away from zero, bad values to null."""
    return f"try_cast(round(cast({value} as double)) as bigint)"


def rnd(value: str, digits: int) -> Column:
    return F.expr(rnd_sql(value, digits))


def canon_ts(value: Column) -> Column:
    """Timestamp text with six fraction digits, whatever the value."""
    return F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def canon_amount(value: Column) -> Column:
    """Amount text with four decimals; text of the double beyond their range."""
    return F.when(
        F.abs(value) < 1e14, value.cast("decimal(18,4)").cast("string")
    ).otherwise(value.cast("string"))


def hex_to_unit(digest: Column) -> Column:
    """Map the first eight hex digits to the interval 0..1."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(_UNIT)


def unit_draw(category: str, value: Column) -> Column:
    """Stable draw in 0..1 for a value within a category."""
    return hex_to_unit(F.sha2(F.concat(F.lit(f"{category}:"), value), 256))


def drawn(category: str, value: Column, rate: float) -> Column:
    """Whether ``unit_draw`` is at most ``rate``; null for a null value.

    Hex digits of one length compare as their numbers do, so the digest is
    compared with the last digits that are drawn, and no number is made of it.
    """
    if rate >= 1:
        return F.when(value.isNotNull(), True)
    last = max(int(rate * _UNIT), 0) + 1
    while last >= 0 and last / _UNIT > rate:
        last -= 1
    if last < 0:
        return F.when(value.isNotNull(), False)
    digest = F.sha2(F.concat(F.lit(f"{category}:"), value), 256)
    return F.substring(digest, 1, 8) <= F.lit(f"{last:08x}")


def hmac_sha256_hex(message: Column, key: str) -> Column:
    """HMAC-SHA256 as two nested SHA-256 over constant key pads (RFC 2104)."""
    raw = key.encode("utf-8")
    if len(raw) > 64:
        raw = hashlib.sha256(raw).digest()
    raw = raw.ljust(64, b"\0")
    inner_pad = F.lit(bytes(b ^ 0x36 for b in raw))
    outer_pad = F.lit(bytes(b ^ 0x5C for b in raw))
    inner = F.unhex(F.sha2(F.concat(inner_pad, message.cast("binary")), 256))
    return F.sha2(F.concat(outer_pad, inner), 256)


def keyed_pseudonym(raw_id: Column, salt: str) -> Column:
    """First 24 hex digits of the keyed hash."""
    return F.substring(hmac_sha256_hex(raw_id, salt), 1, 24)


def hour_bucket(value: Column, bucket: str = "hour") -> Column:
    """Truncate a timestamp to the hour, as ISO text."""
    if bucket != "hour":
        raise ValueError(f"times are bucketed by hour, not by {bucket}")
    return F.date_format(F.date_trunc("hour", value), "yyyy-MM-dd'T'HH:mm:ss")


def parse_timestamp(value: Column) -> Column:
    """ISO text (also with Z or an offset) to a timestamp, bad text to null."""
    return value.try_cast("timestamp")


def period_label(year: Column, month: Column) -> Column:
    """'YYYY-MM'."""
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))


def sorted_json(*names: str) -> Column:
    """One JSON object per row, keys in name order, nulls kept."""
    return F.to_json(
        F.struct(*[F.col(name) for name in sorted(names)]), {"ignoreNullFields": "false"}
    )
