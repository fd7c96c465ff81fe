"""Column -> Column helpers."""

from tripguard.functions.scalar import (  # noqa: F401
    canon_amount,
    canon_ts,
    drawn,
    hex_to_unit,
    hmac_sha256_hex,
    hour_bucket,
    int64_sql,
    keyed_pseudonym,
    parse_timestamp,
    period_label,
    rnd,
    rnd_sql,
    share_sql,
    sorted_json,
    unit_draw,
)
