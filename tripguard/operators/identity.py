"""A stable id for every staged trip."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripguard.functions import canon_amount, canon_ts
from tripguard.operators.ordered import row_number_by

# Order of trips that share file, times and total.
DUPLICATE_ORDER = [
    "vendor_id", "passenger_count", "trip_distance_miles", "fare_amount",
    "pu_location_id", "do_location_id", "payment_type",
]
# Columns that follow from the file's name, so that trips of a file never differ in them.
OF_FILE = ["data_year", "data_month", "schema_version"]
# What an id is made of; _amount is the total as text. Times first: sorting by
# them tells most trips apart, while names of files begin alike.
ID_KEYS = ["pickup_at", "dropoff_at", "_amount", "source_file"]


def ranked_by(columns: list[str], shown: list[str] | None) -> list[str]:
    """The order of trips of a key, as far as it matters if no more than ``shown`` is read of them.

    That is ``DUPLICATE_ORDER`` and then all other columns by name. Trips alike
    up to the last column shown may swap their ids and nobody can tell.
    """
    same = {*DUPLICATE_ORDER, *ID_KEYS, *OF_FILE, "ingested_at"}
    order = [*DUPLICATE_ORDER, *sorted(c for c in columns if c not in same)]
    last = len(order) if shown is None else max((order.index(c) + 1 for c in shown if c in order), default=0)
    return [c for c in order[:last] if c in columns]


def columns_for(columns: list[str], shown: list[str] | None) -> list[str]:
    """Those of ``columns`` that ids need if no more than ``shown`` is read of the trips; all without it."""
    if shown is None:
        return columns
    needed = {*shown, *ranked_by(columns, shown), "source_file", "pickup_at", "dropoff_at", "total_amount"}
    return [c for c in columns if c in needed]


def with_trip_id(staged: DataFrame, shown: list[str] | None = None, **limits: int) -> DataFrame:
    """Add duplicate_ordinal, pickup_hour, pickup_day_of_week and trip_id.

    The ordinal counts within the *rendered* total, so two rows can never
    render to the same id. Trips alike in ``DUPLICATE_ORDER`` are ordered by all
    their other columns but the time of the load, so a trip keeps its id when it
    is loaded again. Trips of a month only meet trips of that month: a new month
    needs no other month's rows. With ``shown``, the columns that will be read
    of the trips, only those that ``columns_for`` names are moved; ids and shown
    columns are the same. ``limits`` go to ``row_number_by``.
    """
    order = ranked_by(staged.columns, shown)
    keyed = staged.select(*columns_for(staged.columns, shown), canon_amount(F.col("total_amount")).alias("_amount"))
    if "total_amount" not in {*order, *(shown or [])}:
        keyed = keyed.drop("total_amount")
    ranked = row_number_by(
        keyed,
        ID_KEYS,
        order,
        "duplicate_ordinal",
        ignored=("ingested_at",),
        # Counted by times alone, for which no text is made.
        counted=("pickup_at", "dropoff_at"),
        **limits,
    )
    blank = F.lit("")
    text = F.concat_ws(
        "|",
        F.coalesce("source_file", blank),
        F.coalesce(canon_ts(F.col("pickup_at")), blank),
        F.coalesce(canon_ts(F.col("dropoff_at")), blank),
        F.coalesce("_amount", blank),
        F.col("duplicate_ordinal").cast("string"),
    )
    return ranked.withColumns(
        {
            "pickup_hour": F.hour("pickup_at").cast("bigint"),
            "pickup_day_of_week": F.dayofweek("pickup_at").cast("bigint"),
            "trip_id": F.sha2(text, 256),
        }
    ).drop("_amount")
