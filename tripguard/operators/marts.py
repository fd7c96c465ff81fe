"""The two tables that may leave the privacy boundary."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripguard.functions import keyed_pseudonym, rnd
from tripguard.session import ensure_checkpoint_dir

MIN_CELL = 5
# Suffix of the pseudonym, and columns no mart may show.
PSEUDONYM_SUFFIX = "privacy-demo-rotation-2026"
FORBIDDEN_COLUMNS = [
    "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude",
    "pickup_at", "dropoff_at", "trip_id",
]


def ml_safe(consented: DataFrame, salt: str = PSEUDONYM_SUFFIX, keyed: bool = False) -> DataFrame:
    """Pseudonymous rows with training consent in classes of 5 or more.

    ``consented`` carries the trip columns along, so nothing is joined here.
    ``keyed`` uses HMAC with the salt as a secret instead of a plain suffix.
    """
    if keyed:
        pseudonym = keyed_pseudonym(F.col("trip_id"), salt)
    else:
        pseudonym = F.sha2(F.concat("trip_id", F.lit(f":{salt}")), 256)
    allowed = F.col("consent_ml_training") & ~F.col("is_high_reidentification_risk")
    return consented.filter(allowed).select(
        pseudonym.alias("trip_pseudonym"),
        "vendor_id",
        "passenger_count",
        "trip_distance_miles",
        F.col("pu_location_id").alias("pickup_zone_id"),
        F.col("do_location_id").alias("dropoff_zone_id"),
        "pickup_hour",
        "pickup_day_of_week",
        "payment_type",
        "fare_amount",
        "total_amount",
        "data_year",
        "data_month",
        "schema_version",
        "k_anonymity",
        "risk_level",
        "consent_source",
    )


def analytics_safe(consented: DataFrame, min_cell: int = MIN_CELL) -> DataFrame:
    """Cells of at least ``min_cell`` consented trips; no row-level output."""
    allowed = F.col("consent_analytics") & ~F.col("is_high_reidentification_risk")
    cells = consented.filter(allowed).groupBy(
        "data_year",
        "data_month",
        F.col("pu_location_id").alias("pickup_zone_id"),
        F.col("do_location_id").alias("dropoff_zone_id"),
        "pickup_hour",
    )
    return cells.agg(
        F.count(F.lit(1)).alias("trip_count"),
        rnd("avg(trip_distance_miles)", 2).alias("avg_trip_distance_miles"),
        rnd("avg(fare_amount)", 2).alias("avg_fare_amount"),
        rnd("avg(total_amount)", 2).alias("avg_total_amount"),
        F.min("k_anonymity").alias("minimum_trip_k"),
    ).filter(F.col("trip_count") >= min_cell)


CELL = ["data_year", "data_month", "pickup_zone_id", "dropoff_zone_id", "pickup_hour"]
# Totals of a month that are published beside the cells: each is a line of cells.
LINES = {"pickup_zone": "pickup_zone_id", "dropoff_zone": "dropoff_zone_id", "hour": "pickup_hour"}
HIDDEN, PRIMARY, SECONDARY = "hidden", "primary", "secondary"


def all_cells(consented: DataFrame, min_cell: int = MIN_CELL) -> DataFrame:
    """Every cell of ``analytics_safe`` with its count, and why it is ``hidden``: too small, or null if it is not."""
    allowed = F.col("consent_analytics") & ~F.col("is_high_reidentification_risk")
    keys = {"pickup_zone_id": "pu_location_id", "dropoff_zone_id": "do_location_id"}
    named = consented.filter(allowed).select(*[F.col(keys.get(c, c)).alias(c) for c in CELL])
    counted = named.groupBy(*CELL).agg(F.count(F.lit(1)).alias("trip_count"))
    return counted.withColumn(HIDDEN, F.when(F.col("trip_count") < min_cell, PRIMARY))


def cell_lines(cells: DataFrame) -> DataFrame:
    """A row per cell and line that it is in: the line's month, kind and key, and the cell."""
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).cast("string").alias("key")) for k, c in LINES.items()])
    told = F.struct("trip_count", *CELL).alias("cell")
    return cells.select("data_year", "data_month", F.explode(kinds).alias("l"), HIDDEN, told).select(
        "data_year", "data_month", "l.kind", "l.key", HIDDEN, "cell"
    )


def _line_states(cells: DataFrame) -> DataFrame:
    """Per line: its total, how many cells are hidden, and the least one that is not."""
    return cell_lines(cells).groupBy("data_year", "data_month", "kind", "key").agg(
        F.sum("cell.trip_count").alias("total"),
        F.count(HIDDEN).alias("n_hidden"),
        F.min(F.when(F.col(HIDDEN).isNull(), F.col("cell"))).alias("least"),
        F.max(F.when(F.col(HIDDEN).isNotNull(), F.col("cell"))).alias("lone"),
    )


def recoverable_cells(cells: DataFrame) -> DataFrame:
    """Hidden cells that a published total gives away: the line's only ones, by subtraction."""
    lone = _line_states(cells).filter("n_hidden = 1")
    return lone.select("data_year", "data_month", "kind", "key", *[f"lone.{c}" for c in CELL[2:]], "lone.trip_count")


def protect_cells(cells: DataFrame) -> DataFrame:
    """``cells`` with more of them hidden, so that no total of a line gives one away.

    A line with one hidden cell hides its least other one too, which may leave
    a crossing line with one; rounds go on until there is none. Each round is a
    partial aggregate by line and a join, for all lines of all months at once.
    A line that has no other cell has a total to withhold: see ``line_totals``.
    """
    ensure_checkpoint_dir(cells.sparkSession)
    name = F.to_json(F.struct(*CELL), {"ignoreNullFields": "false"})
    cells = cells.withColumn("_cell", name).checkpoint()
    while True:
        least = _line_states(cells).filter("n_hidden = 1 and least is not null").select("least.*")
        more = least.select(name.alias("_cell")).distinct().withColumn("_more", F.lit(True)).checkpoint()
        if more.isEmpty():
            return cells.drop("_cell")
        reason = F.coalesce(HIDDEN, F.when(F.col("_more"), SECONDARY))
        cells = cells.join(more, "_cell", "left").withColumn(HIDDEN, reason).drop("_more").checkpoint()


def line_totals(cells: DataFrame) -> DataFrame:
    """Totals by month and line, null where the total is that of one hidden cell.

    All kinds of lines sum up to the same month, so a kind that withholds one
    total withholds its least other one too. A month has a line per zone or
    hour, so what the window sees is few.
    """
    lines = _line_states(cells).select("data_year", "data_month", "kind", "key", F.col("total").alias("trip_count"), "n_hidden")
    alone = F.col("n_hidden") == 1
    month = Window.partitionBy("data_year", "data_month", "kind")
    ranked = lines.withColumns(
        {"_gone": F.count_if(alone).over(month), "_rank": F.row_number().over(month.orderBy(alone, "trip_count", "key"))}
    )
    withheld = alone | ((F.col("_gone") == 1) & (F.col("_rank") == 1))
    return ranked.withColumn("trip_count", F.when(~withheld, F.col("trip_count"))).drop("_gone", "_rank")


def assert_no_forbidden_columns(mart: DataFrame) -> None:
    shown = [c for c in mart.columns if c in FORBIDDEN_COLUMNS]
    if shown:
        raise ValueError(f"mart shows {', '.join(shown)}")


# What a row of ``ml_safe`` can be recognised by.
SHOWN = ["pickup_zone_id", "dropoff_zone_id", "pickup_hour", "pickup_day_of_week"]
FIRST, SECOND = 1, 2


def candidates_left(
    released: DataFrame, id_col: str = "trip_pseudonym", keys: list[str] | None = None, k: int = MIN_CELL
) -> DataFrame:
    """How many rows are left for one who holds two releases and knows what each shows of a subject.

    ``released`` has a row per row of either release, told apart by ``release``
    (1 or 2). Pseudonyms that do not change link the rows, so the candidates
    are those with one class in the first release and one in the second, or
    with none in either. Per such pair: the classes, their sizes in each
    release, and ``k_left``. ``is_exposed`` marks pairs of fewer than ``k``
    rows whose classes are of ``k`` or more wherever they were released.

    One shuffle by id, which no id can weigh down, and counts by class. An id
    that a release repeats counts once, with the largest of its classes; rows
    without an id link to nothing and are left out. Nulls in keys are values.
    """
    keys = keys or SHOWN
    sides = {"first": FIRST, "second": SECOND}
    told = F.struct(*keys)
    linked = released.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(
        *[F.max(F.when(F.col("release") == number, told)).alias(side) for side, number in sides.items()]
    )
    cells = linked.groupBy(*sides).agg(F.count(F.lit(1)).alias("k_left")).filter("first is not null or second is not null")
    out = cells
    for side in sides:
        sizes = cells.filter(F.col(side).isNotNull()).groupBy(F.col(side).alias("_class"))
        sizes = sizes.agg(F.sum("k_left").alias(f"k_{side}"))
        out = out.join(sizes, F.col(side) == F.col("_class"), "left").drop("_class")
    published = F.least("k_first", "k_second")
    return out.select(
        *[F.col(side).isNotNull().alias(f"in_{side}") for side in sides],
        *[F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in sides for c in keys],
        *[f"k_{side}" for side in sides],
        "k_left",
        ((F.col("k_left") < k) & (published >= k)).alias("is_exposed"),
    )
