"""k-anonymity and re-identification risk."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripguard.functions import rnd, share_sql

# The quasi-identifiers and the k below which a row is at risk.
QUASI_IDENTIFIERS = ["pu_location_id", "do_location_id", "pickup_hour", "pickup_day_of_week"]
K_THRESHOLD = 5


TIME_PARTS = {
    "pickup_hour": "cast(hour(pickup_at) as bigint)",
    "pickup_day_of_week": "cast(dayofweek(pickup_at) as bigint)",  # Sunday = 1
    "pickup_weekday": "cast(weekday(pickup_at) as bigint)",  # Monday = 0
}


def with_time_parts(trips: DataFrame) -> DataFrame:
    """pickup_hour, and both weekday conventions under different names."""
    return trips.selectExpr(
        *[c for c in trips.columns if c not in TIME_PARTS],
        *[f"{expression} as {name}" for name, expression in TIME_PARTS.items()],
    )


def equivalence_classes(trips: DataFrame, quasi_identifiers: list[str] | None = None) -> DataFrame:
    """Rows per combination of quasi-identifiers; null is a value of its own.

    A grouped count rather than a counting window: partial counts absorb a
    class that holds a large part of all rows.
    """
    keys = quasi_identifiers or QUASI_IDENTIFIERS
    return trips.groupBy(*keys).agg(F.count(F.lit(1)).alias("k_anonymity"))


def merge_class_counts(counts: DataFrame, quasi_identifiers: list[str] | None = None) -> DataFrame:
    """Class sizes from counts kept per month; counts of months just add up."""
    keys = quasi_identifiers or QUASI_IDENTIFIERS
    return counts.groupBy(*keys).agg(F.sum("k_anonymity").alias("k_anonymity"))


def subtract_classes(
    sizes: DataFrame, gone: DataFrame, quasi_identifiers: list[str] | None = None
) -> DataFrame:
    """Class sizes less those of rows that are gone; empty classes go as well."""
    keys = quasi_identifiers or QUASI_IDENTIFIERS
    less = gone.select(*keys, (-F.col("k_anonymity")).alias("k_anonymity"))
    return merge_class_counts(sizes.unionByName(less), keys).filter("k_anonymity > 0")


def changed_classes(
    old: DataFrame, new: DataFrame, quasi_identifiers: list[str] | None = None, k: int = K_THRESHOLD
) -> DataFrame:
    """Classes that are at another risk level than before, or that lost records.

    Rows of all other classes can stay as they are written: they are published
    or not as before, and the size written with them is at most the present one.
    """
    keys = quasi_identifiers or QUASI_IDENTIFIERS
    none = F.lit(0).cast("bigint")
    before = old.select(*keys, F.col("k_anonymity").alias("before"), none.alias("after"))
    after = new.select(*keys, none.alias("before"), F.col("k_anonymity").alias("after"))
    sizes = before.unionByName(after).groupBy(*keys).agg(F.sum("before").alias("before"), F.sum("after").alias("after"))
    other = risk_level(F.col("before"), k) != risk_level(F.col("after"), k)
    return sizes.filter(other | (F.col("after") < F.col("before")))


def with_current_k(
    rows: DataFrame, classes: DataFrame, quasi_identifiers: list[str] | None = None
) -> DataFrame:
    """``rows`` with the present size of their class in place of the one written with them."""
    keys = quasi_identifiers or QUASI_IDENTIFIERS
    return join_classes(rows.drop("k_anonymity"), classes, keys, ["k_anonymity"]).select(*rows.columns)


def risk_level(k: Column, threshold: int = K_THRESHOLD) -> Column:
    return (
        F.when(k < 2, F.lit("critical"))
        .when(k < threshold, F.lit("high"))
        .when(k < 3 * threshold, F.lit("moderate"))
        .otherwise(F.lit("low"))
    )


def join_classes(
    trips: DataFrame, classes: DataFrame, keys: list[str], carried: list[str]
) -> DataFrame:
    """Add the ``carried`` columns of each trip's class.

    Null-safe equality, planned as a hash or merge join. There is one row per
    class, so a frequent class widens nothing; the adaptive planner broadcasts
    the classes if their measured size allows and otherwise splits a skewed
    partition of the trips.
    """
    renamed = classes.select(*[F.col(c).alias(f"_c_{c}") for c in keys], *carried)
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_c_{key}"))
    return trips.join(renamed, same).drop(*[f"_c_{c}" for c in keys])


def with_k(
    trips: DataFrame,
    quasi_identifiers: list[str] | None = None,
    k: int = K_THRESHOLD,
    classes: DataFrame | None = None,
    label: bool = False,
) -> DataFrame:
    """Add k_anonymity, is_high_reidentification_risk and risk_level per trip.

    ``classes`` may come from a table of class sizes kept between runs; without
    it they are counted from ``trips``. ``label`` adds the class as text.
    """
    keys = quasi_identifiers or QUASI_IDENTIFIERS
    if classes is None:
        classes = equivalence_classes(trips, keys)
    size = F.col("k_anonymity")
    scored = join_classes(trips, classes, keys, ["k_anonymity"]).withColumns(
        {
            "is_high_reidentification_risk": size < k,
            "risk_level": risk_level(size, k),
        }
    )
    if label:
        parts = [F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in keys]
        scored = scored.withColumn("equivalence_class", F.concat_ws("|", *parts))
    return scored


# Columns of the risk table.
RISK_COLUMNS = [
    "trip_id", "data_year", "data_month", "schema_version", *QUASI_IDENTIFIERS,
    "k_anonymity", "is_high_reidentification_risk", "risk_level",
]


def risk_table(scored: DataFrame) -> DataFrame:
    return scored.select(*RISK_COLUMNS)


def suppress_outliers(scored: DataFrame, threshold: int = K_THRESHOLD) -> DataFrame:
    """Drop rows in classes below the threshold; a row without k drops too."""
    return scored.filter(F.coalesce("k_anonymity", F.lit(0)) >= threshold)


def risk_summary(classes: DataFrame, k: int = K_THRESHOLD) -> DataFrame:
    """Totals over all rows, from the class sizes: the rows need no second pass."""
    total = "coalesce(sum(k_anonymity), 0)"
    high = f"coalesce(sum(if(k_anonymity < {int(k)}, k_anonymity, null)), 0)"
    return classes.agg(
        F.expr(total).alias("total_records"),
        F.expr(high).alias("high_risk_records"),
        F.coalesce(rnd(share_sql(high, total), 4), F.lit(0.0)).alias("high_risk_rate"),
        F.min("k_anonymity").alias("minimum_k"),
        F.max("k_anonymity").alias("maximum_k"),
    )


def min_k_pivot(classes: DataFrame) -> DataFrame:
    """Smallest class by pickup zone and hour, 0 where there is none."""
    hours = list(range(24))
    pivoted = (
        classes.filter(F.col("pu_location_id").isNotNull())
        .groupBy("pu_location_id")
        .pivot("pickup_hour", hours)
        .agg(F.min("k_anonymity"))
    )
    return pivoted.selectExpr(
        "pu_location_id",
        *[f"cast(coalesce(`{h}`, 0) as bigint) as hour_{h:02d}" for h in hours],
    )


def generalisation_impact(
    trips: DataFrame,
    coarser: dict[str, Column],
    classes: DataFrame | None = None,
    quasi_identifiers: list[str] | None = None,
    k: int = K_THRESHOLD,
) -> DataFrame:
    """k of each trip before and after mapping quasi-identifiers to coarser values.

    Both are class properties: the coarse classes are summed from the fine
    ones, joined to them, and the trips are joined once.
    """
    keys = quasi_identifiers or QUASI_IDENTIFIERS
    if classes is None:
        classes = equivalence_classes(trips, keys)
    fine = classes.withColumnRenamed("k_anonymity", "k_before")
    mapped = [f"_g_{c}" for c in keys]
    fine = fine.withColumns({f"_g_{c}": coarser.get(c, F.col(c)) for c in keys})
    coarse = fine.groupBy(*mapped).agg(F.sum("k_before").alias("k_after"))
    both = join_classes(fine, coarse, mapped, ["k_after"])
    return join_classes(trips, both, keys, ["k_before", "k_after"]).withColumns(
        {
            "risk_before": risk_level(F.col("k_before"), k),
            "risk_after": risk_level(F.col("k_after"), k),
        }
    )


# How far each part of a class can be generalised, the finest level first.
LATTICE = {
    "zone": [
        {"pu_location_id": "pu_location_id", "do_location_id": "do_location_id"},
        {"pu_location_id": "pu_location_id div 3", "do_location_id": "do_location_id div 3"},
        {"pu_location_id": "null", "do_location_id": "null"},
    ],
    "hour": [{"pickup_hour": "pickup_hour"}, {"pickup_hour": "pickup_hour div 6"}, {"pickup_hour": "null"}],
    "weekday": [
        {"pickup_day_of_week": "pickup_day_of_week"},
        {"pickup_day_of_week": "if(pickup_day_of_week in (1, 7), 1L, 0L)"},
        {"pickup_day_of_week": "null"},
    ],
}
LEVELS = list(LATTICE)
GENERALISATION_SCHEMA = ", ".join(
    [*[f"{name}_level int" for name in LEVELS], "total_records long", "classes long", "high_risk_records long", "minimum_k long"]
)


def _measured(classes: DataFrame, nodes: list[tuple[int, ...]], k: int) -> list[tuple]:
    """Each node of the lattice with its records, classes, records at risk and least class."""

    def mapped(node: tuple[int, ...]) -> Column:
        parts = {c: e for name, level in zip(LEVELS, node) for c, e in LATTICE[name][level].items()}
        levels = [F.lit(level).alias(name) for name, level in zip(LEVELS, node)]
        return F.struct(*levels, *[F.expr(f"cast({e} as bigint)").alias(c) for c, e in parts.items()])

    spread = classes.select(F.explode(F.array(*map(mapped, nodes))).alias("n"), "k_anonymity").select("n.*", "k_anonymity")
    merged = spread.groupBy(*[c for c in spread.columns if c != "k_anonymity"]).agg(F.sum("k_anonymity").alias("k"))
    found = merged.groupBy(*LEVELS).agg(
        F.sum("k"), F.count(F.lit(1)), F.coalesce(F.sum(F.when(F.col("k") < k, F.col("k"))), F.lit(0)), F.min("k")
    )
    return [tuple(row) for row in found.collect()]


def least_generalisation(classes: DataFrame, k: int = K_THRESHOLD, most_at_risk: float = 0.01) -> DataFrame:
    """The least generalisations that leave at most ``most_at_risk`` of all records in classes under ``k``.

    A row per node of the lattice of zone, hour and weekday levels that will
    do while no node below it does. The lattice is walked from the bottom:
    coarser classes are unions of finer ones, so what lies above a node that
    will do does too, and is not counted. All nodes of a height are counted in
    one pass over the classes, not the trips; a row a node reaches the driver.
    No records give no rows.
    """
    spark = classes.sparkSession
    good: list[tuple] = []
    nodes = list(product(*[range(len(LATTICE[name])) for name in LEVELS]))
    for height in range(max(map(sum, nodes)) + 1):
        open_ = [
            n for n in nodes if sum(n) == height and not any(all(a <= b for a, b in zip(g, n)) for g in good)
        ]
        if open_:
            good += [row for row in _measured(classes, open_, k) if row[5] <= most_at_risk * row[3]]
    return spark.createDataFrame(good, GENERALISATION_SCHEMA)


# Lower edges of the fare bands by which the values inside a class are told apart.
FARE_EDGES = [0, 10, 20, 50, 100, 1000, 10000]


def sensitive_value(edges: list[int] = FARE_EDGES) -> str:
    """SQL text of what a class should not give away: payment type and fare band; null is a value."""
    band = " + ".join(f"int(fare_amount >= {e})" for e in edges)
    return f"concat(coalesce(cast(payment_type as string), '-'), '|', coalesce(cast({band} as string), '-'))"


def class_histograms(
    trips: DataFrame, value: str | None = None, quasi_identifiers: list[str] | None = None
) -> DataFrame:
    """Trips by class and sensitive value. Histograms of months just add up, as class counts do."""
    keys = quasi_identifiers or QUASI_IDENTIFIERS
    valued = trips.select(*keys, F.expr(value or sensitive_value()).alias("value"))
    return valued.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("c"))


def class_diversity(histograms: DataFrame, quasi_identifiers: list[str] | None = None) -> DataFrame:
    """How much a class tells of its members: l-diversity and distance, from ``class_histograms``.

    ``distinct_values`` is distinct l, ``entropy_l`` the exponential of the
    entropy of the class' values, ``distance`` half the sum of all differences
    between the shares of values in the class and in all records. Everything is
    summed from counts by class and value, of which there are few per class;
    all records' shares are a row per value.
    """
    keys = quasi_identifiers or QUASI_IDENTIFIERS
    total = histograms.groupBy("value").agg(F.sum("c").alias("all"))
    records = F.sum("all").over(Window.partitionBy())
    shares = total.select(F.col("value").alias("_v"), (F.col("all") / records).alias("q"))
    told = histograms.join(shares, F.col("value") == F.col("_v"))
    # A class has as many entries as there are payment types times fare bands at most.
    sizes = told.groupBy(*keys).agg(F.collect_list(F.struct("c", "q")).alias("h"), F.sum("c").alias("k_anonymity"))
    share = "(x.c / k_anonymity)"
    entropy = f"exp(-aggregate(h, 0.0D, (s, x) -> s + {share} * ln({share})))"
    distance = f"aggregate(h, 1.0D, (s, x) -> s + abs({share} - x.q) - x.q) / 2"
    return sizes.select(
        *keys,
        "k_anonymity",
        F.size("h").cast("bigint").alias("distinct_values"),
        F.expr("array_max(transform(h, x -> x.c))").alias("largest_value"),
        rnd(entropy, 6).alias("entropy_l"),
        rnd(distance, 6).alias("distance"),
    )
