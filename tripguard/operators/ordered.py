"""Order-dependent operators that never put a whole group into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripguard.session import ensure_checkpoint_dir

# Rows of one key that a single task ranks without trouble.
HOT_ROWS = 2_000_000
# Each task of the count sends as many numbers at most, however many keys it has.
KEY_BUCKETS = 1 << 16
COPIES_PER_CHUNK = 1_000_000


def lag_in_order(
    df: DataFrame, columns: list[str], order: list[str], bucket: str
) -> DataFrame:
    """``prev_<column>`` from the row before, over the order of all rows.

    ``bucket`` must grow with ``order`` (say the day of a time). LAG runs
    within buckets; the first row of a bucket takes the last row of the bucket
    before, and only one such row per bucket is ever ordered globally.
    """
    tail = F.max(F.struct(*order, *[F.col(c).alias(f"prev_{c}") for c in columns]))
    tails = df.groupBy(bucket).agg(tail.alias("_tail"))
    before = tails.select(
        F.col(bucket).alias("_bucket"),
        F.lag("_tail").over(Window.orderBy(bucket)).alias("_before"),
    )
    within = Window.partitionBy(bucket).orderBy(*order)
    ranked = df.withColumn("_first", F.row_number().over(within) == 1).withColumns(
        {f"_lag_{c}": F.lag(c).over(within) for c in columns}
    )
    joined = ranked.join(before, F.col(bucket) == F.col("_bucket"), "left")
    return joined.select(
        *df.columns,
        *[
            F.when(F.col("_first"), F.col(f"_before.prev_{c}"))
            .otherwise(F.col(f"_lag_{c}"))
            .alias(f"prev_{c}")
            for c in columns
        ],
    )


def row_number_by(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    out: str,
    hot_rows: int = HOT_ROWS,
    ignored: tuple[str, ...] = (),
    counted: tuple[str, ...] = (),
) -> DataFrame:
    """``row_number() over (partition by keys order by order nulls first)``.

    Ties in ``order`` are broken by all other columns in order of their names,
    except ``ignored`` ones, so the number of a row depends on rows alone and
    not on layout or plan. A plain window ranks ordinary keys, in as many tasks
    as shuffles have partitions: it sorts, and what follows it is often costly,
    so partitions merged for their few bytes would leave cores idle. Rows are counted
    per hash bucket of the key first (a job over the key columns); buckets of
    ``hot_rows`` and more, which one task should not rank, go through
    ``_row_number_spread``. Both ways give each row the same number. ``counted``
    may name some of the keys, by which the job counts instead: rows of one key
    agree in them, so no hot key is missed.
    """
    unordered = [c for c in ignored if c in df.columns]
    rest = sorted(c for c in df.columns if c not in {*keys, *order, *ignored})
    total = [*order, *rest] or keys[:1]
    within = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in total])
    plain = F.row_number().over(within).cast("bigint")
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bucket = F.pmod(F.xxhash64(*(counted or keys)), F.lit(KEY_BUCKETS))
    hot = (
        df.select(bucket.alias("_hot"))
        .groupBy("_hot")
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") >= hot_rows)
        .select("_hot")
    )
    if hot.isEmpty():
        return df.repartition(tasks, *keys).withColumn(out, plain)
    same = bucket == F.col("_hot")
    spread = _row_number_spread(df.join(hot, same, "left_semi"), keys, total, unordered, out)
    others = df.join(hot, same, "left_anti").repartition(tasks, *keys)
    return others.withColumn(out, plain).unionByName(spread)


def _row_number_spread(
    hot: DataFrame, keys: list[str], order: list[str], ignored: list[str], out: str
) -> DataFrame:
    """Row numbers for keys too large for one task.

    Full copies collapse to one row with a count before any shuffle. The
    distinct rows are range-partitioned by key and order, so a large key lies
    in many consecutive partitions. A row's number is the rows of its key in
    earlier partitions, plus those before it in its own, plus its place among
    its copies. The partition number of each row is checkpointed: both the
    offsets and the rows are read from it and must agree after a lost executor.
    """
    ensure_checkpoint_dir(hot.sparkSession)
    columns = hot.columns
    copies = hot.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    sorting = [F.col(c).asc_nulls_first() for c in [*keys, *order, *ignored]]
    spread = (
        copies.repartitionByRange(*sorting)
        .withColumn("_part", F.spark_partition_id())
        .checkpoint()
    )
    before = Window.unboundedPreceding, -1
    zero = F.lit(0).cast("bigint")

    in_part = Window.partitionBy("_part", *keys).orderBy(*sorting[len(keys):])
    rows = spread.withColumn(
        "_local", F.coalesce(F.sum("_n").over(in_part.rowsBetween(*before)), zero)
    )
    by_part = Window.partitionBy(*keys).orderBy("_part")
    offsets = (
        spread.groupBy("_part", *keys)
        .agg(F.sum("_n").alias("_t"))
        .withColumn("_offset", F.coalesce(F.sum("_t").over(by_part.rowsBetween(*before)), zero))
        .select("_part", "_offset", *[F.col(c).alias(f"_k_{c}") for c in keys])
        .withColumnRenamed("_part", "_k_part")
    )
    same = F.col("_part") == F.col("_k_part")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_k_{key}"))

    chunk = F.lit(COPIES_PER_CHUNK).cast("bigint")
    chunked = (
        rows.join(offsets, same)
        .withColumn("_chunk", F.explode(F.sequence(zero, F.expr(f"(_n - 1) div {COPIES_PER_CHUNK}"))))
        .repartition("_part", "_local", "_chunk", *keys)
    )
    first = F.col("_chunk") * chunk + 1
    last = F.least(F.col("_n"), (F.col("_chunk") + 1) * chunk)
    return chunked.withColumn("_copy", F.explode(F.sequence(first, last))).select(
        *columns, (F.col("_offset") + F.col("_local") + F.col("_copy")).alias(out)
    )
