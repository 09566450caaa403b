"""Time-ordered computation that does not depend on how rows spread over keys.

``Window.partitionBy(key).orderBy(ts)`` sorts all rows of a key in one task, and a window
without keys sorts everything in one task. Here rows are range-partitioned on (keys, order)
instead. Each partition is one *run*: a contiguous, evenly sized piece of the total order, so
a key, a bucket or a group of equal timestamps that holds a third of all rows is cut into as
many runs as it needs. A window inside (run, keys) then does the local work, and one small
row per run boundary carries the state across. The order columns must identify a row.

The run number is fixed by a reliable checkpoint, since range bounds come from a sample and a
second evaluation could draw other bounds. There are as many runs as the rows need (``ROWS`` each, ``spark.sql.shuffle.partitions``
at least), and each is sorted by a task of its own, so more input means more tasks and not larger ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from threatframe.session import cut_lineage

RUN = "_run"
CONTEXT = "_context"
ROWS = 500_000  # rows of a run

_COMBINE = {
    "sum": (F.sum, lambda before, here: F.coalesce(before + here, here, before)),
    "max": (F.max, F.greatest),
    "min": (F.min, F.least),
}


def run_count(df: DataFrame, rows: int | None = None) -> int:
    """Runs that ``df`` is cut into; ``rows``, a bound of its rows, spares counting them."""
    rows = df.count() if rows is None else rows
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROWS))


def ordered_runs(df: DataFrame, keys: list[str], order: list[str], partitions: int | None = None) -> DataFrame:
    """Rows with their run number; runs follow the order of (keys, order)."""
    n = partitions or run_count(df)
    return cut_lineage(df.repartitionByRange(n, *keys, *order).withColumn(RUN, F.spark_partition_id()))


def by_run(runs: DataFrame, partitions: int) -> DataFrame:
    """Each run in a partition of its own, for windows over (``_run``, keys)."""
    return runs.repartitionById(partitions, RUN)


def running(df: DataFrame, keys: list[str], order: list[str], aggregates: dict[str, tuple[str, Column]],
            inclusive: bool = True, partitions: int | None = None) -> DataFrame:
    """Running sum, max or min per key in the given order.

    ``aggregates`` maps an output name to (``sum`` | ``max`` | ``min``, input). With
    ``inclusive=False`` a row sees only the rows before it.
    """
    inputs = {name: value.alias(f"_in_{name}") for name, (_, value) in aggregates.items()}
    partitions = partitions or run_count(df)
    runs = ordered_runs(df.select("*", *inputs.values()), keys, order, partitions)
    fixed_keys = keys or [F.lit(0)]

    # Carried state. A run shares keys with other runs only at its two ends, so after the
    # filter at most two rows per run are left, however many keys or rows there are.
    partial = runs.groupBy(RUN, *keys).agg(
        *[_COMBINE[kind][0](f"_in_{name}").alias(f"_in_{name}") for name, (kind, _) in aggregates.items()])
    shared = (partial.withColumn("_runs", F.count(F.lit(1)).over(Window.partitionBy(*fixed_keys)))
              .filter("_runs > 1"))
    earlier = Window.partitionBy(*fixed_keys).orderBy(RUN).rowsBetween(Window.unboundedPreceding, -1)
    carried = shared.select(
        F.col(RUN).alias("_carry_run"), *[F.col(k).alias(f"_carry_{k}") for k in keys],
        *[_COMBINE[kind][0](f"_in_{name}").over(earlier).alias(f"_before_{name}")
          for name, (kind, _) in aggregates.items()])

    end = Window.currentRow if inclusive else -1
    local = Window.partitionBy(RUN, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
    here = by_run(runs, partitions).select("*", *[_COMBINE[kind][0](f"_in_{name}").over(local).alias(f"_here_{name}")
                                                  for name, (kind, _) in aggregates.items()])
    matched = F.col(RUN) == F.col("_carry_run")
    for key in keys:
        matched = matched & F.col(key).eqNullSafe(F.col(f"_carry_{key}"))
    joined = here.join(F.broadcast(carried), matched, "left")
    return joined.select(
        *df.columns,
        *[_COMBINE[kind][1](F.col(f"_before_{name}"), F.col(f"_here_{name}")).alias(name)
          for name, (kind, _) in aggregates.items()])


def with_previous_rows(df: DataFrame, keys: list[str], order: list[str], rows: int,
                       partitions: int | None = None) -> DataFrame:
    """Runs that also hold the ``rows`` rows just before them, marked in ``_context``.

    A window over (``_run``, keys) that looks back at most ``rows`` rows is then complete; drop
    the context rows afterwards. Copies are bounded by runs x rows.
    """
    runs = ordered_runs(df, keys, order, partitions)
    backwards = [F.col(c).desc() for c in [*keys, *order]]
    tails = (runs.withColumn("_from_end", F.row_number().over(Window.partitionBy(RUN).orderBy(*backwards)))
             .filter(F.col("_from_end") <= rows).drop("_from_end"))
    everything = Window.partitionBy(F.lit(0)).orderBy(*keys, *order)
    tails = tails.withColumn("_place", F.row_number().over(everything))
    needed = (tails.groupBy(RUN).agg((F.min("_place") - 1).alias("_last")).filter("_last > 0")
              .select(F.col(RUN).alias("_to"),
                      F.explode(F.sequence(F.greatest(F.col("_last") - rows + 1, F.lit(1)), "_last")).alias("_place")))
    context = (tails.join(F.broadcast(needed), "_place")
               .select(*df.columns, F.col("_to").alias(RUN), F.lit(True).alias(CONTEXT)))
    return runs.select(*df.columns, RUN, F.lit(False).alias(CONTEXT)).unionByName(context)


def look_back(df: DataFrame, keys: list[str], order: list[str], lags: dict[str, tuple[str, int]],
              partitions: int | None = None) -> DataFrame:
    """``lag`` per key in the given order; ``lags`` maps an output name to (column, distance)."""
    deepest = max(distance for _, distance in lags.values())
    partitions = partitions or run_count(df)
    window = Window.partitionBy(RUN, *keys).orderBy(*order)
    ready = by_run(with_previous_rows(df, keys, order, deepest, partitions), partitions).select(
        "*", *[F.lag(column, distance).over(window).alias(name) for name, (column, distance) in lags.items()])
    return ready.filter(~F.col(CONTEXT)).drop(RUN, CONTEXT)
