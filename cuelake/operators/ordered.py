"""Ordered scans that stay parallel inside one track.

A plain `Window.partitionBy(track)` puts a whole track into one task, and one track may hold a
third of all rows. `scan` works in two levels instead: rows are windowed inside
(track, chunk), one summary row per chunk is windowed across the track, and the summary is joined
back. Chunks must be bounded: `id_chunk` uses dense row ids, `time_chunk` is for inputs reduced to
one row per time value first. The rows shuffle once, on (track, chunk); only summaries shuffle on
the track alone. The summary reads every column of the shuffled rows, so both branches are one and
the same shuffle to Spark and the input is computed once, also when scans are nested. That holds as
long as callers pass only columns they go on to use. Rows without a group or an order are dropped.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuelake.functions.base import C, as_col

CHUNK_ROWS = 1 << 16
CHUNK_MS = 1 << 20


def id_chunk(column: C, rows: int = CHUNK_ROWS) -> Column:
    return F.floor(as_col(column) / F.lit(rows)).cast("bigint")


def time_chunk(column: C, ms: int = CHUNK_MS) -> Column:
    return F.floor(as_col(column) / F.lit(ms)).cast("bigint")


def scan(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[C],
    chunk: Column,
    *,
    prev: Mapping[str, C] | None = None,
    nxt: Mapping[str, C] | None = None,
    max_before: Mapping[str, C] | None = None,
    min_after: Mapping[str, C] | None = None,
    max_upto: Mapping[str, C] | None = None,
    sum_before: Mapping[str, C] | None = None,
    max_all: Mapping[str, C] | None = None,
    last: Mapping[str, C] | None = None,
    number: str | None = None,
    total: str | None = None,
) -> DataFrame:
    """Add ordered columns per `by` group: neighbours, running maxima and sums, row numbers.

    `prev`/`nxt` read the adjacent row, `max_before`/`sum_before` run over the rows before,
    `min_after` over the rows behind, `max_upto` includes the row itself, `max_all`/`last` are per group, `number` counts from one.
    """
    prev, nxt, last = dict(prev or {}), dict(nxt or {}), dict(last or {})
    max_before, sum_before = dict(max_before or {}), dict(sum_before or {})
    max_upto, max_all, min_after = dict(max_upto or {}), dict(max_all or {}), dict(min_after or {})
    by = list(by)
    keep = list(df.columns)
    orders = [as_col(item) for item in order]
    data = df.withColumn("_chunk", chunk)
    # Stated once for both branches; otherwise the join adds it to one of them only.
    for name in [*by, "_chunk"]:
        data = data.where(F.col(name).isNotNull())
    data = data.repartition(*by, "_chunk")

    def packed(fields: Mapping[str, C]) -> Column:
        return F.struct(*[as_col(value).alias(name) for name, value in fields.items()])

    # 1. Window inside each bounded chunk.

    inside = Window.partitionBy(*by, "_chunk").orderBy(*orders)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = {}
    if prev:
        local["_prev"] = F.lag(packed(prev)).over(inside)
    if nxt:
        local["_next"] = F.lead(packed(nxt)).over(inside)
    for name, value in max_before.items():
        local[f"_mb_{name}"] = F.max(as_col(value)).over(before)
    for name, value in min_after.items():
        local[f"_na_{name}"] = F.min(as_col(value)).over(inside.rowsBetween(1, Window.unboundedFollowing))
    for name, value in max_upto.items():
        local[f"_mu_{name}"] = F.max(as_col(value)).over(upto)
    for name, value in sum_before.items():
        local[f"_sb_{name}"] = F.sum(as_col(value)).over(before)
    if number:
        local["_rn"] = F.row_number().over(inside)
    rows = data.select("*", *[value.alias(name) for name, value in local.items()])

    # 2. One summary row per chunk, carried across the track.

    maxima = {**{f"mb_{k}": v for k, v in max_before.items()},
              **{f"mu_{k}": v for k, v in max_upto.items()},
              **{f"ma_{k}": v for k, v in max_all.items()}}
    key = F.struct(*[value.alias(f"o{at}") for at, value in enumerate(orders)])
    aggs = [F.count(F.lit(1)).alias("_n"), F.max(F.xxhash64(*keep)).alias("_all")]
    if prev:
        aggs.append(F.max_by(packed(prev), key).alias("_tail"))
    if nxt:
        aggs.append(F.min_by(packed(nxt), key).alias("_head"))
    if last:
        aggs.append(F.max_by(packed(last), key).alias("_final"))
    aggs += [F.max(as_col(value)).alias(f"_e_{name}") for name, value in maxima.items()]
    aggs += [F.min(as_col(value)).alias(f"_f_{name}") for name, value in min_after.items()]
    aggs += [F.sum(as_col(value)).alias(f"_s_{name}") for name, value in sum_before.items()]
    across = Window.partitionBy(*by).orderBy("_chunk")
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    edge = data.groupBy(*by, "_chunk").agg(*aggs)
    carried = [*by, "_chunk"]
    if prev:
        carried.append(F.lag("_tail").over(across).alias("_c_prev"))
    if nxt:
        carried.append(F.lead("_head").over(across).alias("_c_next"))
    if last:
        carried.append(F.last("_final").over(whole).alias("_c_last"))
    for name in max_before:
        carried.append(F.max(f"_e_mb_{name}").over(earlier).alias(f"_c_mb_{name}"))
    for name in min_after:
        carried.append(F.min(f"_f_{name}").over(across.rowsBetween(1, Window.unboundedFollowing)).alias(f"_c_na_{name}"))
    for name in max_upto:
        carried.append(F.max(f"_e_mu_{name}").over(earlier).alias(f"_c_mu_{name}"))
    for name in max_all:
        carried.append(F.max(f"_e_ma_{name}").over(whole).alias(f"_c_ma_{name}"))
    for name in sum_before:
        carried.append(F.sum(f"_s_{name}").over(earlier).alias(f"_c_sb_{name}"))
    if number:
        carried.append(F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_c_rn"))
    if total:
        carried.append(F.sum("_n").over(whole).alias("_c_total"))
    edge = edge.where(F.col("_all").isNotNull()).select(*carried)

    # 3. Join the carried values back and combine.

    both = rows.join(edge, [*by, "_chunk"])
    out = [F.col(name) for name in keep]
    for name in prev:
        out.append(F.coalesce(F.col("_prev"), F.col("_c_prev"))[name].alias(name))
    for name in nxt:
        out.append(F.coalesce(F.col("_next"), F.col("_c_next"))[name].alias(name))
    for name in last:
        out.append(F.col("_c_last")[name].alias(name))
    # `greatest` skips NULL, so a missing side never hides the other.
    for name in max_before:
        out.append(_larger(f"_mb_{name}", f"_c_mb_{name}").alias(name))
    for name in min_after:
        # Rows behind in the chunk or in a later chunk; the lesser of the two.
        a, b = F.col(f"_na_{name}"), F.col(f"_c_na_{name}")
        out.append(F.when(a.isNull(), b).when(b.isNull(), a).when(a <= b, a).otherwise(b).alias(name))
    for name in max_upto:
        out.append(_larger(f"_mu_{name}", f"_c_mu_{name}").alias(name))
    for name in max_all:
        out.append(F.col(f"_c_ma_{name}").alias(name))
    for name in sum_before:
        out.append((F.coalesce(F.col(f"_sb_{name}"), F.lit(0))
                    + F.coalesce(F.col(f"_c_sb_{name}"), F.lit(0))).alias(name))
    if number:
        out.append((F.col("_rn") + F.col("_c_rn")).cast("bigint").alias(number))
    if total:
        out.append(F.col("_c_total").cast("bigint").alias(total))
    return both.select(*out)


def _larger(left: str, right: str) -> Column:
    """Works for structs too, which `greatest` does not order in every release."""
    a, b = F.col(left), F.col(right)
    return F.when(a.isNull(), b).when(b.isNull(), a).when(a >= b, a).otherwise(b)


def islands(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[C],
    chunk: Column,
    key: C,
    first: Mapping[str, C],
    last: Mapping[str, C],
) -> DataFrame:
    """Gaps and islands: one row per stretch of adjacent rows with an equal key.

    Returns `by`, `key`, the `first` fields of the opening row, the `last` fields of the closing
    row and `n_rows`. Only rows that open a stretch pass on to the second scan.
    """
    by = list(by)
    ends = {f"_p_{name}": value for name, value in last.items()}
    numbered = scan(
        df.withColumn("_key", as_col(key)), by, order, chunk,
        prev={"_pkey": "_key", **ends},
        last={f"_l_{name}": value for name, value in last.items()},
        number="_row", total="_total",
    )
    opening = numbered.where(F.col("_pkey").isNull() | (F.col("_pkey") != F.col("_key")))
    closed = scan(
        opening, by, ["_row"], id_chunk("_row"),
        nxt={"_nrow": "_row", **{f"_n_{name}": f"_p_{name}" for name in last}},
    )
    final = F.col("_nrow").isNull()
    return closed.select(
        *by, F.col("_key").alias("key"),
        *[as_col(value).alias(name) for name, value in first.items()],
        *[F.when(final, F.col(f"_l_{name}")).otherwise(F.col(f"_n_{name}")).alias(name)
          for name in last],
        (F.coalesce(F.col("_nrow"), F.col("_total") + 1) - F.col("_row")).alias("n_rows"),
    )
