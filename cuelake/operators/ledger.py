"""Reservations against hard caps, in arrival order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuelake.operators.ordered import id_chunk, scan

CAPS = ["uploads", "calls", "upload_ms", "call_ms", "prompt_bytes", "charge"]
# Fixed names: each may be reserved once per authorization, also where usage is unlimited.
ONE_TIME = {"full_uploads": ("upload", "label", "full-episode"), "full_calls": ("call", "stage", "full_episode_observation")}
BOUNDS = [*CAPS, *ONE_TIME]
E8 = 100_000_000
NO_BOUND = 1 << 62


def _or(df: DataFrame, name: str, value: object) -> Column:
    """A column that older inputs need not have."""
    return F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value)


def usage(events: DataFrame) -> dict[str, Column]:
    """What one event adds to each bound, as whole numbers (charge in 1e-8)."""
    zero = F.lit(0).cast("bigint")
    on = lambda kind, value: F.coalesce(F.when(F.col("kind") == kind, value), zero).cast("bigint")
    one = F.lit(1).cast("bigint")
    out = {
        "uploads": on("upload", one), "calls": on("call", one), "upload_ms": on("upload", F.col("duration_ms")), "call_ms": on("call", F.col("duration_ms")),
        "prompt_bytes": on("call", F.col("prompt_bytes")), "charge": on("call", F.round(F.col("charge") * E8).cast("bigint")),
    }
    for name, (kind, field, value) in ONE_TIME.items():
        out[name] = on(kind, F.when(_or(events, field, "") == value, one))
    return out


def bounds(limits: DataFrame) -> dict[str, Column]:
    """Bound of every total, NULL where there is none. `limits`: auth_id, max_*, unlimited (optional)."""
    free = _or(limits, "unlimited", False)
    out = {name: F.when(~free, F.round(F.col(f"max_{name}") * (E8 if name == "charge" else 1)).cast("bigint")) for name in CAPS}
    return out | {name: F.lit(1).cast("bigint") for name in ONE_TIME}


def bounded(events: DataFrame, limits: DataFrame, *keep: str) -> DataFrame:
    """Events beside their bounds: auth_id, event_id, `keep`, u_<bound>, l_<bound>. Events of an
    authorization without limits are left out. Works for a stream of events, too."""
    used = events.select("auth_id", "event_id", *keep, *[value.alias(f"u_{name}") for name, value in usage(events).items()])
    caps = limits.select("auth_id", *[value.alias(f"l_{name}") for name, value in bounds(limits).items()])
    return used.join(caps, "auth_id")


def fits(total: list[int], add: list[int], room: list[int | None]) -> bool:
    """Does an event stay within every bound it counts towards (or that is negative)?"""
    return all(cap is None or t + a <= cap for t, a, cap in zip(total, add, room, strict=True))


def decide_reservations(events: DataFrame, limits: DataFrame) -> DataFrame:
    """Accept or reject every event; an accepted one uses up its bounds, a rejected one does not.

    Rejection feeds back, so a running sum alone does not decide. Two distributed scans decide all
    events that bounds on what is used before them decide: (1) an event that alone passes a bound
    is rejected, one that fits behind all others before it is accepted; (2) one that does not fit
    behind the accepted ones alone is rejected. The events still open are walked in order
    as a stream, with the sum of accepted ones before each, one row of state at a time. The number
    of passes is fixed, and nothing runs while the plan is built.

    `events`: auth_id, event_id, kind, duration_ms, prompt_bytes, charge, label and stage (optional).
    """
    u, room = (lambda n: F.col(f"u_{n}")), (lambda n: F.col(f"l_{n}"))
    rows = bounded(events, limits)
    alone = F.lit(True)
    for n in BOUNDS:
        alone = alone & F.coalesce(u(n) <= room(n), F.lit(True))
    within = lambda before: _all(F.coalesce((u(n) == 0) | (before(n) + u(n) <= room(n)), F.lit(True)) for n in BOUNDS)

    rows = rows.withColumn("alone", alone)
    for n in BOUNDS:  # an event rejected for good uses nothing
        rows = rows.withColumn(f"u_{n}", F.when(F.col("alone"), u(n)).otherwise(0))
    first = scan(rows, ["auth_id"], ["event_id"], id_chunk("event_id"), sum_before={f"b_{n}": f"u_{n}" for n in BOUNDS})
    sure = within(lambda n: F.col(f"b_{n}"))
    first = first.withColumn("sure", F.col("alone") & sure).drop(*[f"b_{n}" for n in BOUNDS])
    second = scan(first, ["auth_id"], ["event_id"], id_chunk("event_id"), sum_before={f"a_{n}": F.when(F.col("sure"), u(n)).otherwise(0) for n in BOUNDS})
    left = F.col("alone") & ~F.col("sure") & within(lambda n: F.col(f"a_{n}"))
    known = second.where(~left).select("auth_id", "event_id", F.col("sure").alias("accepted"))
    open_rows = second.where(left).select("auth_id", "event_id", *[u(n) for n in BOUNDS], *[F.coalesce(room(n) - F.col(f"a_{n}"), F.lit(NO_BOUND)).alias(f"l_{n}") for n in BOUNDS])
    used, bars = [f"u_{n}" for n in BOUNDS], [f"l_{n}" for n in BOUNDS]

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        owner, taken = None, np.zeros(len(used), np.int64)
        for frame in frames:
            add, bar = frame[used].to_numpy(np.int64), frame[bars].to_numpy(np.int64)
            verdicts = []
            for i, auth in enumerate(frame["auth_id"].tolist()):
                if auth != owner:
                    owner, taken = auth, np.zeros(len(used), np.int64)
                ok = bool(((add[i] == 0) | (taken + add[i] <= bar[i])).all())
                taken = taken + add[i] if ok else taken
                verdicts.append(ok)
            yield pd.DataFrame({"auth_id": frame["auth_id"], "event_id": frame["event_id"], "accepted": verdicts})

    # An expression of the key: a shuffle that repeats the join's could be dropped as redundant.
    in_order = open_rows.repartition(F.xxhash64("auth_id")).sortWithinPartitions("auth_id", "event_id")
    kind = dict(events.dtypes)
    walked = in_order.mapInPandas(walk, f"auth_id {kind['auth_id']}, event_id {kind['event_id']}, accepted boolean")
    return known.unionByName(walked)


def _all(conditions) -> Column:
    out = F.lit(True)
    for condition in conditions:
        out = out & condition
    return out


def ledger_totals(events: DataFrame) -> DataFrame:
    """Totals of every bound so far per authorization; partial sums before the shuffle."""
    sums = events.groupBy("auth_id").agg(*[F.sum(value).alias(name) for name, value in usage(events).items()])
    return sums.withColumn("charge", (F.col("charge").cast("decimal(24,0)") / F.lit(E8).cast("decimal(9,0)")).cast("decimal(24,8)"))


def ledger_status(events: DataFrame, limits: DataFrame) -> DataFrame:
    """Totals beside their bounds, with the names of the bounds passed."""
    caps = limits.select("auth_id", *[value.alias(f"l_{name}") for name, value in bounds(limits).items()])
    joined = ledger_totals(events).join(caps, "auth_id")
    total = lambda n: F.col(n) * E8 if n == "charge" else F.col(n)
    over = F.array_compact(F.array(*[F.when(total(n) > F.col(f"l_{n}"), F.lit(n)) for n in BOUNDS]))
    return joined.select("auth_id", *BOUNDS, F.array_join(over, ",").alias("over"))


def settle_usage(events: DataFrame, receipts: DataFrame, rates: tuple[str, str]) -> DataFrame:
    """Model calls with the charge of their real usage instead of the reserved estimate.

    `receipts`: auth_id, event_id, input_tokens, output_tokens, thought_tokens; the last receipt of
    an event by `recorded_at` counts. A receipt with a missing count leaves the estimate standing.
    A receipt of no known call is returned as a row with `error` (unknown_event). `rates`: dollars
    per million input and output tokens.
    """
    per = lambda value: F.lit(value).cast("decimal(10,4)")
    whole = F.col("input_tokens").isNotNull() & F.col("output_tokens").isNotNull() & F.col("thought_tokens").isNotNull()
    tokens = lambda column: column.cast("decimal(20,0)")
    real = F.when(whole, (tokens(F.col("input_tokens")) * per(rates[0]) + tokens(F.col("output_tokens") + F.col("thought_tokens")) * per(rates[1]))
                  / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,8)")
    last = receipts.groupBy("auth_id", "event_id").agg(F.max_by(F.struct(real.alias("real")), "recorded_at").alias("_r"))
    both = events.withColumn("_event", F.lit(True)).join(last, ["auth_id", "event_id"], "full_outer")
    known = F.coalesce(F.col("_event"), F.lit(False)) & ((F.col("kind") == "call") | F.col("_r").isNull())
    charge = F.when((F.col("kind") == "call") & F.col("_r.real").isNotNull(), F.col("_r.real")).otherwise(F.col("charge"))
    columns = [charge.alias("charge") if name == "charge" else F.col(name) for name in events.columns]
    return both.select(*columns, F.when(~known, "unknown_event").alias("error"))
