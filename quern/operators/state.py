"""Stateful operators: last values, greedy admission, and bookings that depend on earlier ones."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def token_estimate(chars: Column, output: int = 1600, overhead: int = 400) -> Column:
    """Tokens that a request of so many characters may take."""
    return F.ceil(chars / 2) + output + overhead


def last_values(df: DataFrame, key: str, value: str, order: list[str]) -> DataFrame:
    """(key, value, puts): a key's last value that isn't null, by order. The maximum combines before the shuffle."""
    last = F.max(F.when(F.col(value).isNotNull(), F.struct(*order, value)))
    return df.groupBy(key).agg(last.alias("m"), F.count(value).alias("puts")).select(key, F.col(f"m.{value}").alias("value"), "puts")


def admit(df: DataFrame, order: str, cost: str, budget: int, stretch: int) -> DataFrame:
    """(order, cost, admitted): rows are admitted in order while the one budget of the whole run lasts.

    A row that doesn't fit is skipped and later ones may still fit, so this is a fold and no running sum. It goes over
    `stretch` rows at a time and carries what is left; rows that cost more than that can never fit and are passed over
    in bulk. Values of order are distinct, costs aren't negative; a null cost is not admitted.
    """
    rows = df.select(F.col(order).alias("order"), F.col(cost).cast("long").alias("cost"))
    left, after, admitted = budget, None, []
    while True:
        fits = rows.where((F.col("cost") > 0) & (F.col("cost") <= left) & F.col("order").isNotNull())
        part = (fits if after is None else fits.where(F.col("order") > F.lit(after))).orderBy("order").limit(stretch).collect()  # `stretch` rows at most
        for r in part:
            if r["cost"] <= left:
                left -= r["cost"]
                admitted.append((r["order"],))
        if len(part) < stretch:
            break
        after = part[-1]["order"]
    chosen = df.sparkSession.createDataFrame(admitted, f"chosen {rows.schema['order'].dataType.simpleString()}")
    both = rows.join(chosen, rows["order"] == chosen["chosen"], "left")
    return both.select(F.col("order").alias(order), F.col("cost").alias(cost), F.coalesce((F.col("cost") == 0) | F.col("chosen").isNotNull(), F.lit(False)).alias("admitted"))


def decide(requests: pd.DataFrame) -> pd.DataFrame:
    """Decisions on the requests of one room and day, in order of request; see book()."""
    taken: list[tuple[str, str, int]] = []
    out = []
    for r in requests.sort_values("request", kind="stable").itertuples():
        clash = next((k for s, e, k in taken if r.start_time < e and r.end_time > s), None)
        if pd.isna(r.capacity):
            status = "unknown_room"
        elif r.end_time <= r.start_time:
            status = "invalid_time_range"
        elif r.attendee_count > r.capacity:
            status = "capacity_exceeded"
        elif clash is not None:
            status = "conflict"
        elif not r.confirmed:
            status = "confirmation_required"
        else:
            status = "confirmed"
            taken.append((r.start_time, r.end_time, r.request))
        out.append((r.request, r.room_id, r.date, status, clash if status == "conflict" else None))
    return pd.DataFrame(out, columns=["request", "room_id", "date", "status", "conflict_with"]).astype({"conflict_with": "Int64"})


def book(requests: DataFrame, rooms: DataFrame) -> DataFrame:
    """(request, room_id, date, status, conflict_with) for requests (request, room_id, date, start_time, end_time, attendee_count, confirmed).

    A request fails for an unknown room, an end not after its start, too many attendees, or an overlap with a booking
    confirmed before; without a confirmation it waits. A room and a day are one state, so groups are bounded by what
    is asked of a room on a day.
    """
    known = requests.join(F.broadcast(rooms), "room_id", "left")
    return known.groupBy("room_id", "date").applyInPandas(decide, "request long, room_id string, date string, status string, conflict_with long")
