"""Load control: freshness, loading agenda, missing periods, unprocessed batches."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import datetime_diff
from ledgerloom.operators.ordered import latest_per_key

# schedule name -> days of the week on which a load is due, Sunday = 1 (fixed values)
WEEKDAYS: Mapping[str, Sequence[int]] = {
    "daily": (1, 2, 3, 4, 5, 6, 7),
    "hourly": (1, 2, 3, 4, 5, 6, 7),
    "half-hourly": (1, 2, 3, 4, 5, 6, 7),
    "1-5": (2, 3, 4, 5, 6),
    "2-6": (3, 4, 5, 6, 7),
    "sundays": (1,),
    "mondays": (2,),
}


def is_due(frequency: Column, day: Column) -> Column:
    """'Y' or 'N' for a known schedule on a day; 'monthly' is due on the last day; NULL when unknown."""
    out = F.when(frequency == "monthly", F.when(day == F.last_day(day), "Y").otherwise("N"))
    for name, days in WEEKDAYS.items():
        out = out.when(frequency == name, F.when(F.dayofweek(day).isin(*days), "Y").otherwise("N"))
    return out


def loading_agenda(schedules: DataFrame, days: DataFrame, time: str, holidays: Sequence[str] = ()) -> DataFrame:
    """One row per schedule and day: planned load time, whether a run is due, whether it is a holiday.

    ``days`` is a bounded calendar (one row per date); it is the side that every task gets.
    """
    planned = F.to_timestamp_ntz(
        F.concat_ws(" ", F.col("calendar_date").cast("string"), F.col(time)), F.lit("yyyy-MM-dd HH:mm")
    )
    crossed = schedules.crossJoin(F.broadcast(days))
    return crossed.withColumns(
        {
            "planned_load_time": planned,
            "is_run_expected": is_due(F.col("frequency"), F.col("calendar_date")),
            "is_holiday": F.col("calendar_date").cast("string").isin(*holidays) if holidays else F.lit(False),
        }
    )


def freshness_status(loads: DataFrame, agenda: DataFrame, keys: Sequence[str], now: Column) -> DataFrame:
    """Each load against its nearest planned time: On-Time within the buffer, else Delayed."""
    joined = loads.join(agenda, list(keys), "left")
    planned = F.coalesce("planned_load_time", now)
    joined = joined.withColumn("minutes_off", F.abs(datetime_diff("last_loaded_time", planned, "MINUTE")))
    nearest = latest_per_key(
        joined, [*keys, "last_loaded_time"], [F.col("minutes_off"), F.col("planned_load_time").asc_nulls_last()]
    )
    status = F.when(F.col("minutes_off") <= F.col("buffer_in_minutes"), "On-Time").otherwise("Delayed")
    return nearest.withColumn("status", status)


def missing_periods(
    expected: DataFrame, arrivals: DataFrame, keys: Sequence[str], holidays: DataFrame, day: str
) -> DataFrame:
    """Expected (keys, day) without an arrival, holidays excused."""
    return expected.join(arrivals, [*keys, day], "left_anti").join(holidays, day, "left_anti")


def unprocessed(loaded: DataFrame, control: DataFrame, keys: Sequence[str], done: str = "C") -> DataFrame:
    """Loaded batches without a completed entry in the control table."""
    return loaded.select(*keys).distinct().join(control.filter(F.col("status") == done), list(keys), "left_anti")
