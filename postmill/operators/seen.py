"""The registry of job ids with expiry (D3, D12, X2): in batch over all rows, and as a stream with keyed state and timers.

A row is known if a row of its company and job id was taken in at most `days` days before; the first row after that time is taken in
anew. Rows that are known don't renew the entry. Of rows of one day the one with the least id stands first.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from postmill.functions import columns as C

DAYS, DAY_MS = 90, 86_400_000
#: of the state store that keyed state with timers needs
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def registry_key(company: Column, job_id: Column) -> Column:
    """Company without suffixes and the id's normal form; null if the posting has no id."""
    normal = C.normal_job_id(job_id)
    return F.when((C.text(job_id) != "") & (job_id != "N/A") & (normal != ""), F.concat_ws("|", C.squash(C.company_key(company)), normal))


def registry(rows: DataFrame, days: int = DAYS) -> DataFrame:
    """key, entries (array of day, id in order): the entries of each key of rows (key, day, id), a day being a date.

    Days are folded once per key; a key holds at most one pair a day, so a hot key's group is bounded by the span of time.
    """
    firsts = rows.where("key IS NOT NULL AND day IS NOT NULL").groupBy("key", "day").agg(F.min("id").alias("id"))
    listed = firsts.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("day", "id"))).alias("all"))
    none = F.filter("all", lambda x: F.lit(False))
    taken = F.aggregate("all", none, lambda have, x: F.when((F.size(have) == 0) | (F.datediff(x["day"], F.element_at(have, -1)["day"]) > days), F.array_append(have, x)).otherwise(have))
    return listed.select("key", taken.alias("entries"))


def known(rows: DataFrame, days: int = DAYS) -> DataFrame:
    """id, known, seen_at of rows (key, day, id): whether an entry stood for the row, and the entry's day.

    Rows without a key or a day are never known; an id that several rows of one day and key share is one row's.
    """
    entries = registry(rows, days).withColumnRenamed("key", "_key")
    joined = rows.join(entries, F.col("key") == F.col("_key"), "left")
    own = F.element_at(F.filter(F.coalesce("entries", F.array()), lambda e: e["day"] <= F.col("day")), -1)
    with_own = joined.withColumn("_own", F.when(F.col("day").isNotNull() & (F.size("entries") > 0), own))
    seen = F.col("_own").isNotNull() & ((F.col("_own.day") != F.col("day")) | (F.col("_own.id") != F.col("id")))
    return with_own.select("id", seen.alias("known"), F.when(seen, F.col("_own.day")).alias("seen_at"))


def _rows(key: str, days: list[int], ids: list[int]) -> pd.DataFrame:
    # keys as plain objects: arrays of the string type come in chunks, which the state's serializer refuses
    return pd.DataFrame({"key": pd.Series([key] * len(days), dtype="object"), "epoch_day": pd.Series(days, dtype="int32"), "id": pd.Series(ids, dtype="int64")})


class Registry(StatefulProcessor):
    """Keeps the last entry of a key and a timer for the day on which it expires; gives the rows that are taken in."""

    def __init__(self, days: int):
        self.days = days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entry = handle.getValueState("entry", StructType([StructField("day", IntegerType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802 (the interface's name)
        firsts: dict[int, int] = {}
        for part in rows:  # a pair a day is kept, however many rows come
            for day, least in part.groupby("epoch_day")["id"].min().items():
                firsts[int(day)] = min(int(least), firsts.get(int(day), int(least)))
        last = self.entry.get()[0] if self.entry.exists() else None
        taken = []
        for day in sorted(firsts):
            # a late row of a time that no entry covers, before or after, is taken in, but leaves the later entry as it is
            if last is None or day > last + self.days:
                last = day
                taken.append(day)
            elif day + self.days < last:
                taken.append(day)
        if last is not None and taken and last == taken[-1]:
            self.entry.update((last,))
            self.handle.registerTimer((last + self.days + 1) * DAY_MS)
        yield _rows(key[0], taken, [firsts[d] for d in taken])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        if self.entry.exists() and (self.entry.get()[0] + self.days + 1) * DAY_MS <= expiredTimerInfo.getExpiryTimeInMs():
            self.entry.clear()
        yield _rows(key[0], [], [])

    def close(self) -> None:
        pass


def taken_in(rows: DataFrame, days: int = DAYS, late: str = "7 days") -> DataFrame:
    """key, epoch_day, id of a stream (key, ts, id): the rows that the registry takes in. Rows later than `late` are dropped by the watermark.

    The session must use the state store of STORE. An entry's state goes when the watermark passes its expiry.
    """
    out = StructType([StructField("key", rows.schema["key"].dataType), StructField("epoch_day", IntegerType()), StructField("id", LongType())])
    keyed = rows.where("key IS NOT NULL").withWatermark("ts", late).withColumn("epoch_day", F.unix_date(F.to_date("ts")).cast("int")).withColumn("id", F.col("id").cast("long"))
    return keyed.groupBy("key").transformWithStateInPandas(Registry(days), out, "Append", "EventTime")
