"""Event-time temporal joins: each fact meets the dimension's version that was valid at its time."""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def temporal_join(facts: DataFrame, versions: DataFrame, key: str, fact_time: str, version_time: str, version_key: str | None = None, order: list[str] | None = None) -> DataFrame:
    """facts LEFT JOIN the version of the same key with the greatest version_time <= fact_time. Versions with equal times: the last by `order`.

    Versions become intervals by one window over the key, and the join is an equi-join with a range condition."""
    version_key = version_key or key
    w = Window.partitionBy(version_key, version_time).orderBy(*(F.col(c).desc() for c in order or [version_time]))
    one = versions.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
    one = one.withColumn("_until", F.lead(version_time).over(Window.partitionBy(version_key).orderBy(version_time)))
    v = one.select(*(F.col(c).alias(f"_v_{c}") for c in one.columns))
    on = (facts[key] == v[f"_v_{version_key}"]) & (facts[fact_time] >= v[f"_v_{version_time}"]) & (v["_v__until"].isNull() | (facts[fact_time] < v["_v__until"]))
    rest = [c for c in versions.columns if c != version_key]
    return facts.join(v, on, "left").select(*(facts[c] for c in facts.columns), *(F.col(f"_v_{c}").alias(c if c not in facts.columns else f"version_{c}") for c in rest))


def temporal_join_stream(facts: DataFrame, versions: DataFrame, key: str, fact_time: str, version_time: str, lateness: str = "30 seconds") -> DataFrame:
    """The same join over two streams. Facts wait until the watermark passes their time; a version is kept while a waiting or future fact may need it. A stream
    that has a watermark keeps it; the other gets one on its time, late by `lateness`.

    Columns must not share names but for the key; times are TIMESTAMP."""
    fact_cols = T.StructType([f for f in facts.schema.fields if f.name != key])
    version_cols = T.StructType([f for f in versions.schema.fields if f.name != key])
    # Values travel and wait as JSON text, which pandas can't change: it makes floats of numbers where some are missing.
    options = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    side = lambda df, cols, k, time: df.select(key, F.to_json(F.struct(*cols.names), options).alias("row__"), F.lit(k).alias("side__"), F.col(time).alias("at__"))
    left, right = side(facts, fact_cols, 0, fact_time), side(versions, version_cols, 1, version_time)
    has = lambda df: "EventTimeWatermark" in df._jdf.queryExecution().analyzed().toString()
    both = (left if has(facts) else left.withWatermark("at__", lateness)).unionByName(right if has(versions) else right.withWatermark("at__", lateness))
    names = [key, "fact__", "version__"]
    out = T.StructType([facts.schema[key], *(T.StructField(x, T.StringType()) for x in names[1:])])
    from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

    waits = T.StructType([T.StructField("row", T.StringType()), T.StructField("at", T.LongType())])  # time in microseconds

    class Join(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.facts, self.versions = handle.getListState("facts", waits), handle.getListState("versions", waits)

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
            """A fact without a time has no version; a version without one is never valid."""
            for pdf in rows:
                now, new = [], ([], [])
                for k, row, at in zip(pdf["side__"].tolist(), pdf["row__"].tolist(), pdf["at__"], strict=True):
                    if pd.isna(at):
                        now += [(key[0], row, None)] if k == 0 else []
                        continue
                    micros = pd.Timestamp(at).value // 1000
                    new[k].append((row, micros))
                    if k == 0:
                        self.handle.registerTimer(-(-micros // 1000))
                for k, state in enumerate((self.facts, self.versions)):
                    if new[k]:
                        state.appendList(new[k])
                if now:
                    yield pd.DataFrame(now, columns=names, dtype=object)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
            """The watermark has passed the time of a fact: all facts up to it are joined at once, so later timers find less to do."""
            until = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs() - 1) * 1000
            waiting = list(self.facts.get())
            due, rest = [f for f in waiting if f[1] <= until], [f for f in waiting if f[1] > until]
            if not due:
                return
            versions = sorted(enumerate(self.versions.get()), key=lambda x: (x[1][1], x[0]))
            times = [v[1] for _, v in versions]
            rows = []
            for row, at in due:
                k = bisect.bisect_right(times, at)
                rows.append((key[0], row, versions[k - 1][1][0] if k else None))
            self.facts.put(rest) if rest else self.facts.clear()
            # The newest version up to here may still be asked for; older ones may not, once no waiting fact is older.
            kept = bisect.bisect_right(times, min([until, *(at for _, at in rest)])) - 1
            if kept > 0:
                self.versions.put([v for _, v in versions[kept:]])
            yield pd.DataFrame(rows, columns=names, dtype=object)

        def close(self) -> None:
            pass

    made = both.groupBy(key).transformWithStateInPandas(Join(), out, "Append", "EventTime")
    made = made.select(key, F.from_json("fact__", fact_cols, options).alias("f"), F.from_json("version__", version_cols, options).alias("v"))
    return made.select(key, *(F.col(f"f.`{n}`") for n in fact_cols.names), *(F.col(f"v.`{n}`") for n in version_cols.names))
