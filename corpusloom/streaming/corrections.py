"""Corrections that come before or after the candidates that they name, matched as state."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from corpusloom.functions import ledger

# the processor goes to the executors by value, as those may not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: The state store that keeps keyed lists and timers.
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
INPUT = "form string, kind string, pos_key string, cycle string, id string, at timestamp, body string"
OUTPUT = "pos_key string, id string, body string"


class Matcher(StatefulProcessor):
    """State of a form (a name that corrections use): the candidates that have it and the corrections that say it.

    Each new candidate meets the corrections that came before it, each new correction the candidates. Both are kept until the
    watermark passes the time of the form's last row by its keep time; then the state of the form goes.
    """

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.candidates = handle.getMapState("candidates", "pos_key string", "cycle string")
        self.corrections = handle.getMapState("corrections", "id string", "cycle string, body string")
        self.until = handle.getValueState("until", "ms long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        out, last = [], 0
        for part in rows:
            for r in part.itertuples(index=False):
                last = max(last, int(r.at.timestamp() * 1000))
                if r.kind == "candidate":
                    if self.candidates.containsKey((r.pos_key,)):
                        continue
                    self.candidates.updateValue((r.pos_key,), (r.cycle,))
                    out += [(r.pos_key, i, body) for (i,), (cycle, body) in self.corrections.iterator() if cycle in ("", r.cycle)]
                else:
                    if self.corrections.containsKey((r.id,)):
                        continue
                    self.corrections.updateValue((r.id,), (r.cycle, r.body))
                    out += [(pos_key, r.id, r.body) for (pos_key,), (cycle,) in self.candidates.iterator() if r.cycle in ("", cycle)]
        held = self.until.get()[0] if self.until.exists() else 0
        if last + self.keep_ms > held:
            if held:
                self.handle.deleteTimer(held)
            self.until.update((last + self.keep_ms,))
            self.handle.registerTimer(last + self.keep_ms)
        yield pd.DataFrame(out, columns=["pos_key", "id", "body"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.candidates.clear()
        self.corrections.clear()
        self.until.clear()
        yield pd.DataFrame([], columns=["pos_key", "id", "body"])

    def close(self) -> None:
        pass


def arrivals(candidates: DataFrame, corrections: DataFrame) -> DataFrame:
    """INPUT rows of candidates (pos_key, cycle, candidate, order, at), one for each form by which they may be named, and of corrections
    (id, about, in_cycle, at, ...), whose other columns are their body. Both may be streams."""
    both = F.col("candidate").rlike("^[0-9]+$") & F.col("cycle").rlike("^[0-9]+$")
    two = F.format_string("%02d", F.col("candidate").try_cast("long"))
    forms = F.array(F.lower("candidate"), F.lower("order"), F.when(both, F.concat(F.lit("c"), "cycle", F.lit("_"), two)), F.when(both, F.concat(F.lit("cc"), "cycle", F.lit("_"), two)))
    nothing = F.lit(None).cast("string")
    c = candidates.select(F.explode(F.array_distinct(F.array_compact(forms))).alias("form"), F.lit("candidate").alias("kind"), F.col("pos_key").cast("string").alias("pos_key"), F.col("cycle").cast("string").alias("cycle"), nothing.alias("id"), "at", nothing.alias("body"))
    about = F.lower(ledger.clean(F.col("about")))
    body = F.to_json(F.struct(*[x for x in corrections.columns if x not in ("id", "at")]))
    k = corrections.where(about != "").select(about.alias("form"), F.lit("correction").alias("kind"), nothing.alias("pos_key"), ledger.clean(F.col("in_cycle")).alias("cycle"), F.col("id").cast("string").alias("id"), "at", body.alias("body"))
    return c.unionByName(k)


def matched(rows: DataFrame, late: str = "1 hour", keep: str = "30 days") -> DataFrame:
    """OUTPUT rows: each candidate with each correction that names it, once for each form they share, in whatever order they come.

    rows: a stream of arrivals(). A form's state goes when the watermark (late behind the newest time) is keep past its last row, so what comes
    later than that isn't matched with what came before. The session must use PROVIDER as its state store.
    """
    keep_ms = int(pd.Timedelta(keep).total_seconds() * 1000)
    return rows.withWatermark("at", late).groupBy("form").transformWithStateInPandas(Matcher(keep_ms), OUTPUT, "Append", "EventTime")


def overlay_of(found: DataFrame, schema: str) -> DataFrame:
    """pos_key and the corrections' columns of OUTPUT rows, each candidate with each correction once, as joins.overlay takes them."""
    once = found.dropDuplicates(["pos_key", "id"])
    return once.select("pos_key", F.from_json("body", schema).alias("b")).select("pos_key", "b.*")
