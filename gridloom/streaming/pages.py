"""Pages as a stream: types carried forward within each file, and running totals of reasons."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import partial

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import classify as K

TYPED = "path string, unit int, own_type string, doc_type string"


def _carry(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState, idle_ms: int = 0) -> Iterator[pd.DataFrame]:
    if state.hasTimedOut:
        state.remove()
        return
    units, types = (list(x) for x in state.get) if state.exists else ([], [])
    pages = pd.concat(list(batches)).sort_values("unit")
    out = []
    for unit, own in zip(pages["unit"].tolist(), pages["own_type"].tolist(), strict=True):
        known = isinstance(own, str)
        at = bisect_right(units, unit)
        if known and not (at and units[at - 1] == unit):
            units.insert(at, unit)
            types.insert(at, own)
        out.append((key[0], unit, own if known else None, own if known else (types[at - 1] if at else "unknown")))
    state.update((units, types))
    if idle_ms:
        state.setTimeoutDuration(idle_ms)
    yield pd.DataFrame(out, columns=["path", "unit", "own_type", "doc_type"])


def carry_types(pages: DataFrame, idle_ms: int = 0) -> DataFrame:
    """A stream of pages (path, unit, own_type): a page without a type of its own takes that of the nearest page before it.

    The state of a file holds its pages with types, so a page that comes late takes a type from before it, not
    from after it. It can't take one that comes later still. idle_ms: how long without pages a file's
    state is kept, for streams that run on; 0 keeps it always (a stream over what is available now needs that).
    """
    schema = "units array<int>, types array<string>"
    return pages.select("path", "unit", "own_type").groupBy("path").applyInPandasWithState(partial(_carry, idle_ms=idle_ms), TYPED, schema, "append", GroupStateTimeout.ProcessingTimeTimeout if idle_ms else GroupStateTimeout.NoTimeout)


def detect(pages: DataFrame) -> DataFrame:
    """own_type of a stream of pages (path, unit, text), where it is known."""
    typed = K.detect_types(pages)
    return typed.withColumn("own_type", F.when(F.col("doc_type") != "unknown", F.col("doc_type"))).drop("doc_type", "confidence", "path_type")


def windowed_reasons(units: DataFrame, window: str = "10 minutes", late: str = "10 minutes") -> DataFrame:
    """Rejected units (at, reasons) by window of time and reason; rows later than the watermark are left out."""
    each = units.withWatermark("at", late).select("at", F.explode("reasons").alias("reason"))
    return each.groupBy(F.window("at", window).alias("w"), "reason").agg(F.count("*").alias("n")).select("w.start", "w.end", "reason", "n")
