"""Bar by bar: average crosses and the ledger on a stream of daily bars.

State per instrument: the last closes that the slow average needs, the trade
pending from the last signal and the ledger's four figures.  Its size is fixed
by the slow period, whatever the length of the stream.

Defined results: bars of one micro-batch are taken in order of their day; a bar
whose day is not after the last one seen of its instrument comes out with
status "late" and changes nothing; bars with a missing price come out as
"incomplete" and change nothing; the rows of accepted bars equal those of the
batch operators.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from barloom.operators.ledger import RULES, Settings, striker
from barloom.session import discard_at_end, shared_folder

OUT = "code string, day date, status string, signal int, trade int, position double, market_value double, cash double, total_asset double"
_STATE = "last_day date, last_open double, bars long, closes array<long>, side int, known boolean, pending int, started boolean, lost boolean, units double, worth double, cash double, total double"


class Line:
    """One instrument's state; next() takes one bar of whole thousandths."""

    FIELDS = ("last_day", "last_open", "bars", "closes", "side", "known", "pending", "started", "lost", "units", "worth", "cash", "total")

    def __init__(self, fast: int, slow: int, settings: Settings, rules: str, saved: tuple | None = None):
        self.fast, self.slow, self.s, self.r = fast, slow, settings, RULES[rules]
        fresh = (None, 0.0, 0, [], 0, False, 0, False, False, 0.0, 0.0, float(settings.cash), float(settings.cash))
        for name, value in zip(self.FIELDS, saved or fresh, strict=True):
            setattr(self, name, value)
        self.closes = [int(x) for x in self.closes]

    def save(self) -> tuple:
        return tuple(getattr(self, f) for f in self.FIELDS)

    def next(self, day, o: int, c: int) -> tuple:
        """(status, signal, trade, position, market_value, cash, total_asset); nothing but a status in the warm-up."""
        change = o / self.last_open - 1 if self.bars else 0.0
        self.closes = [*self.closes, int(c)][-self.slow :]
        self.bars, self.last_day, self.last_open = self.bars + 1, day, float(o)
        if self.bars < self.slow:
            return ("warm-up", None, None, None, None, None, None)
        side = int(np.sign(sum(self.closes[-self.fast :]) * self.slow - sum(self.closes) * self.fast))
        before, known = self.side, self.known
        self.side, self.known = side, True
        if not known:
            return ("warm-up", None, None, None, None, None, None)
        signal = 1 if before <= 0 < side else -1 if side < 0 <= before else None
        trade, self.pending = self.pending, signal or 0
        if not self.started:
            self.started, trade = True, 0
        elif not self.lost:
            self._move(trade, o / 1000.0, change)
        if self.lost:
            return ("lost", signal, trade, None, None, None, None)
        return ("traded" if trade else "held", signal, trade, self.units + 0.0, self.worth, self.cash, self.total)

    def _move(self, trade: int, price: float, change: float) -> None:
        if trade and trade * self.units <= 0:
            self.units, self.worth, self.cash = striker(self.s, self.r)(trade, price, self.units, self.worth, self.cash)
            self.total = self.worth + self.cash
        elif trade and self.r.repeat == "lost":
            self.lost = True
        elif self.units:
            self.worth *= 1 + np.sign(self.units) * change
            self.worth = float(self.worth)
            self.total = self.worth + self.cash
        else:
            self.worth = 0.0


def run_online(bars: DataFrame, fast: int = 5, slow: int = 20, settings: Settings | None = None, rules: str = "d") -> DataFrame:
    """A row per bar of a stream (or of a table) with code, day (date), o and c (whole thousandths)."""
    s = settings or Settings()

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        line = Line(fast, slow, s, rules, state.get if state.exists else None)
        p = pd.concat(list(batches)).sort_values("day")
        rows = []
        for day, o, c in zip(p["day"], p["o"], p["c"], strict=True):
            if pd.isna(day) or pd.isna(o) or pd.isna(c):
                rows.append((key[0], None if pd.isna(day) else day, "incomplete", *[None] * 6))
            elif line.last_day is not None and day <= line.last_day:
                rows.append((key[0], day, "late", *[None] * 6))
            else:
                rows.append((key[0], day, *line.next(day, int(o), int(c))))
        state.update(line.save())
        names = [x.split()[0] for x in OUT.split(", ")]
        out = pd.DataFrame(rows, columns=names)
        yield out.astype({"signal": "Int32", "trade": "Int32", **{c: "float64" for c in names[5:]}})

    return bars.select("code", "day", "o", "c").groupBy("code").applyInPandasWithState(step, OUT, _STATE, "append", GroupStateTimeout.NoTimeout)


def replay_online(bars: DataFrame, fast: int = 5, slow: int = 20, settings: Settings | None = None, rules: str = "d") -> DataFrame:
    """The rows of run_online for a finished table of bars, put through a stream that ends with it.

    The stream runs when this is called.  Input, progress and output lie in the shared folder until the
    application ends."""
    spark, at = bars.sparkSession, f"{shared_folder(bars.sparkSession)}/online-{uuid.uuid4().hex}"
    discard_at_end(spark, at)
    bars.select("code", "day", "o", "c").write.parquet(f"{at}/in")
    stream = spark.readStream.schema(spark.read.parquet(f"{at}/in").schema).parquet(f"{at}/in")
    query = run_online(stream, fast, slow, settings, rules).writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/progress").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(OUT).parquet(f"{at}/out")
