"""Readiness told by a running stream: state per source, carried between micro-batches."""

from __future__ import annotations

from collections.abc import Iterator
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

if TYPE_CHECKING:
    import pandas as pd
    from pyspark.sql.streaming.state import GroupState

# What is known of a source: since when its lag is zero, the last sample taken into account, whether it has been
# called ready, and samples that the watermark has not passed yet, as seconds and whether one lags.
_STATE = "zero_since long, last long, ready boolean, waiting array<long>, lagging array<boolean>"


def step(
    known: tuple[int | None, int | None, bool], at: int, lagging: bool, hold: int, max_gap: int | None
) -> tuple[tuple[int | None, int | None, bool], list[tuple[str, int, int]]]:
    """What is known after a sample, and what is to be told: "ready" or "lost", when, and since when the lag was zero."""
    zero_since, last, ready = known
    told = []
    broken = max_gap is not None and last is not None and at - last > max_gap
    if ready and (broken or lagging):
        told.append(("lost", at, zero_since))
        ready = False
    if broken or lagging:
        zero_since = None
    if not lagging:
        zero_since = at if zero_since is None else zero_since
        if not ready and at - zero_since >= hold:
            ready = True
            told.append(("ready", at, zero_since))
    return (zero_since, at, ready), told


def readiness(
    samples: DataFrame, source: str, time: str, lag: Column, hold_seconds: int = 60, max_gap: int | None = None, delay: str = "1 minute"
) -> DataFrame:
    """A stream of `source`, `event` ("ready" or "lost"), `at` and `zero_since` (in seconds), as it becomes known.

    A source is ready at the first sample that comes `hold_seconds` or more after the first sample without lag since the last one with lag;
    an unknown lag is lag. It is lost at the next sample with lag, or, given `max_gap`, at one that comes more than so many seconds after the
    one before, since nobody looked in between; then zero counts anew. This is what `ready_to_cut_over` says at each sample.

    Samples may come out of order by `delay`: they wait in the state until the watermark has passed them, a timer wakes
    the source then, and they are taken in the order of their time. So what is told does not depend on how
    samples fall into micro-batches, nor on restarts: state and timers lie in the stream's checkpoint. Samples of one second count as
    one, lagging if any does. The state of a source holds the samples within `delay`, whatever the stream's age.
    """

    def update(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        import pandas as pd

        zero_since, last, ready, waiting, lagging = state.get if state.exists else (None, None, False, [], [])
        known = (zero_since, last, bool(ready))
        held = dict(zip(waiting, lagging, strict=True))
        for part in parts:
            for at, is_lagging in part.groupby("_at")["_lagging"].any().items():
                held[int(at)] = bool(is_lagging) or held.get(int(at), False)
        passed = state.getCurrentWatermarkMs()
        told = []
        # The watermark has passed a second when no sample of it can come any more.
        for at in sorted(s for s in held if (s + 1) * 1000 <= passed):
            known, new = step(known, at, held.pop(at), hold_seconds, max_gap)
            told += new
        waiting = sorted(held)
        state.update((*known, waiting, [held[s] for s in waiting]))
        if waiting:
            # Wakes once the watermark is above this.
            state.setTimeoutTimestamp((waiting[0] + 1) * 1000 - 1)
        if told:
            yield pd.DataFrame([(*key, *t) for t in told], columns=[source, "event", "at", "zero_since"])

    from pyspark.sql.streaming.state import GroupStateTimeout

    kind = samples.schema[source].dataType.simpleString()
    narrow = samples.withWatermark(time, delay).select(
        source, time, F.unix_seconds(time).alias("_at"), F.coalesce(lag > 0, F.lit(True)).alias("_lagging")
    )
    return narrow.groupBy(source).applyInPandasWithState(
        update, f"{source} {kind}, event string, at long, zero_since long", _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
