"""Keyed state that puts a stream's rows in the order of their times and answers what the watermark has settled.

Rows wait, in Arrow batches, until the watermark has passed whatever depends on them; then a rule looks at all waiting
rows of a key at once, as arrays. A rule says for each of its answers from which moment on nothing can change it
(``decided``); an answer leaves when the watermark passes that moment, once. Rows stay as long as a later answer may look
back at them.

The key of a pattern is (bucket of users or orders, stretch of time), with copies of the rows just before or after a
stretch as in ``plans.lookahead``. So state and work per key are bounded by what happens in a stretch, however much a user
does. A call of a rule and its state costs milliseconds however few its rows are, so users share a key: a rule takes the
rows of all owners of a bucket at once, sorted by owner, and the number of calls does not grow with the users.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.event_time import floor_to
from ..plans.lookahead import STRETCH

# Keys that the owners of a stretch's rows are dealt to by hash; fixed for a checkpoint.
BUCKETS = 256
NEVER = np.iinfo(np.int64).min
# a missing id sorts first, as in batch, and is taken out again by ``without_ids``
NO_ID = int(NEVER)


@dataclass
class Rows:
    """Waiting rows in (us, id) order, those of a rule with an owner in (owner, us, id) order; ``of`` holds the other
    columns by name."""

    us: np.ndarray
    id: np.ndarray
    of: pd.DataFrame
    owner: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.us)

    def first_at(self, least: np.ndarray) -> np.ndarray:
        """Per row, where its owner's rows at or after the moment ``least``, not later than the row's own, begin."""
        n = len(self)
        # asking and asked rows sorted together: an asking row comes before what it looks for
        order = np.lexsort((np.repeat([0, 1], n), np.append(least, self.us), np.tile(self.owner, 2)))
        found = np.empty(2 * n, np.int64)
        found[order] = np.cumsum(order >= n)
        return found[:n]


class Rule:
    """``columns``: what is kept of a row besides us and id. ``keep``: for how long (µs) a row may be looked back at.
    ``owner``: the column of whose rows are answered apart, if a key has those of several."""

    columns: list[str]
    keep: int
    owner: str | None = None

    @property
    def order(self) -> list[str]:
        return [*([self.owner] if self.owner else []), "us", "id"]

    def settle(self, key: tuple, rows: Rows, carry: bytes) -> tuple[np.ndarray, pd.DataFrame]:
        """All answers of the waiting rows, and the moment (µs) each is decided at."""
        raise NotImplementedError

    def carried(self, key: tuple, rows: Rows, carry: bytes, since: int, now: int) -> bytes:
        """What is kept besides rows, once those in (since, now] are settled; nothing by default."""
        return b""

    def until(self, key: tuple) -> int:
        """The moment from which on ``carried`` is empty."""
        return int(NEVER)


def _put_away(frame: pd.DataFrame) -> bytes:
    batch = pa.RecordBatch.from_pandas(frame, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _taken_out(bodies: list[bytes]) -> pd.DataFrame:
    return pd.concat([pa.ipc.open_stream(body).read_all().to_pandas() for body in bodies], ignore_index=True)


def _timer(us: int) -> int:
    """First whole millisecond at or after a moment."""
    return -(-int(us) // 1000)


class Reordered(StatefulProcessor):
    """Runs a rule over the rows of each key as the watermark goes on."""

    def __init__(self, rule: Rule) -> None:
        self.rule = rule

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "body binary")
        self.done = handle.getValueState("done", "us bigint, carry binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        least = None
        for frame in rows:
            if len(frame):
                self.rows.appendValue((_put_away(frame[[*self.rule.order, *self.rule.columns]]),))
                first = int(frame["us"].min())
                least = first if least is None else min(least, first)
        if least is None:
            return
        now = timerValues.getCurrentWatermarkInMs()
        if _timer(least) <= now:  # rows that a step before this one has already held back
            yield from self._settled(key, now)
        else:
            self.handle.registerTimer(_timer(least))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._settled(key, max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()))

    def _settled(self, key, now_ms: int) -> Iterator[pd.DataFrame]:
        bodies = [body for (body,) in self.rows.get()]
        since, carry = self.done.get() if self.done.exists() else (int(NEVER), b"")
        now = now_ms * 1000
        if not bodies:
            if now >= self.rule.until(key):
                self.done.clear()
            return
        if len(bodies) == 1 and since >= now:
            return
        frame = _taken_out(bodies).sort_values(self.rule.order, kind="stable", ignore_index=True)
        owner = frame[self.rule.owner].to_numpy() if self.rule.owner else None
        rows = Rows(frame["us"].to_numpy(), frame["id"].to_numpy(), frame, owner)
        decided, answers = self.rule.settle(key, rows, carry)
        due = (decided > since) & (decided <= now)
        carry = self.rule.carried(key, rows, carry, since, now)
        kept = frame[rows.us > now - self.rule.keep]
        later = decided[decided > now]
        if len(kept) or carry:
            if len(kept):
                self.rows.put([(_put_away(kept),)])
            else:
                self.rows.clear()
            self.done.update((now, carry))
            moments = [*([later.min()] if len(later) else []), *([kept["us"].max() + self.rule.keep] if len(kept) else []),
                       *([self.rule.until(key)] if carry else [])]
            self.handle.registerTimer(max(_timer(min(moments)), now_ms + 1))
        else:
            self.rows.clear()
            self.done.clear()
        if due.any():
            yield answers[due]

    def close(self) -> None:
        pass


def in_stretches(rows: DataFrame, reach: int, after: Column | None = None, before: Column | None = None,
                 stretch: int = STRETCH) -> DataFrame:
    """Each row in its ``stretch`` (named by its start, µs), and copies in the one before or behind it.

    Rows up to ``reach`` behind a stretch's end are copied into it where ``after`` holds, rows up to ``reach`` before its
    start where ``before`` holds.
    """
    length = max(1, stretch) * reach
    us = F.col("us")
    home = floor_to(us, length)
    places = [F.array(home)]
    for shift, wanted in ((-reach, after), (reach, before)):
        if wanted is not None:
            place = floor_to(us + F.lit(shift), length)
            places.append(F.when(wanted & (place != home), F.array(place)).otherwise(F.array().cast("array<bigint>")))
    return rows.withColumn("stretch", F.explode(F.concat(*places)))


def in_buckets(rows: DataFrame, owner: str, buckets: int = BUCKETS) -> DataFrame:
    """Each row in the ``bucket`` of its owner."""
    return rows.withColumn("bucket", F.pmod(F.xxhash64(owner), F.lit(buckets)))


def reordered(rows: DataFrame, keys: list[str], rule: Rule, out: str) -> DataFrame:
    """Answers of ``rule``; ``rows`` carry a watermark, ``us``, ``id``, the rule's owner and its columns. Keys are bigints.

    Missing ids, owners and keys stand as ``NO_ID`` inside, as groups without a key would be lost on the way to Python.
    """
    missing = ["id", *keys, *([rule.owner] if rule.owner else [])]
    rows = rows.withColumns({c: F.coalesce(F.col(c), F.lit(NO_ID)) for c in missing})
    return rows.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=Reordered(rule), outputStructType=out, outputMode="Append", timeMode="eventTime")


def without_ids(rows: DataFrame, *columns: str) -> DataFrame:
    """Ids that were missing are null again."""
    return rows.withColumns({c: F.nullif(F.col(c), F.lit(NO_ID)) for c in columns})
