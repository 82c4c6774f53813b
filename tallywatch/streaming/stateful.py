"""Per-transaction trailing features on a stream.

State per user is held in chunks of rows in time order, and an index of their
limits, counts and countries with the rows that do not fill a chunk yet. A call reads the chunks of the last hour and
those in which frames begin; of chunks in between only the index is needed. All
rows of a call are measured at once on arrays. A frame costs the logarithm of
its rows. The last hundred amounts older than a day are kept for the row
z-score. What one call receives is bounded by the source's intake per trigger.
"""

from __future__ import annotations

import sys
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tallywatch.config import RuleConfig
from tallywatch.functions.times import epoch_micros
from tallywatch.operators.transaction_features import (
    ZSCORE_EPSILON,
    ZSCORE_MIN_ROWS,
    ZSCORE_ROWS,
    flag_features,
    time_features,
)

# Workers get the processor by value, so they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MINUTE = 60_000_000
HOUR = 60 * MINUTE
DAY = 24 * HOUR

OUTPUT_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("transaction_id", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("merchant_country", T.StringType()),
        T.StructField("card_present", T.BooleanType()),
        T.StructField("is_high_risk_merchant", T.BooleanType()),
        T.StructField("txn_count_1h", T.LongType()),
        T.StructField("total_amount_1h", T.DoubleType()),
        T.StructField("avg_amount_1h", T.DoubleType()),
        T.StructField("stddev_amount_1h", T.DoubleType()),
        T.StructField("max_amount_1h", T.DoubleType()),
        T.StructField("txn_count_24h", T.LongType()),
        T.StructField("burst_amount", T.DoubleType()),
        T.StructField("country_count_24h", T.LongType()),
        T.StructField("country_count_1h", T.LongType()),
        T.StructField("zscore_amount", T.DoubleType()),
    ]
)
INPUTS = [f.name for f in OUTPUT_SCHEMA.fields[1:7]]
MEASURES = [f.name for f in OUTPUT_SCHEMA.fields[7:]]
# Rows a chunk of state holds; a row of state is read or written for a chunk, not for a transaction.
CHUNK_ROWS = 512
LONGS = T.ArrayType(T.LongType())
NAMES = T.ArrayType(T.StringType())
CHUNK_SCHEMA = T.StructType([T.StructField("chunk", T.LongType())])
ROWS = [T.StructField("at", LONGS), T.StructField("amount", T.ArrayType(T.DoubleType())), T.StructField("country", NAMES)]
ROWS_SCHEMA = T.StructType(ROWS)
INDEX_SCHEMA = T.StructType(
    [
        T.StructField("chunk", LONGS),
        T.StructField("first", LONGS),
        T.StructField("last", LONGS),
        T.StructField("n", LONGS),
        T.StructField("countries", T.ArrayType(NAMES)),
        T.StructField("older", T.ArrayType(T.DoubleType())),
        *ROWS,
    ]
)


class Chunk(NamedTuple):
    """What the index says of a chunk: its number, first and last time, rows and countries."""

    number: int
    first: int
    last: int
    n: int
    countries: list[str]


def spreads(amount: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sum, squared deviation and maximum of each ``amount[low:high]``; no frame is empty.

    A frame is put together from runs of 1, 2, 4 and so on values. Runs and
    frames merge, nothing is subtracted, and a frame costs the logarithm of
    its rows.
    """
    n, mean, total, around = (np.zeros(len(low)) for _ in range(4))
    top = np.full(len(low), -np.inf)
    start, left, size = low.copy(), high - low, 1
    sums, deviations, highs = amount, np.zeros(len(amount)), amount
    longest = left.max()
    while True:
        chosen = np.flatnonzero(left & size)
        run = start[chosen]
        gap = sums[run] / size - mean[chosen]
        both = n[chosen] + size
        around[chosen] += deviations[run] + gap * gap * (n[chosen] * size / both)
        mean[chosen] += gap * (size / both)
        total[chosen] += sums[run]
        top[chosen] = np.maximum(top[chosen], highs[run])
        n[chosen] = both
        start[chosen] += size
        if 2 * size > longest:
            return total, around, top
        gap = (sums[size:] - sums[:-size]) / size
        deviations = deviations[:-size] + deviations[size:] + gap * gap * (size / 2)
        sums = sums[:-size] + sums[size:]
        highs = np.maximum(highs[:-size], highs[size:])
        size *= 2


def distinct_seen(at: np.ndarray, code: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in the day before each time, and in its calendar day up to it.

    A code counts from each occurrence until a day later. Where such spans
    begin less where they end, up to a time, is the number open then.
    """
    order = np.lexsort((at, code))
    at, code = at[order], code[order]
    same = code[1:] == code[:-1]
    apart = ~(same & (at[1:] - at[:-1] < DAY))
    begins, ends = np.sort(at[np.r_[True, apart]]), np.sort(at[np.r_[apart, True]] + DAY)
    open_then = np.searchsorted(begins, times, side="right") - np.searchsorted(ends, times, side="right")
    firsts = np.sort(at[np.r_[True, ~(same & (at[1:] // DAY == at[:-1] // DAY))]])
    today = np.searchsorted(firsts, times, side="right") - np.searchsorted(firsts, times - times % DAY, side="left")
    return open_then, today


def row_zscores(amounts: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Distance of each of ``rows`` from the mean of the hundred amounts that end there; NaN below ten."""
    found = np.empty(len(rows))
    padded = np.r_[np.full(ZSCORE_ROWS - 1, np.nan), amounts]
    frames = np.lib.stride_tricks.sliding_window_view(padded, ZSCORE_ROWS)
    for begin in range(0, len(rows), CHUNK_ROWS):
        some = rows[begin : begin + CHUNK_ROWS]
        held, seen = frames[some], np.minimum(some + 1, ZSCORE_ROWS)
        mean = np.nansum(held, axis=1) / seen
        around = np.nansum((held - mean[:, None]) ** 2, axis=1)
        z = (amounts[some] - mean) / (np.sqrt(around / np.maximum(seen - 1, 1)) + ZSCORE_EPSILON)
        z[seen < ZSCORE_MIN_ROWS] = np.nan
        found[begin : begin + CHUNK_ROWS] = z
    return found


class TrailingFeatures(StatefulProcessor):
    """Counts, amounts and countries over the last minute, hour and day."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getMapState("rows", CHUNK_SCHEMA, ROWS_SCHEMA)
        self.index = handle.getValueState("index", INDEX_SCHEMA)

    def past(self) -> tuple[list[Chunk], list[float], tuple]:
        """The chunks in time order, the last amounts before them, and the rows after them."""
        held = self.index.get()
        if not held:
            return [], [], ([], [], [])
        return [Chunk(*values) for values in zip(*held[:5])], list(held[5]), tuple(held[6:])

    def store(self, chunks: list[Chunk], older: list[float], tail: tuple) -> None:
        columns = [list(values) for values in zip(*chunks)] or [[] for _ in Chunk._fields]
        self.index.update((*columns, older, *tail))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frames = list(rows)
        new = frames[0] if len(frames) == 1 else pd.concat(frames, ignore_index=True)
        times = new["micros"].to_numpy()
        by_time = np.argsort(times, kind="stable")
        if (np.diff(times[by_time]) == 0).any():
            by_time = new.reset_index(drop=True).sort_values(["micros", "transaction_id"], kind="stable").index.to_numpy()
        times = times[by_time]
        begin, end = int(times[0]), int(times[-1])
        chunks, older, tail = self.past()

        # chunks that the new rows reach into are cut anew, with the rows after them
        cut = next((i for i, c in enumerate(chunks) if c.last >= begin), len(chunks))
        # row z-scores look back over rows, so the chunks that hold those are read, too
        near, before = cut, 0
        while near > 0 and (before < ZSCORE_ROWS or chunks[near - 1].last > begin - HOUR):
            near -= 1
            before += chunks[near].n
        limits = ((begin - DAY, end - DAY), (begin - begin % DAY - 1, end - end % DAY - 1))
        # of the rest, only chunks that a frame may begin in
        read = [
            i for i, c in enumerate(chunks) if i >= near or any(c.first <= upto and c.last > above for above, upto in limits)
        ]
        parts = [*[self.rows.getValue((chunks[i].number,)) for i in read], tail]
        country = [c for p in parts for c in p[2]]
        country += [c if isinstance(c, str) else None for c in new["merchant_country"].to_numpy()[by_time]]
        at = np.concatenate([*[np.asarray(p[0], "int64") for p in parts], times])
        amount = np.concatenate([*[np.asarray(p[1], "float64") for p in parts], new["amount"].to_numpy("float64")[by_time]])
        order = np.argsort(at, kind="stable")
        place = np.empty(len(at), "int64")
        place[order] = np.arange(len(at))
        place = place[len(at) - len(times) :]
        at, amount, country = at[order], amount[order], [country[i] for i in order.tolist()]

        # chunks that were not read lie in a frame as a whole or not at all
        here = set(read)
        result = self.measures(times, at, amount, country, [c for i, c in enumerate(chunks) if i not in here])
        result["zscore_amount"] = row_zscores(np.r_[older, amount], place + len(older))

        fixed = sum(chunks[i].n for i in read if i < cut)
        kept, older = self.without_old(chunks[:cut], older, self.limit(timerValues))
        if not kept:
            gone = fixed + int(np.searchsorted(at[fixed:], self.limit(timerValues)))
            older = np.r_[older, amount[fixed:gone]][-ZSCORE_ROWS:].tolist()
            fixed = gone
        numbers = [c.number for c in chunks[cut:]]
        unused = max([-1, *[c.number for c in chunks]]) + 1
        while len(at) - fixed >= CHUNK_ROWS:
            own = slice(fixed, fixed + CHUNK_ROWS)
            number = numbers.pop() if numbers else unused
            unused += number == unused
            self.rows.updateValue((number,), (at[own].tolist(), amount[own].tolist(), country[own]))
            seen = sorted({c for c in country[own] if c is not None})
            kept.append(Chunk(number, int(at[fixed]), int(at[own][-1]), CHUNK_ROWS, seen))
            fixed += CHUNK_ROWS
        for number in numbers:
            self.rows.removeKey((number,))
        tail = (at[fixed:].tolist(), amount[fixed:].tolist(), country[fixed:])
        self.store(kept, older, tail)
        self.come_back(kept, tail)

        as_given = np.empty_like(by_time)
        as_given[by_time] = np.arange(len(by_time))
        columns = {name: new[name].array for name in INPUTS} | {name: values[as_given] for name, values in result.items()}
        yield pd.DataFrame({"user_id": np.full(len(new), key[0], dtype=object), **columns}, copy=False)

    def measures(self, times, at, amount, country, whole: list[Chunk]) -> dict[str, np.ndarray]:
        upto = np.searchsorted(at, times, side="right")
        frames = [(np.searchsorted(at, times - frame, side="right"), upto) for frame in (HOUR, MINUTE)]
        # rows of an hour are all here, so their number is that of their places
        n = frames[0][1] - frames[0][0]
        total, around, top = spreads(amount, *frames[0])
        firsts = np.asarray([c.first for c in whole], "int64")
        running = np.r_[0, np.cumsum([c.n for c in whole], dtype="int64")]

        def rows_upto(limit: np.ndarray) -> np.ndarray:
            return np.searchsorted(at, limit, side="right") + running[np.searchsorted(firsts, limit, side="right")]

        codes: dict[str, int] = {}
        seen = [(t, c) for t, c in zip(at.tolist(), country) if c is not None]
        seen += [(chunk.first, c) for chunk in whole for c in chunk.countries]
        code = np.asarray([codes.setdefault(c, len(codes)) for _, c in seen], "int64")
        last_day, today = distinct_seen(np.asarray([t for t, _ in seen], "int64"), code, times) if seen else (0 * times, 0 * times)
        return {
            "txn_count_1h": n,
            "total_amount_1h": total,
            "avg_amount_1h": total / n,
            "stddev_amount_1h": np.where(n > 1, np.sqrt(around / np.maximum(n - 1, 1)), 0.0),
            "max_amount_1h": top,
            "txn_count_24h": rows_upto(times) - rows_upto(times - DAY),
            "burst_amount": spreads(amount, *frames[1])[0],
            "country_count_24h": last_day,
            "country_count_1h": today,
        }

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        chunks, older, tail = self.past()
        limit = self.limit(timerValues)
        kept, older = self.without_old(chunks, older, limit)
        gone = 0 if kept else bisect_left(tail[0], limit)
        if gone or len(kept) < len(chunks):
            older, tail = [*older, *tail[1][:gone]][-ZSCORE_ROWS:], tuple(column[gone:] for column in tail)
            self.store(kept, older, tail)
        self.come_back(kept, tail)
        return iter([])

    def limit(self, timerValues) -> int:
        """The time before which no later transaction can reach, a full minute."""
        return (timerValues.getCurrentWatermarkInMs() * 1000 - DAY) // MINUTE * MINUTE

    def without_old(self, chunks: list[Chunk], older: list[float], limit: int) -> tuple[list[Chunk], list[float]]:
        """Drops the chunks before the limit but for their last amounts."""
        many = next((i for i, c in enumerate(chunks) if c.last >= limit), len(chunks))
        amounts: list[float] = []
        for chunk in reversed(chunks[:many]):
            if len(amounts) < ZSCORE_ROWS:
                amounts = [*self.rows.getValue((chunk.number,))[1], *amounts]
            self.rows.removeKey((chunk.number,))
        return chunks[many:], [*older, *amounts][-ZSCORE_ROWS:]

    def come_back(self, chunks: list[Chunk], tail: tuple) -> None:
        """A timer for the rest, rounded up to a full hour, so a busy user has few."""
        if chunks or tail[0]:
            last = tail[0][-1] if tail[0] else chunks[-1].last
            done = last // MINUTE * MINUTE + 2 * MINUTE + DAY
            self.handle.registerTimer(-(-done // HOUR) * (HOUR // 1000))

    def close(self) -> None:
        pass


def trailing_stream_features(transactions: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """Per-transaction features, emitted as each transaction arrives.

    Values reflect what has arrived: a late row is measured against its own
    past, and rows already emitted are not revised. ``country_count_1h`` counts
    the countries of the calendar day so far. Rows without event time have no
    past and are left to the dead-letter split.
    """
    timed = transactions.where(F.col("event_time").isNotNull())
    rows = timed.withWatermark("event_time", watermark).select(
        "user_id",
        "transaction_id",
        "event_time",
        "amount",
        "merchant_country",
        "card_present",
        "is_high_risk_merchant",
        epoch_micros(F.col("event_time")).alias("micros"),
    )
    return rows.groupBy("user_id").transformWithStateInPandas(
        statefulProcessor=TrailingFeatures(),
        outputStructType=OUTPUT_SCHEMA,
        outputMode="Append",
        timeMode="EventTime",
    )


def model_inputs(features: DataFrame) -> DataFrame:
    """Adds the remaining inputs of the model to streamed features."""
    return flag_features(time_features(features))


def stream_rules(features: DataFrame, cfg: RuleConfig = RuleConfig()) -> DataFrame:
    return features.withColumns(
        {
            "rule_burst_amount": F.col("burst_amount") > cfg.burst_amount_above,
            "rule_country_spread": F.col("country_count_24h") > cfg.country_count_above,
        }
    )
