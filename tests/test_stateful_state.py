"""What a call of the stateful features reads and writes, on a state held in dicts."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from tallywatch.streaming import stateful
from tallywatch.streaming.stateful import DAY, HOUR, MINUTE, TrailingFeatures


class State(dict):
    """A value or map state that counts what is asked of it."""

    def __init__(self):
        super().__init__()
        self.asked = 0

    def __getattribute__(self, name):
        if name in ("get", "update", "getValue", "updateValue", "removeKey", "iterator"):
            self.asked += 1
        return super().__getattribute__(name)

    def get(self):
        return self.getValue(())

    def update(self, value):
        self.updateValue((), value)

    def getValue(self, key):
        return dict.get(self, key)

    def updateValue(self, key, value):
        self[key] = value

    def removeKey(self, key):
        self.pop(key)

    def iterator(self):
        return iter(list(self.items()))


class Handle:
    def __init__(self):
        self.states, self.timers = [], []

    def state(self, *_):
        self.states.append(State())
        return self.states[-1]

    getMapState = getValueState = state

    def registerTimer(self, at):
        self.timers.append(at)

    def asked(self):
        return sum(state.asked for state in self.states)


class Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def some_rows(micros, seed):
    random = np.random.default_rng(seed)
    n = len(micros)
    return pd.DataFrame(
        {
            "transaction_id": [f"t{seed}-{i:05d}" for i in range(n)],
            "event_time": pd.to_datetime(micros, unit="us"),
            "amount": random.uniform(1, 1e6, n).round(2),
            "merchant_country": random.choice(np.array(["US", "NG", "BR", "DE", None], object), n),
            "card_present": True,
            "is_high_risk_merchant": False,
            "micros": micros,
        }
    )


def test_one_call_asks_for_state_by_chunk_not_by_row():
    handle, features = Handle(), TrailingFeatures()
    features.init(handle)
    rows = some_rows(np.arange(2000) * 15 * MINUTE, 1)
    out = pd.concat(features.handleInputRows(("u",), iter([rows]), Clock(0)))
    assert len(out) == 2000 and handle.asked() <= 10
    before = handle.asked()
    list(features.handleExpiredTimer(("u",), Clock(3 * 10**9), None))
    assert handle.asked() - before <= 10
    assert sum(len(state) for state in handle.states) == 1


@pytest.mark.parametrize(("chunk", "gap"), [(4, 20 * MINUTE), (16, 1 * MINUTE), (512, 5 * MINUTE), (7, 2 * HOUR)])
def test_measures_equal_brute_force(monkeypatch, chunk, gap):
    monkeypatch.setattr(stateful, "CHUNK_ROWS", chunk)
    handle, features = Handle(), TrailingFeatures()
    features.init(handle)
    random = np.random.default_rng(chunk)
    at, got, top = 5 * DAY - HOUR, [], 0
    for number in range(40):
        # rows overlap the batch before, some share a time, and the watermark follows ten minutes behind
        micros = at + random.integers(-4, 12, 8) * (gap // 4) // 1_000_000 * 1_000_000
        micros = np.maximum(micros, top - 10 * MINUTE)
        rows = some_rows(micros, number)
        halves = iter([rows.iloc[:5], rows.iloc[5:].reset_index(drop=True)])
        watermark = max(0, (top - 10 * MINUTE) // 1000)
        got.append(pd.concat(features.handleInputRows(("u",), halves, Clock(watermark))).assign(batch=number, micros=micros))
        top, at = max(top, int(micros.max())), at + gap * int(random.integers(1, 9))
        if number % 9 == 8:
            list(features.handleExpiredTimer(("u",), Clock((top - 10 * MINUTE) // 1000), None))
    everything = pd.concat(got, ignore_index=True)
    for row in everything.itertuples():
        known = everything[everything.batch <= row.batch]

        def frame(length):
            return known[(known.micros > row.micros - length) & (known.micros <= row.micros)]

        hour, day = frame(HOUR), frame(DAY)
        assert (row.txn_count_1h, row.txn_count_24h) == (len(hour), len(day))
        assert row.total_amount_1h == pytest.approx(hour.amount.sum())
        assert row.avg_amount_1h == pytest.approx(hour.amount.mean())
        assert row.stddev_amount_1h == pytest.approx(0.0 if len(hour) == 1 else hour.amount.std(), abs=1e-6)
        assert row.max_amount_1h == hour.amount.max()
        assert row.burst_amount == pytest.approx(frame(MINUTE).amount.sum())
        assert row.country_count_24h == day.merchant_country.nunique()
        assert row.country_count_1h == day[day.micros // DAY == row.micros // DAY].merchant_country.nunique()
        upto = known.sort_values(["micros", "batch", "transaction_id"], kind="stable")
        place = int(np.flatnonzero(upto.transaction_id.to_numpy() == row.transaction_id)[0])
        last = upto.amount.to_numpy()[max(0, place - 99) : place + 1]
        if len(last) < 10:
            assert np.isnan(row.zscore_amount)
        else:
            assert row.zscore_amount == pytest.approx((row.amount - last.mean()) / (last.std(ddof=1) + 1e-9), abs=1e-9)


def test_equal_large_amounts_have_no_spread():
    amount = np.full(1000, 1e9 + 0.1)
    low = np.maximum(np.arange(1000) - 300, 0)
    total, around, top = stateful.spreads(amount, low, np.arange(1000) + 1)
    assert (around == 0).all() and (top == 1e9 + 0.1).all()
    assert total == pytest.approx((np.arange(1000) + 1 - low) * (1e9 + 0.1))
