"""Frames of a block gathered together: one trip to the state store for all of them, each with its own end."""

from types import SimpleNamespace

import pandas as pd

from framewell.streaming.reports import BLOCK, SUMS, GatheredFrames


class Store:
    """A value state and its timers that count what is asked of them."""

    def __init__(self):
        self.value, self.timers, self.updates = None, set(), 0

    def getValueState(self, name, schema):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value, self.updates = value, self.updates + 1

    def clear(self):
        self.value = None

    def registerTimer(self, ms):
        self.timers.add(ms)


def lines(*places):
    rows = [(f, y, float(f), float(f + y), *[1.0] * len(SUMS)) for f, y in places]
    return iter([pd.DataFrame(rows, columns=["frame_id", "y", "low", "high", *SUMS])])


def test_blocks_report_each_frame_on_its_own():
    store = Store()
    gathered = GatheredFrames(height=2, wait_ms=100, keep_ms=1000)
    gathered.init(store)
    at = lambda ms: SimpleNamespace(getCurrentProcessingTimeInMs=lambda: ms)
    fired = lambda ms: SimpleNamespace(getExpiryTimeInMs=lambda: ms)

    def told(parts):
        rows = [r for part in parts for r in part.to_dict("records")]
        return [(r["frame_id"], r["status"], r["n_lines"], r["n_masked"]) for r in rows]

    first = 5 * BLOCK
    every = [(f, y) for f in range(first, first + BLOCK) for y in (0, 1)]
    assert told(gathered.handleInputRows((0, 5), lines(*every[:-4], every[0]), at(0))) == [
        (f, "whole", 2, 2) for f in range(first, first + BLOCK - 2)
    ]
    assert store.updates == 1 and store.timers == {1000}
    last = first + BLOCK - 1
    assert told(gathered.handleInputRows((0, 5), lines((last, 1), (last - 1, 0), (last - 1, 7)), at(50))) == []
    assert store.timers == {1000, 150}
    assert told(gathered.handleInputRows((0, 5), lines((last, 0), (first, 1)), at(60))) == [(last, "whole", 2, 2), (first, "late", 1, 0)]
    assert told(gathered.handleExpiredTimer((0, 5), at(150), fired(150))) == [(last - 1, "incomplete", 1, 1)]
    assert told(gathered.handleInputRows((0, 5), lines((last - 1, 1)), at(160))) == [(last - 1, "late", 1, 0)]
    assert told(gathered.handleExpiredTimer((0, 5), at(1000), fired(1000))) == []
    assert told(gathered.handleInputRows((0, 5), lines((first, 0), (first, 1)), at(1001))) == [(first, "whole", 2, 2)]  # forgotten before
    for ms in (1060, 1150, 2001):
        assert told(gathered.handleExpiredTimer((0, 5), at(ms), fired(ms))) == []
    assert store.value is None
