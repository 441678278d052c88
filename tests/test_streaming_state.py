"""Frames that wait are held by lots: a micro-batch touches its state once a lot, not once a frame."""

import pandas as pd

from framewright.streaming import ordered


class State(dict):
    def __init__(self, calls):
        self.calls = calls

    def __getattribute__(self, name):
        if name in ("get", "exists", "update", "containsKey", "getValue", "updateValue", "removeKey", "keys"):
            object.__getattribute__(self, "calls").append(name)
        return object.__getattribute__(self, name)

    def exists(self):
        return "one" in self

    def get(self):
        return self["one"]

    def update(self, value):
        self["one"] = value

    def containsKey(self, key):  # noqa: N802
        return key in self

    def getValue(self, key):  # noqa: N802
        return self[key]

    def updateValue(self, key, value):  # noqa: N802
        self[key] = value

    def removeKey(self, key):  # noqa: N802
        self.pop(key, None)


class Handle:
    def __init__(self):
        self.calls, self.timers = [], []

    def getValueState(self, *a):  # noqa: N802
        return State(self.calls)

    getMapState = getValueState  # noqa: N815

    def listTimers(self):  # noqa: N802
        return self.timers

    def registerTimer(self, at):  # noqa: N802
        self.timers.append(at)


class Clock:
    def getCurrentProcessingTimeInMs(self):  # noqa: N802
        return 0


def test_calls_to_the_state(monkeypatch):
    handle, clean, out = Handle(), ordered._Clean(1000, 9), []
    clean.init(handle)
    places = range(600)
    for lot in ([i for i in places if i % 3 == 2], [i for i in places if i % 3 == 1], [i for i in places if i % 3 == 0]):
        frames = pd.DataFrame({"i": lot, "v": lot, "m": [i % 2 == 1 for i in lot]})
        for part in clean.handleInputRows((1,), iter([frames]), Clock()):
            out += list(zip(part["i"], part["v"], strict=True))
    assert out == [(i, i - i % 2) for i in places]
    assert len(handle.calls) < 100
