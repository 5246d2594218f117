from pyspark.sql import Row

from millrace.streaming.source_state import SourceState


class Held:
    """A value, a map and timers that note every call, each of which is a round trip in a stream."""

    def __init__(self):
        self.value, self.map, self.timers, self.calls = None, {}, [], []

    def __getattr__(self, name):
        own = {
            "get": lambda: self.value, "update": lambda v: setattr(self, "value", v), "iterator": lambda: iter(list(self.map.items())),
            "updateValue": lambda k, v: self.map.__setitem__(k, v), "listTimers": lambda: iter(list(self.timers)),
            "deleteTimer": lambda t: self.timers.remove(t), "registerTimer": lambda t: self.timers.append(t), "getCurrentWatermarkInMs": lambda: 7,
        }[name]

        def called(*given):
            self.calls.append(name)
            return own(*given)

        return called


def test_few_calls_a_key():
    held, state = Held(), SourceState(1000, 3)
    state.handle = state.last = state.counts = held

    def take(*actions):
        held.calls.clear()
        rows = [Row(source_id="a", seq=s, action=a, ms=100 * s) for s, a in actions]
        return [tuple(r) for r in state.handleInputRows(("a",), iter(rows), held)]

    assert take((1, "seen"), (2, "pending"), (3, "seen")) == [("a", "state", True, False, True, 0, 7)]
    assert sorted(held.calls) == ["get", "getCurrentWatermarkInMs", "registerTimer", "update", "updateValue", "updateValue"]
    assert take((4, "seen")) == [("a", "state", True, False, True, 0, 7)] and held.timers == [1200]  # the timer stays
    assert "listTimers" not in held.calls
    assert take((6, "completed"), (5, "pending")) == [("a", "state", True, True, False, 0, 7)] and held.timers == []
    assert take((7, "seen")) == [("a", "state", True, True, False, 0, 7)] and "listTimers" not in held.calls
    assert held.map == {("seen",): (4,), ("pending",): (2,), ("completed",): (1,)} and held.value == (6, 5, 0)
