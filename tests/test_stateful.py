"""The rules behind the stateful streams: the same result wherever a micro-batch ends."""

import random

import pytest

from haulage.streaming import stateful as SF

HOUR = 3_600_000


def played(rows, cuts, end):
    """Outcomes of one loading: rows ``(at, kind, event)`` in micro-batches cut at ``cuts``, timers in between, time up to ``end``."""
    state, out = None, []
    for a, b in zip([0, *cuts], [*cuts, len(rows)]):
        for at, kind, event in rows[a:b]:
            if state is not None:
                state, more = SF.settle(state, at, strictly=True)
                out += more
            if kind == "start":
                state = state or SF.begun(at, *event)
            elif state is not None:
                state = SF.arrive(state, at, event)
        # a timer fires at most as late as the rows that have come
        mark = rows[b - 1][0] - HOUR if b else 0
        while state is not None and (due := SF.due(state)) is not None and due <= mark:
            state, more = SF.settle(state, due, strictly=False)
            out += more
    if state is not None:
        state, more = SF.settle(state, end, strictly=False)
        out += more
    return out


@pytest.mark.parametrize("seed", range(8))
def test_cuts_do_not_matter(seed):
    rnd = random.Random(seed)
    start = (rnd.choice(["and", "or"]), ["a", "b"], rnd.choice([3, 10]) * HOUR, rnd.randrange(4))
    rows = [(0, "start", start)] + [(rnd.randrange(0, 60 * HOUR, 600_000), "value", rnd.choice(["a", "c", "c", "b"])) for _ in range(rnd.choice([0, 3, 30]))]
    rows.sort(key=lambda r: (r[0], r[1]))
    whole = played(rows, [], 100 * HOUR)
    for _ in range(20):
        cuts = sorted(rnd.sample(range(1, len(rows)), min(len(rows) - 1, rnd.randrange(5)))) if len(rows) > 1 else []
        assert played(rows, cuts, 100 * HOUR) == whole
    assert all(a[0] <= b[0] for a, b in zip(whole, whole[1:])) and all(x[1] == "EVENT-WAIT" for x in whole[:-1])


def test_outcomes_of_a_wait():
    wait = lambda strategy, left, *values: played([(0, "start", (strategy, ["a", "b"], 2 * HOUR, left)), *[(int(h * HOUR), "value", e) for h, e in values]], [], 100 * HOUR)
    assert wait("or", 0) == [] and wait("and", 5) == [(2 * HOUR, "ERROR", 1, 5, -99)], "nothing has come: no retry"
    assert wait("or", 0, (1, "b")) == [(int(1.5 * HOUR), "READY", 1, 0, None)]
    assert wait("or", 0, (1, "b"), (1.5, "b"), (1.9, "c")) == [(2 * HOUR, "READY", 1, 0, None)], "a newer event holds it back, an event that is not awaited does not"
    assert wait("and", 2, (1, "a"), (3, "b")) == [(2 * HOUR, "EVENT-WAIT", 2, 1, None), (int(3.5 * HOUR), "READY", 2, 1, None)]
    assert wait("and", 1, (1, "a"), (9, "b")) == [(2 * HOUR, "EVENT-WAIT", 2, 0, None), (4 * HOUR, "ERROR", 2, 0, -99)]
    assert wait("and", 0, (1, "a"), (2, "b")) == [(int(2.5 * HOUR), "READY", 1, 0, None)], "what comes at the deadline has come"


def test_publications_of_a_key():
    state = {"keys": {}}
    minute = 60_000
    assert SF.publish(state, [(100 * minute, "k1"), (100 * minute, "k1"), (99 * minute, "k2"), (98 * minute, "k3")], 10 * minute) == [(100 * minute, "k1"), (99 * minute, "k2")]
    assert SF.publish(state, [(105 * minute, "k1"), (105 * minute, "k4")], 10 * minute) == [(105 * minute, "k4")]
    assert SF.publish(state, [(120 * minute, "k5")], 10 * minute) and set(state["keys"]) == {"k5"}
    assert SF.publish(state, [(121 * minute, "k1")], 10 * minute) == [(121 * minute, "k1")], "a key older than the horizon is forgotten"
