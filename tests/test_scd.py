import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from voltlake.operators.scd import scd2_history, scd2_refresh, scd2_snapshot

START = dt.datetime(2024, 1, 1)
HOW = {"key": ["k"], "ts": "ts", "tracked": ["state"]}


def at(hours):
    return START + dt.timedelta(hours=hours)


def observations(spark, rows):
    data = [(k, None if h is None else at(h), s, i) for i, (k, h, s) in enumerate(rows)]
    return spark.createDataFrame(data, "k STRING, ts TIMESTAMP, state STRING, n INT")


def versions(df):
    return sorted(
        (tuple(r[c] for c in ("k", "effective_from", "effective_to", "state", "is_current", "last_seen")) for r in df.collect()),
        key=str,
    )


def expected(rows):
    """Plain-Python history; the later row wins at equal times."""
    found = []
    for key in {k for k, h, _ in rows if k is not None and h is not None}:
        states = {h: s for k, h, s in rows if k == key and h is not None}
        starts = [
            (h, states[h]) for i, h in enumerate(sorted(states))
            if i == 0 or states[h] != states[sorted(states)[i - 1]]
        ]
        for i, (h, s) in enumerate(starts):
            last = i == len(starts) - 1
            found.append(
                (key, at(h), None if last else at(starts[i + 1][0]), s, last, at(max(states)) if last else None)
            )
    return sorted(found, key=str)


def test_three_versions_for_a_a_b_a(spark):
    rows = [("H1", 0, "A"), ("H1", 5, "A"), ("H1", 30, "B"), ("H1", 90, "A")]
    got = versions(scd2_history(observations(spark, rows), **HOW))
    assert [(v[1], v[2], v[3], v[4]) for v in got] == [
        (at(0), at(30), "A", False), (at(30), at(90), "B", False), (at(90), None, "A", True),
    ]


def test_a_hot_key_is_cut_into_buckets_without_changing_its_versions(spark):
    rows = [("hot", h, "AABBBA"[h % 6]) for h in range(300)] + [("H2", 3, "A"), ("H2", 9, "A")]
    seen = observations(spark, rows)
    assert versions(scd2_history(seen, **HOW, hot_rows=100, counted=seen)) == expected(rows)


def test_null_states_are_values_and_unkeyed_rows_are_left_out(spark):
    rows = [("H1", 0, None), ("H1", 1, None), ("H1", 2, "A"), (None, 1, "A"), ("H1", None, "Z")]
    got = versions(scd2_history(observations(spark, rows), **HOW))
    assert got == expected(rows)
    assert len(got) == 2


ROW = st.tuples(
    st.sampled_from(["H1", "H2", "H3"]), st.integers(0, 30).map(lambda i: i * 7), st.sampled_from(["A", "B", None])
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ROW, min_size=1, max_size=25), st.lists(ROW, min_size=1, max_size=10))
def test_refresh_equals_rebuild_with_late_rows(spark, before, batch):
    tie = {"tie_break": ["n"]}
    rebuilt = versions(scd2_history(observations(spark, before + batch), **HOW, **tie))
    assert rebuilt == expected(before + batch)
    both = observations(spark, before + batch)
    old, new = both.filter(f"n < {len(before)}"), both.filter(f"n >= {len(before)}")
    dimension = scd2_history(old, **HOW, **tie)
    assert versions(scd2_refresh(dimension, new, both, **HOW, **tie)) == rebuilt


def test_untouched_and_on_time_keys_do_not_read_the_history(spark):
    dimension = scd2_history(observations(spark, [("H1", 0, "A"), ("H2", 0, "A"), ("H2", 9, "A")]), **HOW)
    batch = observations(spark, [("H2", 10, "A"), ("H2", 11, "B"), ("H3", 1, "C")])
    empty = observations(spark, [("H0", 0, "A")]).filter("false")
    got = versions(scd2_refresh(dimension, batch, empty, **HOW))
    assert got == expected(
        [("H1", 0, "A"), ("H2", 0, "A"), ("H2", 10, "A"), ("H2", 11, "B"), ("H3", 1, "C")]
    )


DIMENSION = (
    "k STRING, state STRING, effective_from TIMESTAMP, effective_to TIMESTAMP, is_current BOOLEAN, last_seen TIMESTAMP"
)


def from_snapshots(spark, shots):
    """The history of full snapshots, each given as (hour, {key: state})."""
    dimension = spark.createDataFrame([], DIMENSION)
    for hour, states in shots:
        snapshot = spark.createDataFrame(list(states.items()), "k STRING, state STRING")
        dimension = scd2_snapshot(dimension, snapshot, ["k"], ["state"], at(hour))
        dimension = spark.createDataFrame(dimension.collect(), DIMENSION)
    return dimension


def expected_of_snapshots(shots):
    found = []
    for key in {k for _, states in shots for k in states if k is not None}:
        open_ = None
        for hour, states in shots:
            here = key in states
            if open_ and (not here or states[key] != open_[1]):
                found.append((key, at(open_[0]), at(hour), open_[1], False, None))
                open_ = None
            if here and not open_:
                open_ = (hour, states[key])
        if open_:
            found.append((key, at(open_[0]), None, open_[1], True, at(shots[-1][0])))
    return sorted(found, key=str)


SHOT = st.dictionaries(st.sampled_from(["H1", "H2", "H3", None]), st.sampled_from(["A", "B", None]), max_size=4)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(SHOT, min_size=1, max_size=4))
def test_snapshots_close_vanished_keys_and_reopen_them(spark, states):
    shots = [(7 * i, s) for i, s in enumerate(states)]
    assert versions(from_snapshots(spark, shots)) == expected_of_snapshots(shots)


def test_a_snapshot_that_comes_again(spark):
    shots = [(0, {"H1": "A", "H2": "A"}), (5, {"H1": "B"})]
    once = versions(from_snapshots(spark, shots))
    assert versions(from_snapshots(spark, shots + shots[1:])) == once
    # Another one of the same time replaces it.
    replaced = from_snapshots(spark, [*shots, (5, {"H1": "C", "H2": "A"})])
    assert versions(replaced) == [
        ("H1", at(0), at(5), "A", False, None), ("H1", at(5), None, "C", True, at(5)),
        ("H2", at(0), at(5), "A", False, None), ("H2", at(5), None, "A", True, at(5)),
    ]


def test_a_refresh_runs_nothing_while_it_is_planned(spark):
    dimension = scd2_history(observations(spark, [("H1", 0, "A")]), **HOW)
    batch = observations(spark, [("H1", 10, "B")])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    scd2_refresh(dimension, batch, batch, **HOW)
    assert list(tracker.getJobIdsForGroup("planning")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
