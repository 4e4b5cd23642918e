import pandas as pd
import pytest

from kerbside.operators import series


def test_trailing_mean_by_position_across_blocks(spark):
    ticks = [0, 1, 2, 3, 9, 10, 11, 40, 41, 90]
    frame = pd.DataFrame({"s": ["a"] * 10 + ["b"] * 4, "t": ticks + [5, 6, 7, 8],
                          "v": [float(i * i) for i in range(14)]})
    want = frame.assign(r=frame.groupby("s")["v"].transform(lambda v: v.rolling(5).mean()))
    got = series.trailing_mean(spark.createDataFrame(frame), ["s"], "t", ["v"], 5, block=6).toPandas()
    merged = want.merge(got, on=["s", "t"])
    assert len(got) == 14
    pd.testing.assert_series_equal(merged.r, merged.v_rolling, check_names=False)


def test_trailing_mean_is_null_when_a_value_in_the_window_is(spark):
    df = spark.createDataFrame([("a", i, None if i == 2 else 1.0) for i in range(9)],
                               "s string, t int, v double")
    got = series.trailing_mean(df, ["s"], "t", ["v"]).orderBy("t").collect()
    assert [r.v_rolling for r in got] == [None] * 7 + [1.0] * 2


def brute_transitions(rows):
    code = {"Low": 0, "Medium": 1, "High": 2}
    counts = {}
    by_trail = {}
    for session, vehicle, tick, label in rows:
        by_trail.setdefault((session, vehicle), []).append((tick, code.get(label, -1), label))
    for trail in by_trail.values():
        trail.sort()
        for a, b in zip(trail, trail[1:]):
            if a[1] >= 0 and b[1] >= 0:
                counts[a[2], b[2]] = counts.get((a[2], b[2]), 0) + 1
    return counts


@pytest.mark.parametrize("block", [1, 3, 4096])
def test_transitions_equal_brute_force_for_any_block(make_obs, block):
    import random
    rng = random.Random(5)
    rows = [(f"s{rng.randrange(2)}", rng.randrange(3), rng.randrange(25),
             rng.choice(["Low", "Medium", "High", "Unknown"])) for _ in range(150)]
    rows += [("s0", 0, 7, "Low")] * 40  # one tick with many copies
    df = make_obs(*[dict(session_id=s, vehicle_id=v, tick=t, congestion_label=l)
                    for s, v, t, l in rows])
    got = series.label_transitions(df, block=block).collect()
    want = brute_transitions(rows)
    assert {(r.from_label, r.to_label): r.n_pairs for r in got if r.n_pairs} == want
    for label in ("Low", "Medium", "High"):
        assert sum(r.pct for r in got if r.from_label == label) == pytest.approx(100, abs=1e-4)


def test_sessions_are_not_linked(make_obs):
    df = make_obs(dict(session_id="a", vehicle_id=1, tick=1, congestion_label="Low"),
                  dict(session_id="b", vehicle_id=1, tick=2, congestion_label="High"))
    assert sum(r.n_pairs for r in series.label_transitions(df).collect()) == 0


def test_mode_ties_go_to_the_lower_label(make_obs):
    df = make_obs({"congestion_label": "High"}, {"congestion_label": "Low"},
                  {"congestion_label": "Unknown"},
                  {"tick": 2, "congestion_label": "High"}, {"tick": 2, "congestion_label": None},
                  {"tick": 2, "congestion_label": None})
    got = {r.tick: r.mode_label for r in series.tick_profile(df).collect()}
    assert got == {1: "Low", 2: "High"}


def test_cumulative_rows(make_obs):
    df = make_obs({"session_id": "20240101_100000_a"}, {"session_id": "20240101_110000_b"},
                  {"session_id": "20240101_110000_b"}, {"session_id": "20240101_110500_c"})
    got = series.cumulative_rows(df).orderBy("session_id").collect()
    assert [r.cumulative_rows for r in got] == [1, 3, 4]
