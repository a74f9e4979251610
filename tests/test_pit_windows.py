"""Before / after frames of pit laps against a plain loop."""

import numpy as np
import pytest

from lapstats.operators import features as FE


def _laps(spark):
    rng = np.random.default_rng(4)
    rows = []
    for driver in ("x", "y"):
        for n in rng.integers(1, 60, 50).tolist():  # gaps and repeated lap numbers
            rows.append(("r", driver, int(n), float(rng.normal(90, 2)) if rng.random() > 0.1 else None,
                         bool(rng.random() < 0.3), bool(rng.random() < 0.2)))
    rows.append(("r", "x", None, 91.0, False, True))
    return rows, spark.createDataFrame(
        rows, "race string, driver string, lap_number int, lap_time double, is_outlier boolean, is_pit_lap boolean")


def _mean(values):
    values = [v for v in values if v is not None]
    return sum(values) / len(values) if values else None


@pytest.mark.parametrize("piece", [512, 4])
def test_frames_equal_a_loop_and_do_not_multiply_laps(spark, monkeypatch, piece):
    monkeypatch.setattr(FE, "PIECE_LAPS", piece)
    rows, laps = _laps(spark)
    want = []
    for _, d, n, _, _, pit in rows:
        if pit:
            near = lambda lo, hi: [t for _, e, m, t, out, _ in rows
                                   if n is not None and m is not None and e == d and not out and n + lo <= m <= n + hi]
            want.append((d, n, _mean(near(-3, -1)), _mean(near(1, 3))))
    out = FE.pit_windows(laps, ["race"])
    key = lambda r: (r[0], r[1] is None, r[1] or 0)
    got = sorted(((r.driver, r.lap_number, r.before_avg, r.after_avg) for r in out.collect()), key=key)
    assert len(got) == len(want)
    for g, w in zip(got, sorted(want, key=key)):
        assert g[:2] == w[:2]
        for a, b in zip(g[2:], w[2:]):
            assert a == (None if b is None else pytest.approx(b))


def test_laps_are_not_copied_for_each_lap_they_neighbour(spark):
    """The fan-out to six lap numbers shuffled every lap six times."""
    plan = FE.pit_windows(_laps(spark)[1], ["race"])._jdf.queryExecution().optimizedPlan().toString()
    assert "explode([1,2,3,-1,-2,-3])" not in plan and "array_distinct" in plan
