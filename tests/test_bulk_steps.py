"""Steps that every query over the order lines shares: each lap is sorted once, written once and not copied."""

import datetime as dt

import numpy as np
import pytest

from lapstats.functions.aggregates import medians_by_key
from lapstats.operators import features as FE
from lapstats.sources.adapters import laps_from_lineitem


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("bulk"))
    rng = np.random.default_rng(3)
    rows = [(int(i), int(rng.integers(0, 50)), int(rng.integers(0, 3)), 1, float(rng.integers(1, 50)),
             float(rng.integers(1000, 90000)), float(rng.choice([0.0, 0.05, 0.1])), float(rng.choice([0.0, 0.01, 0.08])),
             "A", "F", dt.datetime(1995, int(rng.integers(1, 13)), int(rng.integers(1, 28)))) for i in range(200)]
    rows += [(1000, 1, None, 1, 1.0, 5000.0, 0.0, 0.0, "A", "F", dt.datetime(1995, 1, 1)),
             (1001, 1, 1, 1, 1.0, None, 0.0, 0.0, None, "F", None)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                          "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                          "l_shipdate timestamp_ntz").write.parquet(f"{d}/lineitem.parquet")
    spark.createDataFrame([(0, 0), (1, 0), (2, 1)], "s_suppkey long, s_nationkey int").write.parquet(f"{d}/supplier.parquet")
    spark.createDataFrame([(0, "PERU"), (1, "CHINA")], "n_nationkey int, n_name string").write.parquet(f"{d}/nation.parquet")
    return d, rows


def test_laps_and_stints_come_from_one_sort(spark, tables):
    d, rows = tables
    laps = laps_from_lineitem(spark, d)
    assert laps._jdf.queryExecution().optimizedPlan().toString().count("Window [") == 1
    want = []
    by = {}
    for r in rows:
        race = (r[10] and r[10].year, "H1" if r[10] and r[10].month <= 6 else "H2", None if r[2] is None else f"S{r[2]}")
        by.setdefault(race, []).append(r)
    for race, its in by.items():
        pits = 0
        for n, r in enumerate(sorted(its, key=lambda r: (r[10] or dt.datetime.min, r[0])), 1):
            want.append((*race, n, pits + 1))
            pits += r[6] == 0.0 and r[7] < 0.02 and r[5] is not None
    got = [(r.season, r.race_name, r.driver, r.lap_number, r.stint) for r in laps.collect()]
    order = lambda x: tuple((v is None, v) if v is None else (False, str(v)) for v in x)
    assert sorted(got, key=lambda x: str(order(x))) == sorted(want, key=lambda x: str(order(x)))


def test_cleaned_order_lines_are_written_once(spark, tables, monkeypatch):
    from lapstats.plans import queries as Q
    written = []
    whole = Q.materialize
    monkeypatch.setattr(Q, "materialize", lambda df, name="stage": (written.append(name), whole(df, name))[1])
    assert Q.clean_lineitem(spark, tables[0]).count() == 201  # one has no price
    assert written == ["laps"]


def test_medians_copy_no_row_per_column(spark):
    rows = [("a", float(i), float(i % 7) if i % 3 else None) for i in range(2001)] + [("b", 1.0, None), (None, 4.0, 4.0)]
    df = spark.createDataFrame(rows, "k string, x double, y double")
    med = medians_by_key(df, ["k"], {"mx": "x", "my": "y"}, accuracy=100)
    assert " AS _col" not in med._jdf.queryExecution().analyzed().toString()
    got = {r.k: (r.mx, r.my) for r in med.collect()}
    ys = [y for k, _, y in rows if k == "a" and y is not None]
    assert got == {"a": (1000.0, float(np.median(ys))), "b": (1.0, None), None: (None, None)}


def test_pit_frames_are_not_joined_back(spark):
    rows = [("r", "x", n, 90.0 + n, False, n == 4) for n in range(1, 8)] + [("r", None, 3, 91.0, False, True)]
    laps = spark.createDataFrame(rows, "race string, driver string, lap_number int, lap_time double, is_outlier boolean, "
                                 "is_pit_lap boolean")
    out = FE.pit_windows(laps, ["race"])
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.driver, r.before_avg, r.after_avg) for r in out.collect()} == {("x", 92.0, 96.0), (None, None, None)}


def test_the_matrix_has_the_slopes_of_the_compounds(spark, tables):
    from lapstats.operators.clean import clean_laps
    from lapstats.session import materialize
    m = {(r.season, r.race_name, r.driver): r for r in FE.driver_matrix(clean_laps(materialize(laps_from_lineitem(spark, tables[0]), "laps"))).collect()}
    slopes = {(r.season, r.race_name, r.driver): r.tire_degradation_rate for r in FE.degradation_rates(
        clean_laps(materialize(laps_from_lineitem(spark, tables[0]), "laps"))).where("compound = 'SOFT'").collect()}
    known = {k: v for k, v in slopes.items() if v is not None and None not in k}
    assert known and all(m[k].tire_degradation_rate == v for k, v in known.items())
