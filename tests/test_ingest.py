"""Raw files as they come: text pit times, integers with a fraction, columns in another order."""

import pytest

from lapstats.operators.clean import clean_laps
from lapstats.plans.pipeline import run_pipeline
from lapstats.sources import store
from lapstats.sources.files import read_raw_laps_csv
from lapstats.sources.store import read_ledger
from lapstats.streaming.incremental import start_incremental

HEADER = "Driver,Team,LapNumber,LapTime,Compound,TyreLife,Stint,TrackStatus,PitInTime,PitOutTime"


def _line(lap, pit=""):
    return f"A,T,{lap}.0,0 days 00:01:3{lap % 10}.500000,SOFT,{lap}.0,1.0,1,{pit},"


def test_text_pit_times_and_fractional_integers(spark, tmp_path):
    lines = [HEADER, *(_line(i) for i in range(1, 6)), _line(6, "0 days 00:10:00.000000")]
    (tmp_path / "monaco_laps_raw.csv").write_text("\n".join(lines) + "\n")
    laps = read_raw_laps_csv(spark, str(tmp_path / "*.csv"), season=2024)
    rows = clean_laps(laps, ["season", "race_name"]).orderBy("lap_number").collect()
    assert [r.lap_number for r in rows] == [1, 2, 3, 4, 5, 6] and [r.is_pit_lap for r in rows] == [False] * 5 + [True]


def test_files_of_two_headers_in_one_folder(spark, tmp_path):
    other = HEADER.split(",")
    other[0], other[2] = other[2], other[0]
    (tmp_path / "a_laps_raw.csv").write_text(HEADER + "\n" + _line(1) + "\n" + _line(2) + "\n")
    (tmp_path / "b_laps_raw.csv").write_text("\ufeff" + ",".join(other) + ",RaceName\r\n" + "1.0,T,B,95.0,SOFT,1,1,1,,,Monaco\r\n")
    (tmp_path / "c_laps_raw.csv").write_text("")
    rows = read_raw_laps_csv(spark, str(tmp_path / "*.csv"), season=2024).collect()
    assert {(r.race_name, r.driver, r.lap_number, r.lap_time) for r in rows} == {
        ("A", "A", 1, 91.5), ("A", "A", 2, 92.5), ("Monaco", "B", 1, 95.0)}
    assert {r.source_file.rsplit("/", 1)[1] for r in rows} == {"a_laps_raw.csv", "b_laps_raw.csv"}


def test_a_rare_text_value_does_not_change_a_columns_type(spark, tmp_path):
    lines = [HEADER, *(f"A,T,{i},9{i % 10}.5,SOFT,{i},1,1,," for i in range(1, 200)), _line(200)]
    (tmp_path / "m_laps_raw.csv").write_text("\n".join(lines) + "\n")
    rows = read_raw_laps_csv(spark, str(tmp_path / "*.csv"), season=2024).collect()
    assert len(rows) == 200 and all(r.lap_time is not None for r in rows)


def _race(race, driver, laps, header=HEADER):
    extra = ",RaceName" if race else ""
    return "\n".join([header + extra, *(f"{driver},T,{i},0 days 00:01:3{i % 10}.5,SOFT,{i},1,1,," + (f",{race}" if race else "")
                                        for i in range(1, laps + 1))]) + "\n"


def test_a_late_file_joins_its_race_in_batch_and_stream(spark, tmp_path):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    counts = lambda: {r["driver"]: r["count"] for r in store.read_table(
        spark, f"{out}/laps_clean", f"{out}/processed_races").groupBy("driver").count().collect()}
    go = lambda: start_incremental(spark, str(raw), out, str(tmp_path / "ck"), season=2024,
                                   files_per_batch=1).awaitTermination(600)
    (raw / "one_laps_raw.csv").write_text(_race("Monaco", "A", 12))
    go()
    assert counts() == {"A": 12}
    (raw / "two_laps_raw.csv").write_text(_race("Monaco", "B", 12))
    go()
    assert counts() == {"A": 12, "B": 12}
    ledger = store.read_ledger(spark, f"{out}/processed_races").collect()
    assert [(r.race_name, len(r.files)) for r in ledger] == [("Monaco", 2)]
    # Nothing is left of the version before, and the same files give no new run.
    assert spark.read.parquet(f"{out}/laps_clean").select("run").distinct().count() == 1
    assert run_pipeline(spark, read_raw_laps_csv(spark, f"{raw}/*.csv", season=2024), out, with_models=False) == {}


def test_a_run_that_dies_leaves_the_tables_as_they_were(spark, tmp_path, monkeypatch):
    raw, out = tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    (raw / "monaco_laps_raw.csv").write_text(_race(None, "A", 12))
    read = lambda: read_raw_laps_csv(spark, f"{raw}/*.csv", season=2024)
    shown = lambda name: store.read_table(spark, f"{out}/{name}", f"{out}/processed_races")
    write, broken = store.write_version, []

    def dies(df, path, *rest):
        if broken and path.endswith("race_overview"):
            raise OSError("lost")
        write(df, path, *rest)

    monkeypatch.setattr(store, "write_version", dies)
    run_pipeline(spark, read(), out, with_models=False)
    assert shown("laps_clean").count() == 12
    (raw / "monaco_laps_raw.csv").write_text(_race(None, "A", 20))
    broken.append(True)
    with pytest.raises(OSError, match="lost"):
        run_pipeline(spark, read(), out, with_models=False, incremental=False)
    assert shown("laps_clean").count() == 12 and shown("driver_profiles").count() == 1
    assert spark.read.parquet(f"{out}/laps_clean").count() == 32  # the rows of the dead run are there, but not current


def test_ledger_missing_is_empty(spark, tmp_path):
    assert read_ledger(spark, str(tmp_path / "none")).count() == 0
