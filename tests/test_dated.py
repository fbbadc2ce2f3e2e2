import json
import os

import pytest
from pyspark.sql import functions as F

from stationflow.operators.repair import touched_dates
from stationflow.plans import maintenance
from stationflow.plans.maintenance import Rejected, load_window, repair_stored
from stationflow.sources import dated, sinks

from conftest import records_df
from test_flatten import _doc, _rec

S = "EN SERVICE"
DAYS = ("2023-09-27 00:00:00 UTC", "2023-09-28 23:00:00 UTC")


def fact(spark, path, rows):
    dated.append(sinks.with_record_date(records_df(spark, rows)), path)


def stations(spark, path):
    return sorted(r.station_id for r in sinks.read_records(spark, path).collect())


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "fact")
    fact(spark, path, [(1, S, 1, 0, "2023-09-27 08:00:00"), (2, S, 2, 0, "2023-09-28 08:00:00"),
                       (3, S, 3, 0, "2023-09-29 08:00:00"), (4, S, 4, 0, None)])
    return path


def changed(rows, add):
    days = touched_dates(*DAYS)
    return rows.where(F.col("record_date").isin(days)).withColumn("station_id", F.col("station_id") + add)


def test_all_dates_change_at_one_instant(spark, table, monkeypatch):
    before = dated.read(spark, table)
    seen, commit = [], dated._commit

    def spying(spark, path, number, dates):
        seen.append(stations(spark, path))  # everything is written, nothing is switched
        done = commit(spark, path, number, dates)
        seen.append(stations(spark, path))
        return done

    monkeypatch.setattr(dated, "_commit", spying)
    assert dated.replace(spark, table, touched_dates(*DAYS), lambda rows: changed(rows, 10)) == 1
    assert seen == [[1, 2, 3, 4], [3, 4, 11, 12]]
    assert sorted(r.station_id for r in before.collect()) == [1, 2, 3, 4]  # a reader that had begun
    assert dated.version(spark, table) == 1 and dated.clean(spark, table) == 2
    assert stations(spark, table) == [3, 4, 11, 12]


def test_rows_appended_while_a_replacement_reads_are_in_it(spark, table):
    calls = []

    def build(rows):
        if not calls:
            fact(spark, table, [(7, S, 7, 0, "2023-09-27 09:00:00")])
        calls.append(1)
        return changed(rows, 10)

    dated.replace(spark, table, touched_dates(*DAYS), build)
    assert len(calls) == 2 and stations(spark, table) == [3, 4, 11, 12, 17]


def test_rows_appended_just_before_the_switch_are_kept(spark, table, monkeypatch):
    commit, late = dated._commit, []

    def slow(spark, path, number, dates):
        if not late:
            late.append(1)
            fact(spark, table, [(8, S, 8, 0, "2023-09-28 09:00:00")])
        return commit(spark, path, number, dates)

    monkeypatch.setattr(dated, "_commit", slow)
    dated.replace(spark, table, touched_dates(*DAYS), lambda rows: changed(rows, 10))
    assert stations(spark, table) == [3, 4, 8, 11, 12]


def test_files_moved_into_a_replaced_generation_move_on(spark, table, monkeypatch):
    rename, switched = dated._rename, []

    def late(spark, source, folder, name):
        if not switched:  # the append has read the list of generations, then a replacement ends
            switched.append(1)
            dated.replace(spark, table, touched_dates(*DAYS), lambda rows: changed(rows, 10))
        rename(spark, source, folder, name)

    monkeypatch.setattr(dated, "_rename", late)
    fact(spark, table, [(9, S, 9, 0, "2023-09-27 10:00:00")])
    assert stations(spark, table) == [3, 4, 9, 11, 12]


def test_two_replacements_at_once(spark, table):
    other = []

    def build(rows):
        if not other:
            other.append(1)
            dated.replace(spark, table, touched_dates(*DAYS), lambda r: changed(r, 100))
        return changed(rows, 10)

    dated.replace(spark, table, touched_dates(*DAYS), build)
    assert stations(spark, table) == [3, 4, 111, 112] and dated.version(spark, table) == 2

    def restless(rows):
        fact(spark, table, [(5, S, 5, 0, "2023-09-27 10:00:00")])
        return changed(rows, 0)

    with pytest.raises(dated.Conflict):
        dated.replace(spark, table, touched_dates(*DAYS), restless)


def test_a_failed_replacement_leaves_the_table(spark, table):
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        dated.replace(spark, table, touched_dates(*DAYS), lambda rows: changed(rows, 0).withColumn(
            "station_id", (F.col("station_id") / 0).cast("bigint")))
    assert stations(spark, table) == [1, 2, 3, 4] and dated.version(spark, table) == 0


def test_a_list_that_is_not_written_to_its_end_does_not_count(spark, table):
    dated.replace(spark, table, touched_dates(*DAYS), lambda rows: changed(rows, 10))
    with open(os.path.join(table, "_dates", "2.json"), "w") as f:
        f.write('{"2023-')
    assert stations(spark, table) == [3, 4, 11, 12]


def test_emptied_dates_and_empty_tables(spark, table, tmp_path):
    dated.replace(spark, table, touched_dates(*DAYS), lambda rows: rows.where("false"))
    assert stations(spark, table) == [3, 4]
    assert dated.read(spark, str(tmp_path / "none")).count() == 0
    assert not dated.exists(spark, str(tmp_path / "none"))


def test_an_append_that_failed_midway_goes_on(spark, tmp_path, monkeypatch):
    path, staged = str(tmp_path / "fact"), str(tmp_path / "staged")
    rows = sinks.with_record_date(records_df(spark, [(i, S, 1, 0, f"2023-09-{i:02d} 08:00:00") for i in range(1, 6)]))
    rename, moved = dated._rename, []

    def failing(*args):
        if len(moved) == 2:
            moved.append("lost")
            raise OSError("lost")
        moved.append(1)
        rename(*args)

    monkeypatch.setattr(dated, "_rename", failing)
    with pytest.raises(OSError):
        dated.append(rows, path, "load-1", staged)
    for _ in range(2):
        dated.append(rows, path, "load-1", staged)
        assert stations(spark, path) == [1, 2, 3, 4, 5]


def raw(path, docs):
    os.makedirs(path, exist_ok=True)
    for i, doc in enumerate(docs):
        with open(os.path.join(path, f"data___{i}.json"), "w") as f:
            f.write(doc if isinstance(doc, str) else json.dumps(doc))


def test_a_replacing_load_can_be_repeated(spark, tmp_path):
    src, path = str(tmp_path / "raw"), str(tmp_path / "fact")
    raw(src, [_doc([_rec("1", t="2023-09-27T08:00:00Z"), _rec("2", t=None), _rec("2", t=None)])])
    for _ in range(3):
        load_window(spark, src, path, *DAYS, replace=True)
        assert stations(spark, path) == [1, 2, 2]


def test_a_load_without_quarantine_drops_nothing_unseen(spark, tmp_path):
    src, path = str(tmp_path / "raw"), str(tmp_path / "fact")
    raw(src, [_doc([_rec("1", t="2023-09-27T08:00:00Z")]), '{"nhits": 1, "rec'])
    with pytest.raises(Rejected):
        load_window(spark, src, path, *DAYS)
    assert not dated.exists(spark, path)
    load_window(spark, src, path, *DAYS, quarantine_path=str(tmp_path / "bad"))
    assert stations(spark, path) == [1] and spark.read.json(str(tmp_path / "bad")).count() == 1


def test_repair_keeps_a_row_that_another_writer_appends(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "fact")
    fact(spark, path, [(1, S, 1, 0, "2023-09-20 08:00:00"), (2, S, 2, 0, "2023-09-27 08:00:00")])
    repair, appended = maintenance.repair_window, []

    def slow(*args):
        if not appended:
            appended.append(1)
            sinks.append_records(records_df(spark, [(5, S, 5, 0, "2023-09-27 22:00:00")]), path)
        return repair(*args)

    monkeypatch.setattr(maintenance, "repair_window", slow)
    repair_stored(spark, path, "2023-09-27 07:00:00 UTC", "2023-09-27 09:00:00 UTC")
    assert stations(spark, path) == [1, 1, 5]


def test_a_plain_folder_becomes_a_table(spark, tmp_path):
    path = str(tmp_path / "fact")
    sinks.append_records(records_df(spark, [(1, S, 1, 0, "2023-09-20 08:00:00"), (2, S, 2, 0, "2023-09-27 08:00:00")]), path)
    repair_stored(spark, path, "2023-09-27 07:00:00 UTC", "2023-09-27 09:00:00 UTC")
    assert stations(spark, path) == [1, 1]


def test_dates_are_pruned(spark, table):
    dated.replace(spark, table, touched_dates(*DAYS), lambda rows: changed(rows, 10))
    one = dated.read(spark, table).where("record_date = '2023-09-28'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and [r.station_id for r in one.collect()] == [12]
    assert len(one.inputFiles()) >= 1 and "numPartitions" not in plan
