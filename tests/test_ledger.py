import json
import os

import pytest

from stationflow.plans import ledger
from stationflow.plans.maintenance import Rejected
from stationflow.sources import dated

from test_flatten import _doc, _rec


@pytest.fixture
def feed(tmp_path):
    src = tmp_path / "raw"
    os.makedirs(src)

    def write(*names, doc=None):
        for n in names:
            with open(src / f"data___{n:03d}.json", "w") as f:
                f.write(doc or json.dumps(_doc([_rec(str(n), t=f"2023-09-{1 + n % 28:02d}T08:00:00Z")])))
    return str(src), write


def places(tmp_path):
    return str(tmp_path / "fact"), str(tmp_path / "ledger")


def stations(spark, path):
    return sorted(r.station_id for r in dated.read(spark, path).collect())


def test_a_folder_is_loaded_once(spark, tmp_path, feed):
    (src, write), (fact, book) = feed, places(tmp_path)
    write(*range(7))
    assert ledger.load_new(spark, src, fact, book, max_files=3) == [0, 1, 2]
    assert ledger.load_new(spark, src, fact, book) == []
    write(8, 9)
    assert ledger.load_new(spark, src, fact, book, max_bytes=1) == [3, 4]
    assert stations(spark, fact) == [*range(7), 8, 9]
    rows = ledger.loaded_files(spark, book).collect()
    assert len(rows) == 9 and all((r.documents, r.loaded_rows, r.corrupt) == (1, 1, 0) for r in rows)
    assert sorted(r.batch for r in rows) == [0, 0, 0, 1, 1, 1, 2, 3, 4]


def test_changed_files_are_reported_and_not_loaded_again(spark, tmp_path, feed):
    (src, write), (fact, book) = feed, places(tmp_path)
    write(1, 2)
    ledger.load_new(spark, src, fact, book)
    assert ledger.changed_files(spark, src, book).count() == 0
    write(2, doc=json.dumps(_doc([_rec("22", t="2023-09-03T08:00:00Z"), _rec("23", t="2023-09-03T08:00:00Z")])))
    changed = ledger.changed_files(spark, src, book).collect()
    assert [os.path.basename(r.path) for r in changed] == ["data___002.json"]
    assert changed[0].length > changed[0].loaded_length
    assert ledger.load_new(spark, src, fact, book) == [] and stations(spark, fact) == [1, 2]


@pytest.mark.parametrize("fail", ["_write", "_rename", "after"])
def test_a_failed_load_is_finished_by_the_next(spark, tmp_path, feed, monkeypatch, fail):
    (src, write), (fact, book) = feed, places(tmp_path)
    write(*range(6))
    calls = []
    of, name = (ledger, "report_columns") if fail == "after" else (dated, fail)
    real = getattr(of, name)

    def failing(*args):
        calls.append(1)
        if len(calls) == (4 if fail == "_rename" else 2):
            raise OSError("lost")
        return real(*args)

    monkeypatch.setattr(of, name, failing)
    with pytest.raises(OSError):
        ledger.load_new(spark, src, fact, book, max_files=2)
    write(6)
    assert ledger.load_new(spark, src, fact, book, max_files=2) == [1, 2, 3]
    assert stations(spark, fact) == list(range(7))
    assert ledger.loaded_files(spark, book).count() == 7


def test_rejects_fail_the_batch_or_are_kept(spark, tmp_path, feed):
    (src, write), (fact, book) = feed, places(tmp_path)
    write(1)
    write(2, doc='{"nhits": 1, "rec')
    with pytest.raises(Rejected):
        ledger.load_new(spark, src, fact, book)
    assert ledger.load_new(spark, src, fact, book, quarantine_path=str(tmp_path / "bad")) == [0]
    assert stations(spark, fact) == [1] and spark.read.json(str(tmp_path / "bad")).count() == 1
    assert sorted((r.documents, r.corrupt) for r in ledger.loaded_files(spark, book).collect()) == [(1, 0), (1, 1)]


def test_two_ledgers_load_into_one_table(spark, tmp_path, feed):
    (src, write), (fact, book) = feed, places(tmp_path)
    write(1, 2)
    ledger.load_new(spark, src, fact, book)
    ledger.load_new(spark, src, fact, str(tmp_path / "other"))
    assert stations(spark, fact) == [1, 1, 2, 2]


def test_nothing_to_load(spark, tmp_path, feed):
    (src, _), (fact, book) = feed, places(tmp_path)
    assert ledger.load_new(spark, src, fact, book) == [] and ledger.loaded_files(spark, book).count() == 0
