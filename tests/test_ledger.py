"""Commits of appended tables: two writers at once, crashes, repeated batches, schema changes, compaction."""

import threading

import pytest
from rosterlake.sources import ledger
from rosterlake.sources.ledger import Ledger


def ids(spark, *values):
    return spark.createDataFrame([(v, "x") for v in values], "id string, note string")


def read(book, name="a"):
    return sorted(r.id for r in book.read(name).collect())


def test_a_faster_writer_wins_an_id(spark, tmp_path, monkeypatch):
    slow, fast = Ledger(spark, str(tmp_path)), Ledger(spark, str(tmp_path))
    slow.commit({"a": ids(spark, "0")}, unique="id")
    publish = Ledger._publish

    def late(self, number, manifest):  # the other writer commits between this one's rows and its manifest
        monkeypatch.setattr(Ledger, "_publish", publish)
        fast.commit({"a": ids(spark, "1", "2"), "b": ids(spark, "9")}, unique="id")
        return publish(self, number, manifest)

    monkeypatch.setattr(Ledger, "_publish", late)
    assert slow.commit({"a": ids(spark, "0", "2", "3", "3"), "b": ids(spark, "8")}, unique="id") == 2
    assert (read(slow), read(slow, "b")) == (["0", "1", "2", "3"], ["8", "9"])


@pytest.mark.parametrize("again", range(3))
def test_writers_in_threads(spark, tmp_path, again):
    Ledger(spark, str(tmp_path)).commit({"a": ids(spark, "k")}, unique="id")
    work = [threading.Thread(target=lambda i=i: Ledger(spark, str(tmp_path)).commit({"a": ids(spark, "k", f"w{i}", "both")}, unique="id")) for i in range(4)]
    [t.start() for t in work], [t.join() for t in work]
    assert read(Ledger(spark, str(tmp_path))) == ["both", "k", "w0", "w1", "w2", "w3"]


def test_a_crash_before_the_manifest_changes_nothing(spark, tmp_path, monkeypatch):
    book = Ledger(spark, str(tmp_path))
    book.commit({"a": ids(spark, "1"), "b": ids(spark, "1")})
    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        def crash(self, number, manifest):
            raise RuntimeError
        patch.setattr(Ledger, "_publish", crash)
        book.commit({"a": ids(spark, "2"), "b": ids(spark, "2")})
    assert (read(book), read(book, "b"), book.version()) == (["1"], ["1"], 0)
    assert book.vacuum() == 2 and read(book) == ["1"]


def test_repeated_batches_and_empty_appends(spark, tmp_path):
    book = Ledger(spark, str(tmp_path))
    assert book.read("a") is None and book.version() == -1
    for number in (0, 1, 1, 0):
        book.commit({"a": ids(spark, str(number))}, batch=("stream", number))
    book.commit({"a": ids(spark, "5")}, batch=("other", 0))
    book.commit({"a": ids(spark), "c": ids(spark)})
    assert read(book) == ["0", "1", "5"] and read(book, "c") == [] and len(book.manifest()["tables"]["a"]["folders"]) == 3


def test_schema_grows_and_types_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    ledger.append_parquet(spark.createDataFrame([(1, 1.5)], "id bigint, amount double"), path)
    ledger.append_parquet(spark.createDataFrame([(2, 7, "new")], "id int, amount int, note string"), path)
    ledger.append_parquet(spark.createDataFrame([(3,)], "id int"), path)
    rows = ledger.read_appended(spark, path)
    assert dict(rows.dtypes) == {"id": "bigint", "amount": "double", "note": "string"}
    assert sorted(map(tuple, rows.collect())) == [(1, 1.5, None), (2, 7.0, "new"), (3, None, None)]


def test_folders_and_files_stay_few(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "MAX_FOLDERS", 3)
    book = Ledger(spark, str(tmp_path))
    for i in range(9):
        book.commit({"a": ids(spark, str(i)).repartition(4)})
        assert len(book.manifest()["tables"]["a"]["folders"]) <= 3
    assert read(book) == [str(i) for i in range(9)]
    book.vacuum(keep=1)
    assert read(book) == [str(i) for i in range(9)] and len(list((tmp_path / "data").iterdir())) <= 3
