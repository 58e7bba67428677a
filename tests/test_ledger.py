"""Incremental ingest with a ledger: rewritten, damaged and repeated files."""

import gzip
import os

import pytest

from firmbook.streaming import ledger as lg

COLUMNS = ["a", "b"]


@pytest.fixture
def place(spark, tmp_path):
    (tmp_path / "landing").mkdir()

    class Place:
        clock = 1_700_000_000

        def land(self, name, rows, damage=False):
            content = "".join(f'"{name}";"{r}"\n' for r in rows).encode()
            if name.endswith(".gz"):
                content = gzip.compress(content)
                content = content[: len(content) // 2] if damage else content
            path = tmp_path / "landing" / name
            path.write_bytes(content)
            Place.clock += 10
            os.utime(path, (Place.clock, Place.clock))
            return str(path)

        def run(self, **options):
            return lg.ledger_ingest(spark, str(tmp_path / "landing"), COLUMNS, str(tmp_path / "t"), str(tmp_path / "check"), **options)

        def rows(self):
            return sorted((r["a"], r["b"]) for r in lg.read_ingested(spark, str(tmp_path / "t"), COLUMNS).collect())

        target = str(tmp_path / "t")

    return Place()


def test_new_unchanged_and_rewritten_files(spark, place):
    place.land("one.csv", range(3))
    place.land("a name.csv", range(2))
    place.run()
    first = [("a name.csv", "0"), ("a name.csv", "1"), ("one.csv", "0"), ("one.csv", "1"), ("one.csv", "2")]
    assert place.rows() == first
    place.run()
    assert place.rows() == first
    place.land("one.csv", ["new"])
    place.land("three.csv", ["x"])
    place.run()
    assert place.rows() == [*first[:2], ("one.csv", "new"), ("three.csv", "x")]
    place.land("one.csv", ["new"])  # written again as it was: no new batch
    before = {r["arquivo"]: r["lote"] for r in lg.ledger(spark, place.target).collect()}
    place.run()
    assert {r["arquivo"]: r["lote"] for r in lg.ledger(spark, place.target).collect()} == before
    assert place.rows() == [*first[:2], ("one.csv", "new"), ("three.csv", "x")]
    counted = {r["arquivo"].rsplit("/", 1)[1]: r["linhas"] for r in lg.ledger(spark, place.target).collect()}
    assert counted == {"a name.csv": 2, "one.csv": 1, "three.csv": 1}


def test_a_damaged_file_keeps_its_last_whole_content(spark, place):
    place.land("x.csv.gz", range(5000))
    place.land("y.csv.gz", range(5000), damage=True)
    with pytest.raises(Exception, match="damaged"):
        place.run()
    assert place.rows() == []
    place.run(skip_failed_files=True)
    assert len(place.rows()) == 5000 and {a for a, _ in place.rows()} == {"x.csv.gz"}
    place.land("x.csv.gz", range(9000), damage=True)
    place.run(skip_failed_files=True)
    assert len(place.rows()) == 5000
    errors = {r["arquivo"].rsplit("/", 1)[1]: r["erro"] for r in lg.ledger(spark, place.target).collect()}
    assert errors["x.csv.gz"] and errors["y.csv.gz"]
    place.land("x.csv.gz", ["whole"])
    place.land("y.csv.gz", ["again"])
    place.run(skip_failed_files=True)
    assert place.rows() == [("x.csv.gz", "whole"), ("y.csv.gz", "again")]
    assert not [r for r in lg.ledger(spark, place.target).collect() if r["erro"]]


def test_a_batch_run_twice_counts_once(spark, place, monkeypatch):
    """The run ends after the rows are written and before the ledger is, then goes on."""
    place.land("one.csv", range(4))
    publish = lg.replace_part

    def lost(*args, **kwargs):
        raise RuntimeError("the driver is gone")

    monkeypatch.setattr(lg, "replace_part", lost)
    with pytest.raises(Exception):
        place.run()
    monkeypatch.setattr(lg, "replace_part", publish)
    assert place.rows() == []
    place.run()
    place.run()
    assert [b for _, b in place.rows()] == ["0", "1", "2", "3"]


def test_many_small_batches_and_superseded_folders(spark, place):
    for n in range(5):
        place.land(f"{n}.csv", [n])
    place.run(max_files_per_batch=2)
    assert place.rows() == [(f"{n}.csv", str(n)) for n in range(5)]
    for n in range(5):
        place.land(f"{n}.csv", [n, "more"])
    place.run()
    gone = lg.remove_superseded(spark, place.target)
    assert len(gone) == 3 and len(place.rows()) == 10


def test_parts_of_a_gzip_file_and_padding_are_whole(tmp_path):
    import pandas as pd

    path = tmp_path / "x.gz"
    path.write_bytes(gzip.compress(b"one") + gzip.compress(b"two") + b"\0" * 10)
    bad = tmp_path / "y.gz"
    bad.write_bytes(b"no gzip at all")
    empty = tmp_path / "z.gz"
    empty.write_bytes(b"")
    files = pd.DataFrame({"path": [f"file:{p}" for p in (path, bad, empty)]})
    errors = list(next(lg._probe(iter([files])))["error"])
    assert errors[0] is None and errors[1] and errors[2]
