"""Part tables after a stop at every step: nothing is lost, nothing is read twice, a new run ends right."""

import os

import pytest
from pyspark.sql import functions as F

from hopweave.operators import daily as D
from hopweave.operators import parts
from hopweave.operators import windows as W

SCHEMA = "node_id long, week string"


class Stop(Exception):
    pass


@pytest.fixture()
def stop_at(monkeypatch):
    """Let the n-th rename or delete of the part tables fail."""
    def arm(n, names=("rename_path", "delete_path", "commit")):
        left = [n]
        for name in names:
            real = getattr(parts, name)

            def fake(*a, _real=real):
                left[0] -= 1
                if left[0] == 0:
                    raise Stop
                return _real(*a)
            monkeypatch.setattr(parts, name, fake)
        return left
    yield arm
    monkeypatch.undo()


def weeks(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_windows_resume_after_a_stop_at_any_step(spark, tmpdir_fresh, stop_at, monkeypatch):
    whole = [(k, f"2024-W{w:02}") for w in range(1, 4) for k in range(5)] + [(9, None)]
    for n in range(1, 40):
        path = os.path.join(tmpdir_fresh, f"t{n}")
        W.write_parts(weeks(spark, [r for r in whole if r[1] == "2024-W01"]), path, "week")
        left = stop_at(n)
        try:
            W.write_parts(weeks(spark, whole), path, "week")
        except Stop:
            pass
        monkeypatch.undo()
        seen = sorted(parts.read_parts(spark, path, "week", weeks(spark, whole).schema).collect(), key=repr)
        assert {r.week for r in seen} >= {"2024-W01"} and len(seen) == len(set(seen))
        for w in {r.week for r in seen}:                                   # a window is read whole or not at all
            assert sum(r.week == w for r in seen) == sum(r[1] == w for r in whole)
        got = W.write_parts(weeks(spark, whole), path, "week")
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(whole, key=repr)
        if left[0] > 0:
            break
    assert n > 3


def test_a_folder_without_its_files_is_written_anew(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "t")
    rows = [(k, f"w{k % 2}") for k in range(10)]
    W.write_parts(weeks(spark, rows), path, "week")
    assert parts.part_rows(spark, path, "week") == {"week=w0": 5, "week=w1": 5}
    folder = os.path.join(path, "week=w0")
    for f in os.listdir(folder):
        if f.endswith(".parquet"):
            os.remove(os.path.join(folder, f))
    assert {r.week for r in parts.read_parts(spark, path, "week", weeks(spark, rows).schema).collect()} == {"w1"}
    assert sorted(map(tuple, W.write_parts(weeks(spark, rows), path, "week").collect())) == sorted(rows)


def test_shards_survive_a_stop_at_any_step_of_a_reload(spark, tmpdir_fresh, stop_at, monkeypatch):
    df = spark.createDataFrame([(f"0x{k}", k) for k in range(30)], "address string, v long")
    new = df.withColumn("v", F.lit(-1).cast("long"))
    value = lambda path: {r.address: r.v for r in D.stored_shards(spark, path, df.schema).collect()}
    old = {f"0x{k}": k for k in range(30)}
    for n in range(1, 40):
        path = os.path.join(tmpdir_fresh, f"s{n}")
        D.reload_shards(df, path, 4, 0, 3)
        left = stop_at(n)
        try:
            D.reload_shards(new, path, 4, 0, 1)
        except Stop:
            pass
        monkeypatch.undo()
        got = value(path)
        assert got.keys() == old.keys() and all(v in (-1, old[a]) for a, v in got.items())     # no shard is lost
        D.reload_shards(new, path, 4, 0, 1)
        low = {r.address for r in df.where(D.hash_shard("address", 4) <= 1).collect()}
        assert value(path) == {a: (-1 if a in low else v) for a, v in old.items()}
        if left[0] > 0:
            break
    assert n > 3


def test_a_shard_without_rows_is_dropped(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "s")
    df = spark.createDataFrame([(f"0x{k}", k) for k in range(30)], "address string, v long")
    D.reload_shards(df, path, 4, 0, 3)
    D.reload_shards(df.where("false"), path, 4, 2, 2)
    kept = {r.shard for r in D.stored_shards(spark, path, df.schema).collect()}
    assert 2 not in kept and kept
