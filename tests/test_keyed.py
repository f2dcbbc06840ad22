"""A keyed target that is merged file by file, beside the plain rule."""

import datetime as dt
import random
from collections import Counter

import pytest

from conftest import rows
from haulage.operators.apply import incremental
from haulage.sinks import keyed
from haulage.sinks.keyed import KeyedTarget
from haulage.streaming import flows as FL

SCHEMA = "a int, b string, v string, ctl_action string, ctl_validfrom timestamp_ntz"


def frame(spark, data):
    return spark.createDataFrame([(a, b, v, act, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=m)) for a, b, v, act, m in data], SCHEMA)


def test_merges_match_the_plain_rule(spark, tmp_path):
    """Random batches with repeated, missing and NULL keys: after every merge the same rows as a full join, and old versions stay."""
    rnd = random.Random(3)
    key = lambda: (rnd.choice([None, *range(60)]), rnd.choice(["x", "y z", "ü+", None]))
    start = {k: (*k, f"s{i}", "I", 0) for i, k in enumerate({key() for _ in range(150)})}
    target = KeyedTarget(spark, f"file://{tmp_path}/t", ["a", "b"])
    assert target.version() is None
    with pytest.raises(ValueError):
        target.read()
    plain = frame(spark, list(start.values()))
    target.create(plain, rows_per_file=7)
    with pytest.raises(ValueError):
        target.create(plain)
    assert target.files().count() > 15 and max(r.n_rows for r in target.files().collect()) <= 7
    versions = [rows(plain)]
    for turn in range(3):
        batch = frame(spark, [(*key(), f"b{turn}-{i}", rnd.choice("IUD"), rnd.randrange(50)) for i in range(rnd.choice([1, 40, 90]))])
        plain = spark.createDataFrame(incremental(plain, batch, ["a", "b"]).collect(), SCHEMA)
        done = target.merge(batch)
        assert done.version == turn + 1 and rows(target.read()) == rows(plain)
        versions.append(rows(plain))
    assert rows(target.read(1)) == versions[1] and target.merge(batch, 2).rows_written == 0
    removed = target.vacuum(keep=1)
    assert removed > 0 and rows(target.read()) == versions[-1] and target.vacuum() == 0
    again = KeyedTarget(spark, f"file://{tmp_path}/t", ["a", "b"])
    every = frame(spark, [(r[0], r[1], None, "D", 99) for r in versions[-1]])
    again.merge(every)
    assert again.read().collect() == [] and again.files().count() == 0
    again.merge(frame(spark, [(1, "x", "new", "I", 0), (2, "x", "none", "D", 0)]))
    assert [(r.a, r.v) for r in again.read().collect()] == [(1, "new")]


def test_only_files_with_the_keys_are_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "SMALL_FILES", 3)
    target = KeyedTarget(spark, f"{tmp_path}/t", ["a", "b"])
    target.create(frame(spark, [(2 * i, "k", "s", "I", 0) for i in range(1600)]), rows_per_file=20)
    near = target.merge(frame(spark, [(2 * i, "k", "n", "U", 0) for i in range(800, 816)]))
    assert 0 < near.files_read <= near.files_before / 8 and near.rows_read <= 400
    absent = target.merge(frame(spark, [(2 * i + 1, "k", "n", "I", 0) for i in range(0, 1600, 50)]))
    assert absent.files_read <= 3, "keys between those of a file are told by its filter"
    assert target.read().count() == 1632
    for turn in range(4):  # every merge adds a small file to every bucket; too many of them are put together
        done = target.merge(frame(spark, [(10_000 + 40 * turn + i, "k", "n", "I", 0) for i in range(40)]))
    small = Counter(r.bucket for r in target.files().where("n_rows < 10").collect())
    assert done.version == 6 and target.read().count() == 1792 and max(small.values()) <= 3
    assert any(r.n_rows > 10 for r in target.files().where("first.a >= 10000").collect())


def test_stream_of_batches(spark, tmp_path):
    target = KeyedTarget(spark, f"{tmp_path}/t", ["a"])
    target.create(frame(spark, [(i, "k", "s", "I", 0) for i in range(40)]), rows_per_file=10)
    body = FL.merge_in_batches(target)
    for turn, data in enumerate(([(1, "k", "u", "U", 1), (2, "k", "d", "D", 1)], [(1, "k", "w", "U", 2), (50, "k", "n", "I", 2)])):
        body(frame(spark, data), turn)
    body(frame(spark, [(3, "k", "again", "U", 9)]), 1)  # replayed after a failure
    got = {r.a: r.v for r in target.read().collect()}
    assert got[1] == "w" and 2 not in got and got[50] == "n" and got[3] == "s" and len(got) == 40
