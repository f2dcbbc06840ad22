"""Range-wise running sums and neighbours against brute force, with a key that holds a third of all rows."""

import datetime as dt
import json
import random

import pytest

from conftest import rows
from haulage.operators import parts as PA, retention as RT, snapshots as SN
from haulage.operators.ranges import cut_points, neighbours, running_sum, with_range
from haulage.sources import files as FI
from haulage.sources.files import package_parts
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(5)
    data = [(1 if i % 3 == 0 else rnd.choice([2, 3, None, *range(10, 200)]), i, rnd.randint(0, 9), rnd.choice(["a", "b", None])) for i in range(3000)]
    rnd.shuffle(data)
    return spark.createDataFrame(data, "k int, t int, v int, s string").repartition(7).cache()


@pytest.mark.parametrize("per_range", [10_000, 400, 37, 11])
def test_running_sum(skewed, per_range):
    order = ["k", "t"]
    data = sorted([tuple(r) for r in skewed.collect()], key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want, total = {}, 0
    for r in data:
        total += r[2]
        want[r[1]] = total
    got = running_sum(skewed, order, F.col("v"), "upto", per_range)
    assert {r.t: r.upto for r in got.collect()} == want
    assert got.columns == [*skewed.columns, "upto"]


def test_cuts_balance(skewed):
    raw = cut_points(skewed, ["k", "t"], 300)
    cuts = [json.loads(c) for c in raw]
    assert 5 <= len(cuts) <= 9 and cuts == sorted(cuts, key=lambda c: ("c0" in c, c.get("c0", 0), c["c1"]))
    assert sum(1 for c in cuts if c.get("c0") == 1) >= 2, "the large key must be cut as well"
    sizes = [r["count"] for r in with_range(skewed, ["k", "t"], raw).groupBy("_range").count().collect()]
    assert len(sizes) == len(cuts) + 1 and max(sizes) < 900


@pytest.mark.parametrize("per_range", [10_000, 400, 37, 11])
def test_neighbours(skewed, per_range):
    got = neighbours(skewed, ["k"], ["t"], {"pt": "t", "ps": "s"}, {"nv": "v"}, per_range)
    by_key = {}
    for r in skewed.collect():
        by_key.setdefault(r.k, []).append(r)
    want = {}
    for group in by_key.values():
        group.sort(key=lambda r: r.t)
        for i, r in enumerate(group):
            before, after = group[i - 1] if i else None, group[i + 1] if i + 1 < len(group) else None
            want[r.t] = (before.t if before else None, before.s if before else None, after.v if after else None)
    assert {r.t: (r.pt, r.ps, r.nv) for r in got.collect()} == want


def test_parts_are_bounded_and_stable(skewed):
    size = F.col("v").cast("bigint") + 1
    plain = PA.with_parts(skewed, ["t"], 100, size)
    ranged = PA.with_parts(skewed.repartition(3), ["t"], 100, size, rows_per_range=50)
    assert rows(plain) == rows(ranged)
    manifest = PA.manifest(plain).orderBy("part_index").collect()
    assert max(r.n_bytes for r in manifest) <= 100
    assert [r.part_index for r in manifest] == list(range(1, len(manifest) + 1)) and {r.part_total for r in manifest} == {len(manifest)}
    assert sum(r.n_rows for r in manifest) == 3000


def test_wide_rows_get_their_own_part(spark):
    df = spark.createDataFrame([(1, 5), (2, 500), (3, 5)], "id int, n bigint")
    parts = PA.with_parts(df, ["id"], 100, F.col("n"))
    assert PA.manifest(parts).count() == 3


def test_key_batches(skewed):
    got = RT.key_batches(skewed, ["t"], 250, rows_per_range=100)
    sizes = {r.batch_id: r["count"] for r in got.groupBy("batch_id").count().collect()}
    assert sizes == {i: 250 for i in range(12)}
    assert all(r.batch_id == r.t // 250 for r in got.collect())


def test_stability_is_the_same_in_ranges(skewed):
    seen = skewed.select(F.col("k").alias("id"), F.col("t").alias("parsed_at"), F.col("v").cast("string").alias("hash"), F.col("s").alias("fileloc"))
    assert rows(SN.stability(seen)) == rows(SN.stability(seen, rows_per_range=60))
    pairs = SN.version_pairs(seen, ["id"], ["parsed_at"], {"prev": "parsed_at"}, rows_per_range=60)
    assert all(r.prev < r.parsed_at for r in pairs.collect())


def test_package_parts(spark):
    texts = ["h", "1", "2", "h", "3", "h", "4", "5", "6"]
    lines = spark.createDataFrame([(f"p{p}", i, t) for p in range(3) for i, t in enumerate(texts)], "path string, line_no int, value string")
    for per_range in (1000, 4):
        got = package_parts(lines, per_range)
        assert rows(got.where("path = 'p1'"), "value", "part") == [("1", 1), ("2", 1), ("3", 2), ("4", 3), ("5", 3), ("6", 3)]


def test_parts_of_one_long_file_are_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(FI, "LINES_PER_BLOCK", 100, raising=False)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        texts = ["h" if i % 700 == 0 else None if i % 50 == 7 else str(i) for i in range(4000)]
        data = [("long", i, t, -i) for i, t in enumerate(texts)] + [("short", 0, "x", 0), ("short", 1, "1", -1), ("short", 2, "x", -2), ("short", 3, "2", -3), ("headless", 5, "x", 0), (None, 0, "h", 0)]
        lines = spark.createDataFrame(data, "path string, line_no int, value string, extra int")
        got = package_parts(lines, 500)
        assert got.columns == ["path", "line_no", "value", "part"]
        want = [("long", i, t, i // 700 + 1) for i, t in enumerate(texts) if t not in ("h", None)] + [("short", 1, "1", 1), ("short", 3, "2", 2)]
        assert rows(got) == sorted(want, key=repr)
        per_task = [r["count"] for r in got.where("path = 'long'").groupBy(F.spark_partition_id()).count().collect()]
        assert len(per_task) >= 4 and max(per_task) < sum(per_task) / 2
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_first_line_twice_counts_twice(spark):
    lines = spark.createDataFrame([("p", 0, "h"), ("p", 0, "h"), ("p", 1, "a"), ("q", 0, None), ("q", 1, "b")], "path string, line_no int, value string")
    assert rows(package_parts(lines), "path", "line_no", "value") == [("p", 1, "a"), ("p", 1, "a")]


def test_cuts_on_times_and_texts(spark):
    base = dt.datetime(2024, 1, 1)
    data = [(base + dt.timedelta(microseconds=37 * i), f'q"{i % 7}\\n', float(i) / 3) for i in range(400)]
    df = spark.createDataFrame(data, "t timestamp_ntz, s string, d double")
    for order in (["t"], ["s", "t"], ["d"]):
        got = running_sum(df, order, F.lit(1), "n", 25)
        want = {r.t: i + 1 for i, r in enumerate(df.orderBy(*order).collect())}
        assert {r.t: r.n for r in got.collect()} == want
