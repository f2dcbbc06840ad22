"""Trees of any depth, and comparisons by ranges beside the plain one."""

import json
import random

from pyspark.sql import functions as F

from haulage.operators import checks as CK, trees as TR
from tests.conftest import rows

NODES = "id bigint, parent_id bigint, name string"


def test_chain_of_a_thousand_in_few_rounds(spark, monkeypatch):
    written = []
    monkeypatch.setattr(TR, "stored", lambda df, label, keep=TR.stored: written.append(label) or keep(df, label))
    chain = [(i, i - 1 if i else None, f"n{i}") for i in range(1001)]
    random.Random(1).shuffle(chain)
    got = TR.subtree(spark.createDataFrame(chain, NODES), "n1")
    assert len(written) <= 12
    assert rows(got, "id", "depth", "parent_name") == sorted([(i, i - 1, f"n{i - 1}" if i > 1 else None) for i in range(1, 1001)], key=repr)


def test_trees_with_circles_two_roots_and_strays(spark):
    nodes = [(1, None, "r"), (2, 1, "a"), (3, 2, "b"), (3, 1, "b2"), (10, 11, "c"), (11, 10, "d"), (12, 11, "e"), (20, 3, "r"), (21, 20, "f"), (30, 99, "g"), (None, 1, "h"), (40, None, None)]
    got = rows(TR.subtree(spark.createDataFrame(nodes, NODES), "r"))
    assert got == sorted([(1, None, "r", None, 0), (20, 3, "r", None, 0), (2, 1, "a", "r", 1), (3, 1, "b2", "r", 1), (21, 20, "f", "r", 1)], key=repr)
    circle = [(5, 6, "r"), (6, 5, "s"), (7, 7, "t")]
    assert rows(TR.subtree(spark.createDataFrame(circle, NODES), "r"), "id", "depth") == [(5, 0), (6, 1)]
    assert TR.subtree(spark.createDataFrame([], NODES), "r").count() == 0


def test_entities_of_any_depth(spark):
    tree, want = {"entity": {"id": 0, "name": "n0"}}, [(0, None, "n0")]
    node = tree
    for i in range(1, 40):
        node["kidz"] = [{"entity": {"id": i, "parentId": i - 1, "name": f"n{i}"}}, {"entity": {"id": 1000 + i, "parentId": i - 1}, "kidz": None}]
        want += [(i, i - 1, f"n{i}"), (1000 + i, i - 1, None)]
        node = node["kidz"][0]
    docs = spark.createDataFrame([(json.dumps(tree),), (None,), ("",)], "tree string")
    assert rows(TR.flatten_entities(docs)) == sorted(want, key=repr)


def test_ranges_find_the_same_rows(spark):
    base = spark.range(5000).select("id", (F.col("id") % 7).alias("v"), F.when(F.col("id") % 5 > 0, F.lit("x")).alias("_mark"))
    other = base.where("id % 1000 <> 3").withColumn("v", F.when(F.col("id") % 900 == 1, None).otherwise(F.col("v"))).unionByName(base.where("id = 8"))
    for key in (["id"], None, ["_mark"]):
        for distinct in (False, True):
            assert rows(CK.difference_by_ranges(base, other, key, distinct)) == rows(CK.difference(base, other, distinct))
    assert CK.difference_by_ranges(base, base.repartition(3), ["id"]).count() == 0
    assert CK.difference_by_ranges(base.limit(0), base.limit(0)).count() == 0


def test_equal_tables_shuffle_no_rows_and_few_changes_few(spark, monkeypatch):
    compared = []
    monkeypatch.setattr(CK, "difference", lambda left, right, distinct=False, keep=CK.difference: compared.append(left.count() + right.count()) or keep(left, right, distinct))
    base = spark.range(200_000).select("id", F.md5(F.col("id").cast("string")).alias("v"))
    CK.difference_by_ranges(base, base.select("id", "v"), ["id"])
    CK.difference_by_ranges(base, base.where("id <> 17").withColumn("v", F.when(F.col("id") == 40_000, "x").otherwise(F.col("v"))), ["id"]).collect()
    assert compared[0] == 0 and 0 < compared[1] < 100
