"""Every registered query beside its SQL on the smallest tables, and the driver contract."""

import importlib.util
import os

import pytest

import __spark_entry__ as entry

spec = importlib.util.spec_from_file_location("check_oracle", os.path.join(os.path.dirname(__file__), "..", "scripts", "check_oracle.py"))
check = importlib.util.module_from_spec(spec)
spec.loader.exec_module(check)


@pytest.fixture(scope="module")
def duck(sf_dir):
    return check.connect(sf_dir)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, duck, sf_dir, name):
    problem = check.compare(spark, duck, sf_dir, entry.queries()[name], entry.oracle_sql().get(name))
    assert problem in (None, "the SQL gives no rows"), problem


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    result = entry.entry(spark)
    assert result.count() > 0 and "archive_name" in result.columns


def test_write_if_changed_by_hand(spark, sf_dir):
    steps = {r.step: r for r in entry.queries()["write_if_changed"](spark, sf_dir).collect()}
    assert [steps[s].written for s in ("first", "same", "altered")] == [True, False, True]
    assert steps["first"].n_rows == steps["same"].n_rows == spark.read.parquet(f"{sf_dir}/orders.parquet").count()
