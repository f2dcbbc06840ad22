"""The export run from registry row to archives, history and catch-up, and the package formats."""

import datetime as dt
import io
import json
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from conftest import rows
from haulage.functions import times as T
from haulage.operators import extract as EX, parts as PA, schema as SC, state as ST
from haulage.plans import export as PL
from haulage.sinks import archive as AR
from haulage.sources import registry as RG

META = ("extract_name string, db_name string, replica string, schema_name string, pk array<string>, uk array<string>, fields array<string>, sql_from string, sql_where string, "
        "sql_join string, sql_with string, sql_settings string, params string, description string, schedule string, is_recent int, is_active int, updated_at timestamp_ntz")


def meta(name, version, active=1, replica="main", sql_from="src", params="{}", recent=0, fields=(), where="{condition}"):
    at = dt.datetime(2024, 1, version)
    return (name, "db", replica, "Target", ["id"], ["id"], list(fields), sql_from, where, "", "", "", params, "", "", recent, active, at)


@pytest.fixture()
def registry(spark):
    return spark.createDataFrame([
        meta("a", 1, params='{"increment": 1}'), meta("a", 2, params='{"increment": 2}'), meta("b", 1), meta("b", 2, active=0), meta("c", 1, sql_from=""), meta("d", 1, replica="other"),
        meta("e", 1, recent=1, fields=["t1.*"])], META)


def test_registry_rules(spark, registry):
    active = RG.active_registry(registry)
    assert rows(active, "extract_name", "params") == [("a", '{"increment": 2}'), ("c", "{}"), ("d", "{}"), ("e", "{}")], "an inactive newest row hides older ones"
    routes = spark.createDataFrame([("main", "S", "p")], "replica string, scenario string, prefix string")
    assert rows(RG.checked_registry(active, routes), "extract_name", "reject_reason") == [("a", None), ("c", "sql_from is empty"), ("d", "unknown replica"), ("e", None)]
    with pytest.raises(ValueError):
        RG.valid_registry(active.where("extract_name in ('c', 'd')"), routes)
    spec = RG.spec_of(active.where("extract_name = 'e'").first())
    assert spec == {"from": "src", "where": "{condition}", "fields": ["t1.*"]}


def test_registry_defaults(spark, registry):
    got = RG.with_schedule(RG.active_registry(registry)).where("extract_name = 'a'").first()
    assert got.schedule == "55 0 * * *" and got.params == '{"increment": 2}'


def test_gates(spark):
    reg = spark.createDataFrame([("a", True, None, False)], "extract_name string, is_active boolean, optimize_exp_table boolean, auto_confirm_delta boolean")
    assert RG.gates(reg, "a") == {"is_active": True, "optimize_exp_table": False, "auto_confirm_delta": False}
    assert RG.gates(reg, "none")["is_active"] is False


def test_statement():
    assert EX.statement("SELECT 1") == "SELECT 1" and EX.statement({"raw": "R"}) == "R"
    spec = {"with": "WITH c AS (SELECT 1)", "fields": ["a", "b"], "from": "t", "joins": "JOIN u", "where": "x", "tail": "ORDER BY 1"}
    assert EX.statement(spec, ["p"], ["s"]) == "WITH c AS (SELECT 1)\nSELECT p, a, b, s\nFROM t\nJOIN u\nWHERE x\nORDER BY 1"
    assert EX.statement({"from": "t"}) == "SELECT *\nFROM t"


def test_settings(spark):
    assert EX.apply_settings(spark, "max_threads=2, spark.sql.files.maxRecordsPerFile=0") == {"spark.sql.files.maxRecordsPerFile": "0"}


def test_window_is_pushed_into_the_scan(spark, sf_dir):
    df = EX.delta_window(spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderdate"), "o_orderdate", "1997-01-01 00:00:00", "1998-01-01 00:00:00")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderdate" in plan and "LessThanOrEqual(o_orderdate" in plan
    assert "o_totalprice" not in plan


def history(spark, *items):
    return spark.createDataFrame([tuple({f.name: i.get(f.name) for f in ST.HISTORY}.values()) for i in items], ST.HISTORY)


def test_next_windows(spark):
    reg = spark.createDataFrame(
        [("new", 60, 0, "2024-01-01 00:00:00", "t"), ("old", 60, 30, "", "t"), ("open", 600, 0, "", "t"), ("never", 60, 0, "", "t")],
        "extract_name string, increment int, overlap int, lower_bound string, time_field string")
    at = dt.datetime(2024, 1, 5)
    log = history(spark, dict(extract_name="old", time_to=dt.datetime(2024, 1, 4), extract_time=dt.datetime(2024, 1, 4), loaded=at),
                  dict(extract_name="old", time_to=at, extract_time=at, loaded=at, sent=at, confirmed=at), dict(extract_name="open", time_to=at, extract_time=at, loaded=at, sent=at))
    got = {r.extract_name: r for r in ST.next_windows(reg, log, "2024-01-05 02:00:00").collect()}
    assert (got["new"].time_from, got["new"].time_to, got["new"].is_first) == (dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 1), True)
    assert (got["old"].time_from, got["old"].time_to, got["old"].is_current) == (dt.datetime(2024, 1, 4, 23, 59, 30), dt.datetime(2024, 1, 5, 1), False)
    assert got["open"].time_to == dt.datetime(2024, 1, 5, 2) and got["open"].is_current
    assert got["never"].time_from == dt.datetime(1970, 1, 1)
    assert {r.extract_name for r in ST.next_windows(reg, log, "2024-01-05 02:00:00", require_confirm=True).collect()} == {"new", "old", "never"}


def test_catch_up_windows_match_brute_force(spark):
    base = dt.datetime(2024, 1, 1)
    times = [base + dt.timedelta(minutes=7 * i) for i in range(-20, 300)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    for overlap in (0, 60, 3600, 3 * 3600):
        got = {r.seq: r for r in ST.window_counts(df, "t", base, base + dt.timedelta(hours=30), 60, overlap).collect()}
        assert sorted(got) == list(range(30)) and [s for s in got if got[s].is_current] == [29]
        for s, r in got.items():
            assert r.n_rows == sum(r.time_from < t <= r.time_to for t in times), (overlap, s)


def source(spark, n=500):
    base = dt.datetime(2024, 1, 1)
    data = [(i, f"row {i}\twith \"tab\"", [i, i + 1], base + dt.timedelta(minutes=i)) for i in range(1, n + 1)]
    spark.createDataFrame(data, "id int, type string, arr array<int>, t timestamp_ntz").createOrReplaceTempView("src")


def job(spark, tmp_path, **overrides):
    row = spark.createDataFrame([meta("Tab", 1, params=json.dumps({"time_field": "t", "lower_bound": "2024-01-01 00:00:00", "increment": 180, "max_file_size": 2000, **overrides}))], META).first()
    return PL.export_of(row, "SC-1", f"file://{tmp_path}/out", f"file://{tmp_path}/history", reserved=["type"])


def test_export_run_until_current(spark, tmp_path):
    source(spark)
    runs = PL.catch_up(spark, job(spark, tmp_path), "2024-01-01 08:20:00")
    assert [r.n_rows for r in runs] == [180, 180, 140] and [r.is_current for r in runs] == [False, False, True]
    log = spark.read.schema(ST.HISTORY).parquet(f"{tmp_path}/history").orderBy("time_from").collect()
    assert [r.extract_count for r in log] == [180, 180, 140] and log[0].exported_files == runs[0].archives
    assert log[1].time_from == log[0].time_to and log[2].extract_time == dt.datetime(2024, 1, 1, 8, 20)
    names = [a for r in runs for a in r.archives]
    assert len(set(names)) == len(names) == len(list((tmp_path / "out").glob("*.zip")))
    seen = []
    for name in runs[-1].archives:
        with zipfile.ZipFile(tmp_path / "out" / name) as z:
            ticket, descriptor, data = z.namelist()
            lines = z.read(data).decode().split("\n")[:-1]
            assert z.read(ticket).decode() == f"{data};{len(lines) - 1}" and data.endswith(f"_{len(lines) - 1}.csv")
            columns = [c["column_name"] for c in json.loads(z.read(descriptor))["columns"]]
            assert lines[0].split("\t") == columns == ["export_time", "id", "type_", "arr", "t", "ctl_action", "ctl_validfrom"]
            assert sum(len(line.encode()) + 1 for line in lines[1:]) <= 2000 + 200
            seen += lines[1:]
    assert len(seen) == 140 and seen[0].split("\t")[1] == "361" and "row 361\\\twith \\\"tab\\\"" in seen[0] and "[361,362]" in seen[0]
    assert (tmp_path / "out" / "main__20240101082002.tkt").read_text().split("\n") == runs[-1].archives
    outbox = spark.read.json(f"{tmp_path}/out/_outbox")
    assert outbox.where(F.col("message").contains(runs[-1].archives[0])).count() == 1


def test_repeated_keys_and_equal_rows(spark, tmp_path):
    """A key that holds most rows, equal rows among them: manifest and archives still agree, every part is bounded."""
    spark.createDataFrame([(1 if i % 3 else i, "same" if i % 2 else f"v{i}" * (i % 9), dt.datetime(2024, 1, 1, 1)) for i in range(600)],
                          "id int, v string, t timestamp_ntz").repartition(4).createOrReplaceTempView("src")
    out = PL.run_export(spark, job(spark, tmp_path, max_file_size=1500), history(spark), "2024-01-01 02:00:00")
    counts = []
    for name in out.archives:
        with zipfile.ZipFile(tmp_path / "out" / name) as z:
            ticket, _, data = z.namelist()
            lines = z.read(data).decode().split("\n")[1:-1]
            assert z.read(ticket).decode().endswith(f";{len(lines)}") and sum(len(x.encode()) + 1 for x in lines) <= 1500
            counts.append(len(lines))
    assert sum(counts) == 600 == out.n_rows and len(counts) > 20


def test_empty_package(spark, tmp_path):
    source(spark, 10)
    silent = PL.run_export(spark, job(spark, tmp_path, lower_bound="2025-01-01 00:00:00"), history(spark), "2025-01-02 00:00:00")
    assert silent.archives == [] and silent.n_rows == 0
    sent = PL.run_export(spark, job(spark, tmp_path, lower_bound="2025-01-01 00:00:00", send_empty=1), history(spark), "2025-01-02 00:00:00")
    assert sent.archives == ["main__20250102000000__tab__0_1_0.zip"]
    with zipfile.ZipFile(tmp_path / "out" / sent.archives[0]) as z:
        assert [len(z.read(n).decode().splitlines()) for n in z.namelist()][-1] == 1
    log = spark.read.schema(ST.HISTORY).parquet(f"{tmp_path}/history").orderBy("sent").collect()
    assert [r.sent is None for r in log] == [True, False]


def test_recent_mode_and_parameters(spark, tmp_path):
    source(spark)
    row = spark.createDataFrame([meta("Tab", 1, recent=1, where="", params='{"time_field": "t", "recent_interval": 30, "pg_array_format": 1, "xstream_sanitize": 1, "sanitize_list": "[[\\"row\\", \\"line\\"]]"}')], META).first()
    export = PL.export_of(row, "SC-1", f"file://{tmp_path}/out", f"file://{tmp_path}/history", overrides={"strategy": "INC", "increment": None, "notify_kafka": "0"}, environment="dev")
    assert export.params["strategy"] == "INC" and export.params["increment"] == "60" and not export.flag("notify_kafka")
    out = PL.run_export(spark, export, history(spark), "2024-01-01 05:00:00.700")
    assert (out.n_rows, out.is_current, out.time_from) == (30, True, "2024-01-01 04:30:00")
    with zipfile.ZipFile(tmp_path / "out" / out.archives[0]) as z:
        body = z.read(z.namelist()[2]).decode()
        assert "line 271" in body and "{271,272}" in body and json.loads(z.read(z.namelist()[1]))["strategy"] == "INC"
    bad = spark.createDataFrame([meta("Tab", 1, params='{"format": "CSV"}')], META).first()
    with pytest.raises(ValueError):
        PL.export_of(bad, "S", "r", "h")


def test_descriptor(spark):
    df = spark.sql("SELECT 1 AS id, CAST(1 AS DECIMAL(18,4)) AS n, CAST(1 AS DECIMAL(20,0)) AS big, 'x' AS Type, array(1) AS arr, true AS flag, DATE'2024-01-01' AS d, 1L + 1L AS total")
    comments = spark.createDataFrame([("id", "key"), ("n", "")], "column_name string, comment string")
    got = {r.column_name: r for r in SC.descriptor(df, comments, words=["type"], calculated={"total": "1 + 1"}).collect()}
    assert [r.column_name for r in SC.descriptor(df, words=["type"]).orderBy("position").collect()] == ["export_time", "id", "n", "big", "Type_", "arr", "flag", "d", "total", "ctl_action", "ctl_validfrom"]
    assert (got["n"].source_type, got["n"].length, got["n"].precision, got["n"].scale) == ("NUMERIC", 18, 18, 4)
    assert (got["big"].source_type, got["arr"].source_type, got["flag"].source_type, got["d"].source_type) == ("BIGINT", "STRING", "STRING", "DATE")
    assert got["id"].description == "key" and got["n"].description is None and got["total"].description == "Calculated: 1 + 1" and got["id"].notnull
    assert "select" in SC.reserved_names(spark, ["select", "id"]) and SC.reserved_names(spark, ["Id"], ["id"]) == {"Id"}


def test_auto_confirm_appends_once(spark):
    at = dt.datetime(2024, 1, 5)
    log = history(spark, dict(extract_name="a", extract_time=at, sent=at), dict(extract_name="b", extract_time=at, sent=at, confirmed=at), dict(extract_name="c", extract_time=at))
    more = ST.auto_confirm(log, "2024-01-06 00:00:00")
    assert rows(more, "extract_name", "confirmed") == [("a", dt.datetime(2024, 1, 6))]
    assert ST.auto_confirm(log.unionByName(more), "2024-01-07 00:00:00").isEmpty()
    windows = spark.createDataFrame([(True, 10), (False, 10)], "is_current boolean, timeout int")
    assert rows(ST.next_run(windows, "2024-01-01 00:00:00", F.col("timeout")), "next_run") == [(None,), (dt.datetime(2024, 1, 1, 0, 10),)]


def test_run_is_held_confirmed_and_auto_confirmed(spark, tmp_path):
    """One window after another: held until its receipt comes, failed, timed out, and confirmed by the gate."""
    source(spark)
    log = lambda: spark.read.schema(ST.HISTORY).parquet(f"{tmp_path}/history")
    receipt = lambda *items: spark.createDataFrame([("Tab", t, at, code) for t, at, code in items], ST.RECEIPTS)
    export = job(spark, tmp_path, auto_confirm=0, confirm_timeout=30)
    assert PL.run_export(spark, export, history(spark), "2024-01-01 08:20:00").n_rows == 180
    first = log().first().extract_time
    assert PL.run_export(spark, export, log(), "2024-01-01 08:40:00").held == "waiting" and log().count() == 1
    assert PL.run_export(spark, export, log(), "2024-01-01 08:50:00").held == "timeout"
    bad = receipt((first, dt.datetime(2024, 1, 1, 8, 30), 104))
    assert PL.run_export(spark, export, log(), "2024-01-01 08:40:00", receipts=bad).held == "failed"
    late = receipt((first, dt.datetime(2024, 1, 1, 8, 51), 0))
    assert PL.run_export(spark, export, log(), "2024-01-01 08:55:00", receipts=late).held == "timeout" and log().where("confirmed IS NOT NULL").isEmpty()
    good = receipt((first, dt.datetime(2024, 1, 1, 8, 30), 0), (first, dt.datetime(2024, 1, 1, 8, 35), 104))
    runs = PL.catch_up(spark, export, "2024-01-01 08:40:00", receipts=lambda: good)
    assert [(r.n_rows, r.held) for r in runs] == [(180, None), (0, "waiting")], "the next window waits for its own receipt"
    assert [r.confirmed for r in log().where(F.col("extract_time") == first).orderBy("confirmed").collect()] == [None, dt.datetime(2024, 1, 1, 8, 30)]
    calls = []
    export.gates, export.optimize = {"is_active": True, "auto_confirm_delta": True, "optimize_exp_table": True}, lambda: calls.append(1)
    done = PL.run_export(spark, export, log(), "2024-01-01 09:00:00")
    assert done.held is None and done.n_rows == 140 and calls == [1]
    states = {r.extract_time: r.confirmed for r in log().groupBy("extract_time").agg(F.max("confirmed").alias("confirmed")).collect()}
    assert sorted(map(str, states.values())) == ["2024-01-01 08:30:00", "2024-01-01 09:00:00", "None"], "what was sent before the run is confirmed"
    export.gates = {"is_active": False}
    assert PL.run_export(spark, export, log(), "2024-01-01 10:00:00").held == "inactive" and calls == [1]


def test_tar_archives(spark, tmp_path):
    df = spark.range(100).select(F.col("id"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("v"))
    parts = PA.with_parts(df, ["id"], 300)
    named = PA.named_manifest(parts, "S", "T", "R", "20240101000000")
    log = AR.write_archives(parts, named, ["id", "v"], ["id"], f"file://{tmp_path}", "{}", "20240101000000", kind="tar.gz").collect()
    got = []
    for r in log:
        with tarfile.open(tmp_path / r.archive_name) as tar:
            names = tar.getnames()
            body = tar.extractfile(names[2]).read().decode().split("\n")[1:-1]
            assert len(names) == 3 and len(body) == r.n_rows
            got += body
    assert sorted(got) == sorted(f"{i}\tv{i}" for i in range(100)) and all(".tar.gz" in r.archive_name for r in log)


def unpacked(path):
    """Members of a file by name, read with the standard library."""
    import gzip

    if path.name.endswith(".zip"):
        with zipfile.ZipFile(path) as z:
            return {n: z.read(n) for n in z.namelist()}
    if path.name.endswith(".tar.gz"):
        with tarfile.open(path) as tar:
            return {m.name: tar.extractfile(m).read() for m in tar.getmembers()}
    data = path.read_bytes()
    return {path.name.removesuffix(".gz"): gzip.decompress(data) if path.name.endswith(".gz") else data}


@pytest.mark.parametrize("codec", ["gz", "zip", "tar.gz", "none"])
def test_conversions(spark, tmp_path, codec):
    import gzip

    from haulage.sources import files as FI

    source = tmp_path / "in"
    for folder in ("a", "b/c"):
        (source / folder).mkdir(parents=True)
        (source / folder / "x.txt").write_bytes(folder.encode() * 1000)
        (source / folder / "y.csv.gz").write_bytes(gzip.compress(b"y" + folder.encode()))
        with zipfile.ZipFile(source / folder / "z.zip", "w") as z:
            z.writestr("m1", "one")
            z.writestr("d/m2", folder)
        with tarfile.open(source / folder / "t.tar.gz", "w:gz") as tar:
            for name, body in (("p", b"pp"), ("q", b"")):
                info = tarfile.TarInfo(name)
                info.size = len(body)
                tar.addfile(info, io.BytesIO(body))
    log = AR.convert_objects(FI.listing(spark, str(source)), f"file://{tmp_path}/out", str(source), codec).collect()
    made = {str(p.relative_to(tmp_path / "out")): unpacked(p) for p in (tmp_path / "out").rglob("*") if p.is_file()}
    assert {r.new_path.removeprefix(f"file://{tmp_path}/out/") for r in log} == set(made)
    contents = sorted(body for members in made.values() for body in members.values())
    assert contents == sorted(x for f in (b"a", b"b/c") for x in (f * 1000, b"y" + f, b"one", f, b"pp", b""))
    ends = {"gz": ".gz", "zip": ".zip", "tar.gz": ".tar.gz", "none": ""}
    assert all(name.endswith(ends[codec]) for name in made)


def test_copies_do_not_meet(spark, tmp_path):
    from haulage.sources import files as FI

    for folder in ("a", "b"):
        (tmp_path / "in" / folder).mkdir(parents=True)
        (tmp_path / "in" / folder / "x.csv").write_text(folder)
    (tmp_path / "in" / "a" / "x.csv.gz").write_bytes(b"packed")
    objects = FI.listing(spark, str(tmp_path / "in"))
    AR.copy_objects(objects, f"file://{tmp_path}/out", str(tmp_path / "in")).collect()
    assert [(tmp_path / "out" / f / "x.csv").read_text() for f in "ab"] == ["a", "b"]
    with pytest.raises(ValueError):
        AR.copy_objects(objects, f"file://{tmp_path}/out2", str(tmp_path / "in"), compress=True)
    with pytest.raises(ValueError):
        AR.copy_objects(objects, f"file://{tmp_path}/out2", str(tmp_path / "other"))


def test_parts_keep_their_bound(spark, tmp_path):
    df = spark.range(200).select("id", F.concat(F.lit('a\t"b\\c\n'), F.repeat(F.lit("\t"), (F.col("id") % 40).cast("int"))).alias("v"))
    head = PA.head_bytes(df.columns)
    parts = PA.with_parts(df, ["id"], 600, head=head)
    named = PA.named_manifest(parts, "S", "T", "R", "20240101000000", head=head)
    log = {r.part_no: r for r in AR.write_archives(parts, named, ["id", "v"], ["id"], f"file://{tmp_path}", "{}", "20240101000000").collect()}
    for r in named.collect():
        with zipfile.ZipFile(tmp_path / r.archive_name) as z:
            assert len(z.read(r.data_name)) == r.n_bytes == log[r.part_no].n_bytes <= 600


def test_hand_named_zip(spark, tmp_path):
    """Member names in cp866, folders skipped, quoted line breaks kept, packed members read through."""
    import gzip

    from pyspark.sql import types as PT

    from haulage.sources import files as FI

    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("dir/", "")
        z.writestr("dir/qqqq.csv", 'a,b\n1,"x\ny"\n2,\n')
        z.writestr("two.csv.gz", gzip.compress(b"a,b\n3,z\n"))
    (tmp_path / "in.zip").write_bytes(raw.getvalue().replace(b"qqqq", "итог".encode("cp866")))
    objects = FI.listing(spark, str(tmp_path))
    assert rows(FI.zip_contents(objects), "member") == [("dir/итог.csv",), ("two.csv.gz",)]
    schema = PT.StructType([PT.StructField("a", PT.IntegerType()), PT.StructField("b", PT.StringType())])
    assert rows(FI.typed_records(FI.zip_records(objects), schema)) == [(1, "x\ny"), (2, None), (3, "z")]


def test_moment_is_zone_free(spark):
    assert spark.range(1).select(T.moment(dt.datetime(2024, 1, 1, 3)).alias("x")).first().x == dt.datetime(2024, 1, 1, 3)
