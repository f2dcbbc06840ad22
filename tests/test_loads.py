"""File loads, copies, messages, switched tables and catalog comments."""

import datetime as dt
import gzip
from pathlib import Path

import pytest
from pyspark.sql import functions as F, types as PT

from conftest import rows
from haulage.operators import checks as CK, retention as RT
from haulage.sinks import archive as AR, ledger as LG, notify as NO
from haulage.sources import files as FI, messages as MS, tables as TB

PAIR = PT.StructType([PT.StructField("a", PT.IntegerType()), PT.StructField("b", PT.StringType())])

# A store's stock: five articles, one with a remark full of separators, one of which only the number is known.
REMARK = '6" pipe; "red"\tor blue,\nsee C:\\lists'
STOCK = [
    (11, "bolt M8", "", 2400, "0.1250", 7.9, [8, 16, 25], ["steel", "din 933"], True, dt.date(2021, 3, 30), dt.datetime(2021, 3, 31, 6, 45, 10)),
    (12, "pipe", REMARK, 18, "14.0000", 0.55, [], ["red, blue", "6\""], False, dt.date(2020, 2, 29), dt.datetime(2020, 2, 29, 23, 59, 59)),
    (13, "rope", "by the metre", None, "2.9900", None, [10], [], True, None, dt.datetime(1999, 12, 31)),
    (14, None, None, None, None, None, None, None, None, None, None),
    (15, "größe µ", "ünïcode", -1, "-99999.0001", 1e-9, [-2, 0], ["ß"], False, dt.date(1970, 1, 1), None),
]


@pytest.fixture(scope="module")
def typed(spark):
    raw = spark.createDataFrame(STOCK, "article int, label string, remark string, pieces bigint, price string, weight double, sizes array<int>, tags array<string>, sold boolean, "
                                "listed date, counted timestamp_ntz")
    return raw.withColumn("price", F.col("price").cast("decimal(18,4)"))


def test_copy_and_checks(spark, typed, tmp_path):
    check = TB.copy_table(typed, f"{tmp_path}/t").first()
    back = spark.read.parquet(f"{tmp_path}/t")
    assert check.is_equal and CK.same_content(typed, back) and CK.same_checksum(typed, back)
    assert CK.sum_check(back, "article", 5, 65).first().is_ok
    assert TB.copy_table(typed, f"{tmp_path}/t", truncate=False).first().is_equal and spark.read.parquet(f"{tmp_path}/t").count() == 10
    assert not CK.same_content(typed, spark.read.parquet(f"{tmp_path}/t")) and CK.same_content(typed, spark.read.parquet(f"{tmp_path}/t"), distinct=True)
    text = TB.all_text(typed).where("article = '11'").first()
    assert text.tags == "['steel','din 933']" and text.price == "0.1250" and text.counted == "2021-03-31 06:45:10"


def test_checksum_sees_moved_nulls(spark):
    a = spark.createDataFrame([(None, 1)], "a int, b int")
    b = spark.createDataFrame([(1, None)], "a int, b int")
    assert not CK.same_checksum(a, b)


@pytest.mark.parametrize("fmt", ["CSV", "TSVWithNames", "JSON"])
@pytest.mark.parametrize("codec", ["none", "gzip"])
def test_export_formats(spark, typed, tmp_path, fmt, codec):
    plain = typed.drop("sizes", "tags")
    TB.export_table(plain, f"{tmp_path}/{fmt}", fmt, codec)
    reader = spark.read.schema(plain.schema)
    if fmt == "JSON":
        back = reader.json(f"{tmp_path}/{fmt}")
    else:
        back = reader.option("header", "true").option("multiLine", "true").option("escape", '"').option("emptyValue", "").option("sep", "," if fmt == "CSV" else "\t").csv(f"{tmp_path}/{fmt}")
    assert back.count() == 5 and back.where("article = 12").first().remark == REMARK and back.agg(F.sum("article")).first()[0] == 65
    assert all((".gz" in f) == (codec == "gzip") for f in plain.sparkSession.read.text(f"{tmp_path}/{fmt}").inputFiles())


def test_load_csv(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a;b\n1;x\n2;\n")
    (tmp_path / "y.csv.gz").write_bytes(gzip.compress(b"a;b\n3;z\n"))
    options = "CSV HEADER DELIMITER ';'"
    assert FI.load_csv(spark, str(tmp_path / "x.csv"), PAIR, f"{tmp_path}/t", options) == 2
    assert FI.load_csv(spark, str(tmp_path / "y.csv.gz"), PAIR, f"{tmp_path}/t", options) == 1
    assert rows(spark.read.parquet(f"{tmp_path}/t")) == [(1, "x"), (2, None), (3, "z")]
    assert FI.load_csv(spark, str(tmp_path / "y.csv.gz"), PAIR, f"{tmp_path}/t", options, truncate=True) == 1 and spark.read.parquet(f"{tmp_path}/t").count() == 1
    assert FI.csv_options() == {"header": "true", "sep": ","} and FI.csv_options("CSV DELIMITER E'\\t' NULL ''") == {"header": "false", "sep": "\t", "nullValue": ""}


def test_load_by_name(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "tab 1.csv").write_text("a,b\n1,x\n")
    (folder / "tab 2.csv").write_text("a,b\n2,y\n3,z\n")
    (folder / "tab 3.csv").write_text("a,b\nbad,y\n9,z\n")
    (folder / "other.csv").write_text("a,b\n7,o\n")
    ledger = FI.load_by_name(spark, FI.listing(spark, str(folder)), {"tab": PAIR, "none": PAIR}, f"{tmp_path}/tables", "2024-01-02 03:04:05", truncate=True)
    got = {r.new_path: (r.table_name, r.status, r.n_rows) for r in ledger.collect()}
    assert {k.split("/")[0]: None for k in got} == {"tfs-archive": None, "tfs-errors": None}
    assert sorted(got.values()) == [("other", "failed", 0), ("tab", "failed", 0), ("tab", "loaded", 1), ("tab", "loaded", 2)]
    assert FI.load_by_name(spark, FI.listing(spark, str(folder)), {}, f"{tmp_path}/none", "2024-01-02 03:04:05").count() == 4
    assert rows(spark.read.parquet(f"{tmp_path}/tables/tab")) == [(1, "x"), (2, "y"), (3, "z")]


def test_listing_and_heads(spark, tmp_path):
    for name, text in (("a.csv", "1\n2\n3\n"), ("b.csv.done", ""), ("b.csv", "x"), ("c.error", "")):
        (tmp_path / name).write_text(text)
    (tmp_path / "z.txt.gz").write_bytes(gzip.compress(b"g1\ng2\n"))
    objects = FI.listing(spark, str(tmp_path))
    names = lambda df: sorted(r.path.rsplit("/", 1)[1] for r in df.collect())
    assert names(FI.matching(objects, "*")) == ["a.csv", "b.csv", "b.csv.done", "z.txt.gz"] and names(FI.done_gated(objects)) == ["b.csv"]
    assert names(FI.used_markers(FI.done_gated(objects)).withColumnRenamed("marker", "path")) == ["b.csv.done"]
    assert rows(FI.head(objects.where("path like '%a.csv' or path like '%.gz'"), 2), "line_no", "value") == [(0, "1"), (0, "g1"), (1, "2"), (1, "g2")]
    assert FI.text_lines(spark, str(tmp_path / "a.csv")).count() == 3
    assert FI.first_source([objects.where("false"), objects]).count() == 5 and FI.first_source([objects.where("false")]) is None
    assert CK.has_prefix(objects, f"file:{tmp_path}/a") and not CK.has_prefix(objects, "nothing")
    assert RT.expired_objects(objects, "2999-01-01 00:00:00", 30).count() == 5 and RT.expired_objects(objects, "2000-01-01 00:00:00", 30).isEmpty()
    log = AR.copy_objects(FI.matching(objects, "*.csv").unionByName(FI.matching(objects, "*.gz")), f"file://{tmp_path}/out", str(tmp_path), compress=True).collect()
    assert sorted(r.new_path.rsplit("/", 1)[1] for r in log) == ["a.csv.gz", "b.csv.gz", "z.txt.gz"]
    assert gzip.decompress((tmp_path / "out" / "a.csv.gz").read_bytes()) == b"1\n2\n3\n" and gzip.decompress((tmp_path / "out" / "z.txt.gz").read_bytes()) == b"g1\ng2\n"


def test_listing_of_any_tree(spark, tmp_path):
    for folder in ("deep/er/still", "empty", "flat"):
        (tmp_path / "in" / folder).mkdir(parents=True)
    paths = lambda: sorted(r.path.rsplit("/in/", 1)[1] for r in FI.listing(spark, str(tmp_path / "in")).collect())
    assert paths() == []
    for name in ("deep/er/still/a.csv", "deep/b.csv", "flat/c.csv", "flat/.hidden", "flat/.done"):
        (tmp_path / "in" / name).write_text("x")
    assert paths() == ["deep/b.csv", "deep/er/still/a.csv", "flat/.done", "flat/c.csv"]
    assert FI.listing(spark, str(tmp_path / "in" / "empty")).count() == 0


def test_long_fields_of_archives(spark, tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("m.csv", "k,v\n1," + "x" * 300_000 + "\n")
    got = FI.typed_records(FI.zip_records(FI.listing(spark, str(tmp_path))), PAIR).first()
    assert got.a == 1 and len(got.b) == 300_000


def test_members_are_read_by_many_tasks(spark, tmp_path):
    """One archive with 40 members, packed and plain, large and empty: every member by its own byte range."""
    import random
    import zipfile

    rnd = random.Random(2)
    rest, want = [], []
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("folder/", "")
        for i in range(40):
            found = [(i * 10_000 + k, rnd.choice(["x", "y" * 500, str(rnd.random())])) for k in range(rnd.choice([0, 1, 3, 4000]))]
            want += found
            info = zipfile.ZipInfo(f"m{i}.csv")
            info.extra = b"\x99\x99\x04\x00abcd" * (i % 3)
            z.writestr(info, "k,v\n" + "".join(f"{k},{v}\n" for k, v in found), zipfile.ZIP_DEFLATED if i % 4 else zipfile.ZIP_STORED)
        z.writestr("deep.csv.gz", gzip.compress(b"k,v\n-1,z\n"))
    objects = FI.listing(spark, str(tmp_path))
    records = FI.zip_records(objects)
    assert rows(FI.typed_records(records, PAIR)) == sorted([*want, (-1, "z")], key=repr)
    assert records.where("record_no = 0").select(F.spark_partition_id().alias("task")).distinct().count() > 4
    assert FI.zip_contents(objects).count() == 41
    data = bytearray((tmp_path / "a.zip").read_bytes())
    at = data.index(b"y" * 400)  # a plain member
    data[at] = ord("n")
    (tmp_path / "a.zip").write_bytes(bytes(data))
    with pytest.raises(Exception, match="damaged"):
        FI.zip_records(objects).collect()


def test_line_numbers_over_splits(spark, tmp_path):
    import random

    rnd = random.Random(1)
    texts = {name: "".join(rnd.choice(["", "a", "line " * 30, "ü"]) + rnd.choice(["\n", "\r\n"]) for _ in range(n)) for name, n in (("a.txt", 700), ("b c+d.txt", 300), ("one.txt", 1))}
    texts["open.txt"] = "x\n\ny"
    texts["empty.txt"] = ""
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    (tmp_path / "z.txt.gz").write_bytes(gzip.compress(b"g1\ng2\n"))
    texts["z.txt.gz"] = "g1\ng2\n"
    want = []
    for name, text in texts.items():
        body = text.split("\n")
        body = body[:-1] if body[-1] == "" else body
        want += [(name, i, x.removesuffix("\r")) for i, x in enumerate(body)]
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("1000", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "100")
            lines = FI.text_lines(spark, str(tmp_path))
            named = lines.withColumn("name", F.regexp_extract(F.url_decode(F.regexp_replace("path", r"\+", "%2B")), "([^/]*)$", 1))
            assert rows(named, "name", "line_no", "value") == sorted(want, key=repr)
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_join_objects(spark, tmp_path):
    texts = {"part-10-x.txt": "c\n", "part-9-x.txt": "", "part-2-x.txt": "a\nb", "part-100-x.txt": "größe\r\n"}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    number = F.regexp_extract("path", r"part-(\d+)", 1).cast("int")
    made = AR.join_objects(FI.listing(spark, str(tmp_path)), [number], f"file://{tmp_path}/out", "all/one.txt").collect()
    assert [tuple(r) for r in made] == [(f"file://{tmp_path}/out/all/one.txt", 4, 14)]
    assert (tmp_path / "out/all/one.txt").read_bytes() == "a\nbc\ngröße\r\n".encode()
    assert [p.name for p in (tmp_path / "out/all").iterdir() if not p.name.startswith(".")] == ["one.txt"]


def test_file_lines_sorts_in_ranges(spark, tmp_path):
    """One sorted file is written, but no task sorts all of it; event ids here are out of order, twice, null and negative."""
    from haulage.plans.catalogue import QUERIES

    ids = [None, None, -3, 7, 7, *range(20, 1020)]
    events = [(i, 50 if i is not None and i % 100 == 0 else 1) for i in ids]
    spark.createDataFrame(events[::-1], "event_id long, user_id long").write.parquet(f"{tmp_path}/in/events.parquet")
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")) / "haulage"
    before = set(shared.glob("lines-*/"))
    kept = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        got = rows(QUERIES["file_lines"](spark, f"{tmp_path}/in"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", kept)
    lines = ["", "", "head", "r7", "r7", *["head" if i % 100 == 0 else f"r{i}" for i in range(20, 1020)]]
    folders = set(shared.glob("lines-*/")) - before
    whole = [f for folder in folders for f in folder.rglob("*.txt") if f.read_text().split("\n")[:-1] == lines]
    sizes = [f.stat().st_size for folder in folders for f in folder.rglob("part-*.txt")]
    assert len(whole) == 1 and len(sizes) >= 4 and max(sizes) < whole[0].stat().st_size / 2
    assert sum(r[1] for r in got) == len([x for x in lines if x != ""])


def test_messages(spark):
    xml = ('<n:TransferFileCephRq xmlns:n="u"><n:RqUID> u1 </n:RqUID><n:ScenarioInfo><n:ScenarioId>S</n:ScenarioId></n:ScenarioInfo><n:File><n:FileInfo><n:Name>a.csv</n:Name></n:FileInfo>'
           "<n:FileInfo><n:Name></n:Name></n:FileInfo><n:FileInfo><n:Name>b.csv</n:Name><n:FolderSource>/x/</n:FolderSource></n:FileInfo></n:File></n:TransferFileCephRq>")
    plain = "<TransferFileCephRq><RqUID>u2</RqUID><File><FileInfo><Name>c</Name></FileInfo></File></TransferFileCephRq>"
    got = MS.parse_requests(spark.createDataFrame([(1, xml), (2, plain)], "id int, xml string"), "xml", ["id"], "in/")
    assert rows(got, "id", "rq_uid", "scenario_id", "key") == [(1, "u1", "S", "in/a.csv"), (1, "u1", "S", "in/x/b.csv"), (2, "u2", "manual", "in/c")]
    copies = spark.createDataFrame([("u1", "a.csv", True)], "rq_uid string, name string, failed boolean")
    status = MS.receipt_status(got, copies)
    assert rows(status) == [("u1", 104, "Transfer failed"), ("u2", 0, "Successful")]
    back = MS.parse_receipts(NO.receipts(status, "2024-01-01 00:00:00"), "message", ["rq_uid"]).select("code", "text")
    assert rows(back) == [(0, "Successful"), (104, "Transfer failed")]


def test_notifications_repeat(spark):
    files = spark.createDataFrame([(0, "a.tkt"), (1, "b.zip")], "position bigint, name string")
    first, second = (rows(NO.notifications(files, "p", "S", "2024-01-01 00:00:00")) for _ in range(2))
    assert first == second and first[0][1] != first[1][1] and "<ScenarioId>S</ScenarioId>" in first[0][3]


def test_switched_table(spark, tmp_path):
    table = LG.SwitchedTable(spark, f"{tmp_path}/t")
    with pytest.raises(ValueError):
        table.read()
    assert table.load(spark.range(3)) == 3 and table.active() == 0
    assert table.load(spark.range(5), expected=5) == 5 and table.active() == 1
    with pytest.raises(ValueError):
        table.load(spark.range(2), expected=9)
    assert table.active() == 1 and table.read().count() == 5
    table.load(spark.range(1))
    assert table.active() == 0 and table.read().count() == 1


def test_catalog_comments(spark):
    spark.sql("CREATE TABLE IF NOT EXISTS default.haulage_t1 (id INT) USING parquet COMMENT 'first table'")
    wanted = spark.createDataFrame([("default", "haulage_t1"), ("default", "haulage_t2")], "db_name string, extract_name string")
    assert rows(TB.comments_for(wanted, TB.catalog_comments(spark, "default"))) == [("default", "haulage_t1", "first table"), ("default", "haulage_t2", "")]
    spark.sql("DROP TABLE default.haulage_t1")
