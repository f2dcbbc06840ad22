import csv
import datetime as dt
import io

import pytest
from pyspark.sql import functions as F

from haulage.functions import jsons as J, numbers as N, paths as P, text as X, times as T
from haulage.sinks import delimited as DL


def one(spark, column, **values):
    frame = spark.range(1)
    for name, value in values.items():
        frame = frame.withColumn(name, F.lit(value))
    return frame.select(column.alias("x")).first()[0]


# 2024-05-16 is a Thursday.
SHIFTS = [
    ("time=8:30", "2024-05-16 08:30:00"), ("time=0:00", "2024-05-16 00:00:00"), ("time=23", "2024-05-16 23:00:00"), ("date=2023-01-02", "2023-01-02 13:14:15"),
    ("date=02.03", "2024-03-02 13:14:15"), ("date=02.03.2020", "2020-03-02 13:14:15"), ("date=2022", None), ("weekday=0", "2024-05-13 13:14:15"),
    ("weekday=6", "2024-05-19 13:14:15"), ("hours=+5", "2024-05-16 18:14:15"), ("minutes=-15", "2024-05-16 12:59:15"), ("2 days", "2024-05-18 13:14:15"), ("1 hour", "2024-05-16 14:14:15"),
    ("1:05:10", "2024-05-16 14:19:25"), ("2", "2024-05-16 15:14:15"), ("days=1, time=6:00", "2024-05-17 06:00:00"), ("", "2024-05-16 13:14:15"), ("weeks=-1,milliseconds=500", "2024-05-09 13:14:15"),
    ("hours=x", "2024-05-16 13:14:15"),
]


@pytest.mark.parametrize("text,want", [s for s in SHIFTS if s[1]])
def test_shift(spark, text, want):
    ts = T.moment("2024-05-16 13:14:15.700000" if "milli" not in text else "2024-05-16 13:14:15")
    compiled = one(spark, T.shift(ts, text))
    per_row = one(spark, T.shift_by_column(ts, F.col("e")), e=text)
    assert str(compiled) == want and str(per_row) == want


def test_shift_edges(spark):
    ts = T.moment("2024-05-16 13:14:15.700000")
    assert one(spark, T.shift(ts, None)) == dt.datetime(2024, 5, 16, 13, 14, 15, 700000)
    assert one(spark, T.shift_by_column(ts, F.lit(None).cast("string"))) == dt.datetime(2024, 5, 16, 13, 14, 15, 700000)
    with pytest.raises(ValueError):
        T.shift(ts, "fortnights=2")
    assert one(spark, T.shift_by_column(ts, F.lit("fortnights=2"))) is None


@pytest.mark.parametrize("text,seconds", [("hours=1,minutes=5", 3900), ("h=2, MIN=30 , s=1", 9001), ("d=1,weeks=1", 691200), ("junk=5,hours=x,5", 0), ("hours=-1", -3600), ("min=1=2", 60), ("milliseconds=1500", 1.5)])
def test_duration(spark, text, seconds):
    assert one(spark, T.duration(F.col("d")), d=text) == dt.timedelta(seconds=seconds)


def test_minutes_or_duration(spark):
    assert one(spark, T.minutes_or_duration(F.col("d")), d=" 90 ") == dt.timedelta(minutes=90)
    assert one(spark, T.minutes_or_duration(F.col("d")), d="hours=3") == dt.timedelta(hours=3)


def test_time_texts(spark):
    a, b = T.moment("2024-05-16 13:14:15.123"), T.moment("2024-05-14 11:00:00")
    assert one(spark, T.stamp(a)) == "20240516131415"
    assert one(spark, T.iso_millis(a, "+03:00")) == "2024-05-16T13:14:15.123+03:00"
    assert one(spark, T.elapsed_text(a, b)) == "2 d 02:14" and one(spark, T.elapsed_text(a, a)) == "00:00"
    assert one(spark, T.day_window_start(a, 3)) == dt.datetime(2024, 5, 13)


@pytest.mark.parametrize("value,base,want", [
    (0, 1024, "0 B"), (None, 1024, "0 B"), (512, 1024, "512.0 B"), (1024, 1024, "1.0 KB"), (1536, 1024, "1.5 KB"), (-1048576, 1024, "-1.0 MB"), (1152, 1024, "1.12 KB"),
    (999, 1000, "999.0"), (0, 1000, "0"), (1500, 1000, "1.5 тыс"), (2_000_000, 1000, "2.0 млн"), (3 * 10**9, 1000, "3.0 млрд")])
def test_readable_size(spark, value, base, want):
    assert one(spark, N.readable_size(F.lit(value).cast("bigint"), base)) == want


def test_numbers(spark):
    assert N.size_bytes("100 MB") == 100 * 1024**2 and N.size_bytes("") is None and N.size_bytes(7) == 7
    assert one(spark, N.share(F.lit(1), F.lit(3))) == 33 and one(spark, N.share(F.lit(1), F.lit(0))) is None
    assert one(spark, N.ceil_div(F.lit(7), F.lit(3))) == 3


@pytest.mark.parametrize("path,want", [
    ("s3_in://b/a/b/c.csv", ("s3_in", "b", "a/b/c.csv", "a/b/", "c.csv", "c", ".csv", False)), ("c://b/a/x*/y?.csv.gz", ("c", "b", "a/x*/y?.csv.gz", "a/", "x*/y?.csv.gz", "x*/y?.csv", ".gz", True)),
    ("c://b/*.zip", ("c", "b", "*.zip", "", "*.zip", "*", ".zip", True)), ("c://b/f", ("c", "b", "f", "", "f", "f", "", False)), ("c://b/d/.done", ("c", "b", "d/.done", "d/", ".done", ".done", "", False))])
def test_parse_path(spark, path, want):
    assert tuple(one(spark, P.parse_path(F.col("p")), p=path))[1:] == want


def test_names(spark):
    assert one(spark, P.target_key(F.lit("in/a/in/f.csv"), F.lit(".csv"), F.lit("in/"), F.lit("t/"), T.moment("2024-01-02 03:04:05"))) == "t/a/in/f 2024-01-02 03:04:05.csv"
    assert one(spark, X.table_from_file(F.lit("a/b/tab_1 2024:x.csv"))) == "tab_1"
    assert one(spark, X.ascii_name(F.lit("x#Имя Entity one "), F.lit(5))) == "Entity one" and one(spark, X.ascii_name(F.lit("x#Имя"), F.lit(5))) == "5"
    assert one(spark, X.file_name_ok(F.lit("a-b_1.zip"))) and not one(spark, X.file_name_ok(F.lit("A.zip"))) and not one(spark, X.file_name_ok(F.lit("a" * 241)))
    assert one(spark, X.matches_glob(F.lit("a/b/c.x"), "a/*.?")) and not one(spark, X.matches_glob(F.lit("a/b/cx"), "a/*.?"))
    assert one(spark, X.without_prefixes(F.lit("loadX1"), ["load_"])) and not one(spark, X.without_prefixes(F.lit("load_1"), ["load_"]))
    assert one(spark, P.packed(F.lit("a.ZIP"))) and not one(spark, P.packed(F.lit("a.csv")))


@pytest.mark.parametrize("log,want", [
    ("", ("", "{}", "")), ("{'a': 1, 'b': None}", ("", '{"a": 1, "b": null}', "")), ("RUN {'try': True}", ("RUN", '{"try": true}', "")), ("TFS no files here", ("TFS", "{}", "no files here")),
    ("END", ("END", "{}", "")), ("123", ("", "123", ""))])
def test_parse_log(spark, log, want):
    assert tuple(one(spark, J.parse_log(F.col("l")), l=log)) == want


def test_json_helpers(spark):
    assert one(spark, J.outer_object(F.lit("x {'a': {'b': 1}} y"))) == '{"a": {"b": 1}}' and one(spark, J.outer_object(F.lit("none"))) is None
    entries = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(v).alias("value")) for k, v in (("b", 1), ("a", 2), ("b", 3))])
    assert one(spark, J.last_wins_map(entries)) == {"a": 2, "b": 3}


def test_array_text(spark):
    data = F.array(F.lit("a"), F.lit("b,c"), F.lit('q"\\'), F.lit(""), F.lit(None), F.lit("null"))
    assert one(spark, X.array_text(data, "string", "pg")) == '{a,"b,c","q\\"\\\\","",NULL,"null"}'
    assert one(spark, X.array_text(F.array(F.lit("a'b\n"), F.lit("c")), "string", "ch")) == "['a\\'b\\n','c']"
    assert one(spark, X.array_text(F.array(F.lit(1), F.lit(2)), "int", "pg")) == "{1,2}" and one(spark, X.array_text(F.lit(None).cast("array<int>"), "int", "ch")) is None


DIALECTS = [
    DL.Dialect(), DL.Dialect(delimiter=",", quoting=DL.MINIMAL, doublequote=True, escapechar=None), DL.Dialect(delimiter=";", quoting=DL.ALL, doublequote=True, escapechar=None),
    DL.Dialect(delimiter=",", quoting=DL.NONNUMERIC, doublequote=True, escapechar=None), DL.Dialect(delimiter="\t", quoting=DL.MINIMAL, doublequote=False, escapechar="\\"),
]


@pytest.mark.parametrize("dialect", DIALECTS)
def test_dialects_match_the_csv_format(spark, dialect):
    data = [(1, "plain", 1.5), (2, 'q"uote, ; tab\t new\nline \\ back №', None), (3, "", 2.0), (4, "x;y", -1.0)]
    frame = spark.createDataFrame(data, "id int, s string, d double").coalesce(1)
    got = [r.value for r in DL.as_lines(frame, dialect).collect()]
    want = []
    for row in data:
        out = io.StringIO()
        csv.writer(out, delimiter=dialect.delimiter, lineterminator="\n", quotechar='"', quoting=dialect.quoting, escapechar=dialect.escapechar, doublequote=dialect.doublequote).writerow(row)
        want.append(out.getvalue()[:-1])
    assert got == want


def test_sanitize(spark):
    frame = spark.createDataFrame([(1, "a\tb", ["x\ty"])], "id int, s string, a array<string>")
    rules = [(r"\t", "~"), ("~b", "!")]
    assert tuple(X.sanitize_frame(frame, rules).first()) == (1, "a!", ["x\ty"])
    assert tuple(X.sanitize_frame(frame, rules, arrays=True).first()) == (1, "a!", ["x~y"])
    assert one(spark, X.digit_set(F.lit(" 7, x,3,3,-1,"))) == "3,7"
