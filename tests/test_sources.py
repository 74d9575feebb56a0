"""Readers, writers and the incremental resume."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.config.schemas import BOOK_SCHEMA, DROPPED_HEADERS, LEGACY_HEADERS, SERIES_SCHEMA
from shelfmark.operators.schema import align_to_schema, repair_header, schema_diff
from shelfmark.sources import readers, writers
from shelfmark.streaming.incremental import append_new_files


def test_schemas():
    assert len(BOOK_SCHEMA) == 24 and len(SERIES_SCHEMA) == 49


def test_first_existing_csv(spark, tmp_path):
    (tmp_path / "b.csv").write_text("Book Series Name,Author Email,Unnamed: 3,Books in Series\nSaga,a@b.net,x,3\n")
    df = readers.read_first_existing(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    df = align_to_schema(repair_header(df, LEGACY_HEADERS, DROPPED_HEADERS), SERIES_SCHEMA)
    row = df.first()
    assert (row["Book Series Name"], row["Email"], row["Books in Series"]) == ("Saga", "a@b.net", 3)
    assert schema_diff(df, SERIES_SCHEMA) == {"missing": [], "extra": []}


def test_malformed_lines_are_skipped(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,2\n3,4,5\n6,7\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    assert sorted(r["a"] for r in readers.read_csv(spark, str(tmp_path / "x.csv"), schema).collect()) == [1, 6]


def test_multiheader(spark, tmp_path):
    (tmp_path / "m.csv").write_text('"Series, Long",,Publishers\nBook Series Name,Author Name,Publisher\nSaga,Ann,Oak\n,,\n,Bob,Oak\n')
    rows = readers.read_multiheader_csv(spark, str(tmp_path / "m.csv")).collect()
    assert [tuple(r) for r in rows] == [("Saga", "Ann", "Oak")]
    (tmp_path / "n.csv").write_text("Book Series Name,Author Name\nSaga,Ann\n")
    assert readers.read_multiheader_csv(spark, str(tmp_path / "n.csv")).columns == ["Book Series Name", "Author Name"]


def test_repaired_lines(spark, tmp_path):
    lines = ["a,b"]
    want = ["a,b"]
    for i in range(400):
        if i % 7 == 0:
            lines += [f'{i},"start', "middle", 'end"']
            want.append(f'{i},"start middle end"')
        else:
            lines.append(f"{i},x")
            want.append(f"{i},x")
    (tmp_path / "r.csv").write_text("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        got = [r["line"] for r in readers.repaired_lines(spark, str(tmp_path / "r.csv")).orderBy("start").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(got) == sorted(want)


def test_sheets(spark, tmp_path):
    (tmp_path / "one.csv").write_text("a,b\n1,2\n")
    (tmp_path / "two.csv").write_text("a,c\n3,4\n")
    df = readers.read_sheets(spark, {"one": str(tmp_path / "one.csv"), "two": str(tmp_path / "two.csv")})
    assert {(r["sheet"], r["a"], r["b"], r["c"]) for r in df.collect()} == {("one", "1", "2", None), ("two", "3", None, "4")}


def test_contact_caches(spark, tmp_path):
    (tmp_path / "seed.json").write_text('{"Ann Lee": {"email": "old@x.net"}, "bob": {"email": "b@x.net"}}')
    (tmp_path / "new.json").write_text('{"ann lee ": {"email": "new@x.net", "website": "https://a.net"}}')
    rows = readers.load_contact_caches(spark, [str(tmp_path / "seed.json"), str(tmp_path / "new.json")]).collect()
    assert {(r["author_key"], r["email"]) for r in rows} == {("ann lee", "new@x.net"), ("bob", "b@x.net")}


def test_partitioned_output_is_sorted(spark, tmp_path):
    df = spark.range(500).select(F.col("id"), F.when(F.col("id") < 300, "Dark & Forbidden").otherwise("Other/Thing").alias("genre"), (F.col("id") * 37 % 101).alias("score"))
    writers.write_partitioned(df, str(tmp_path / "out"), "genre", "score", "id")
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 500
    assert {r["slug"] for r in back.select("slug").distinct().collect()} == {"dark_and_forbidden", "other_and_thing"}
    for folder in (tmp_path / "out").glob("slug=*"):
        for file in folder.glob("*.parquet"):
            scores = [r["score"] for r in spark.read.parquet(str(file)).collect()]
            assert scores == sorted(scores, reverse=True)


def test_versions_and_sheets(spark, tmp_path):
    df = spark.range(3)
    one = writers.save_version(df, str(tmp_path / "t"))
    two = writers.save_version(df.union(df), str(tmp_path / "t"))
    assert one != two and spark.read.parquet(one).count() == 3 and spark.read.parquet(two).count() == 6
    writers.write_sheets({"a": df, "b": df.limit(1)}, str(tmp_path / "s"))
    assert spark.read.option("header", True).csv(str(tmp_path / "s" / "b")).count() == 1


def test_a_save_that_stops_leaves_the_old_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    assert writers.current_version(spark, path) is None
    with pytest.raises(FileNotFoundError):
        writers.read_version(spark, path)
    writers.save_version(spark.range(3), path, "1")

    def stop(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(writers, "write_pointer", stop)  # the table is written, its name is not
        with pytest.raises(KeyboardInterrupt):
            writers.save_version(spark.range(9), path, "2")
    assert (tmp_path / "t" / "v=2").exists() and writers.read_version(spark, path).count() == 3
    assert writers.save_version(spark.range(4), path, "3") == writers.current_version(spark, path)
    assert writers.read_version(spark, path).count() == 4


def test_append_missing_resumes(spark, tmp_path):
    path = str(tmp_path / "o")
    writers.append_missing(spark.range(5), path, ["id"])
    writers.append_missing(spark.range(8), path, ["id"])
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == list(range(8))


def test_stream_appends_every_key_once(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k long, v string").write.parquet(source)
    schema = "k long, v string"

    def run():
        stream = spark.readStream.schema(schema).parquet(source)
        append_new_files(stream, out, ["k"], [F.col("v")], str(tmp_path / "cp")).awaitTermination()

    run()
    spark.createDataFrame([(2, "x"), (3, "y")], schema).write.mode("append").parquet(source)
    run()
    assert sorted(tuple(r) for r in spark.read.parquet(out).collect()) == [(1, "a"), (2, "c"), (3, "y")]


def test_existing_keys(spark):
    df = spark.createDataFrame([("The Deal!", "Elle K."), ("", "x")], "s string, a string")
    assert {r["key"] for r in readers.existing_keys([(df, "s", "a")]).collect()} == {"the deal|||elle k", "the deal"}
