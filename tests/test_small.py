"""Small columns and readers that no query shows."""

from pyspark.sql import functions as F

from cantilena.functions import text as T
from cantilena.operators import relational as R
from cantilena.sources import files


def row(spark, **columns):
    return spark.range(1).select(*[c.alias(k) for k, c in columns.items()]).first()


def test_database_table(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    spark.createDataFrame([(1, "he"), (2, "en")], "id long, lang string").write.mode("overwrite").jdbc(url, "sessions", properties={"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    got = files.jdbc_table(spark, url, "sessions", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    assert [tuple(r) for r in got.where("id = 1").collect()] == [(1, "he")]


def test_work_that_is_left(spark):
    exists = [True, False, None]
    df = spark.createDataFrame([(x,) for x in exists], "x boolean")
    assert [r[0] for r in df.select(R.needs_work(F.col("x"))).collect()] == [False, True, True]
    assert all(r[0] for r in df.select(R.needs_work(F.col("x"), force=True)).collect()) and all(r[0] for r in df.select(R.needs_work(F.col("x"), rescore=True)).collect())


def test_curated_rows(spark):
    rows = [(1, None, None, "a"), (2, True, None, "a"), (3, False, ["retranscribe"], "a"), (4, False, ["x"], "b"), (5, False, [], "t"), (6, None, None, "gone")]
    df = spark.createDataFrame(rows, "id long, skipped boolean, attributes array<string>, source string")
    ids = lambda split, **how: sorted(r["id"] for r in R.curated(df, test_sources=["t"], split=split, **how).collect())
    assert ids("train", drop_source="gone") == [1, 4] and ids("test", drop_source="gone") == [5] and ids("train", drop_source=None) == [1, 4, 6]


def test_small_columns(spark):
    got = row(spark, one=T.is_mono(F.lit(1)), two=T.is_mono(F.lit(2)), none=T.is_mono(F.lit(None).cast("int")), day=T.compact_date(F.lit("20240131")).cast("string"), now=T.compact_date(F.lit("no date")).isNotNull(), near=T.seconds_to_frames_nearest(F.lit(0.031)), held=T.seconds_to_frame(F.lit(0.031)))
    assert (got["one"], got["two"], got["none"], got["near"], got["held"]) == (True, False, False, 2, 1)
    assert got["day"].startswith("2024-01-31") and got["now"]
    clamp = lambda a, b, high: T.clamp_range(F.lit(a), F.lit(b), F.lit(2.0), F.lit(high).cast("double"))
    for (a, b, high), want in {(0.0, 1.0, 6.0): (2.0, 2.0), (4.0, 9.0, 6.0): (4.0, 6.0), (8.0, 9.0, 6.0): (6.0, 6.0), (5.0, 3.0, None): (5.0, 5.0)}.items():
        lo, hi = clamp(a, b, high)
        assert tuple(row(spark, a=lo, b=hi)) == want
