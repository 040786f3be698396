from pathlib import Path

from pyspark.sql import functions as F

from conftest import rows
from costlake.operators.dedupe import dedupe_rows
from costlake.operators.lookups import keep_directories, left_lookup, measured_bytes
from costlake.operators.splits import first_rows
from costlake.session import shuffle_width, shuffles_of
from costlake.sources.storage import total_bytes


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_keeps_the_first_in_order(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 3)], "k STRING, v INT")
    assert rows(dedupe_rows(df, ["k"], [F.col("v").asc()])) == [("a", 1), ("b", 3)]
    assert rows(dedupe_rows(df, ["k"]).select("k")) == [("a",), ("b",)]


def test_dedupe_shrinks_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE string(id) END AS k", "id AS v")
    ordered = plan(dedupe_rows(df, ["k"], [F.col("v").asc()]))
    assert "Partial" in ordered[ordered.index("Exchange") :]
    assert "partial_first" in plan(dedupe_rows(df, ["k"]))
    assert dedupe_rows(df, ["k"]).count() == 667


def test_null_keys_form_one_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2)], "k STRING, v INT")
    assert dedupe_rows(df, ["k"]).count() == 1


def hot_facts(spark):
    return spark.range(3000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE string(id % 50) END AS k"
    )


def test_lookup_paths_agree(spark):
    lookup = spark.range(40).selectExpr("CASE WHEN id = 0 THEN 'hot' ELSE string(id) END AS k", "id AS attribute")
    small = left_lookup(hot_facts(spark), lookup, "k", "id")
    assert "BroadcastHashJoin" in plan(small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = left_lookup(hot_facts(spark), lookup, "k", "id", limit_bytes=0, slices=8)
        assert "SortMergeJoin [k" in plan(large) and "_slice" in plan(large)
        assert rows(small) == rows(large)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert small.count() == 3000


def test_a_repeated_lookup_is_never_broadcast(spark, folder):
    """The file of a big lookup may be smaller than Spark's own limit for broadcasts."""
    spark.range(500).selectExpr("'k' || id AS k", "'same' AS name").write.parquet(folder + "/lookup")
    found = left_lookup(hot_facts(spark), spark.read.parquet(folder + "/lookup"), "k", "id", limit_bytes=0, slices=8)
    assert "Broadcast" not in plan(found) and "SortMergeJoin [k" in plan(found)
    assert found.count() == hot_facts(spark).count()
    assert "Broadcast" not in plan(found)


def test_measured_bytes(spark):
    df = spark.createDataFrame([("abc", 1), (None, 2)], "t STRING, n INT")
    assert measured_bytes(df) == 2 * 2 * 16 + 3
    assert measured_bytes(df.limit(0)) == 0
    assert measured_bytes(df.select(F.array("n"))) is None


def test_keep_directories(spark, folder):
    table = spark.range(60).selectExpr("id", "id % 3 AS p", "id % 5 AS q")
    table.write.partitionBy("p", "q").parquet(f"{folder}/t")
    stored = spark.read.parquet(f"{folder}/t")
    wanted = spark.createDataFrame([(0, 1), (2, 4), (2, 4)], "p INT, q INT")
    expected = [(i,) for i in range(60) if (i % 3, i % 5) in {(0, 1), (2, 4)}]
    for limit in (10, 1):
        assert rows(keep_directories(stored, wanted, ["p", "q"], limit).select("id")) == expected
    one = keep_directories(stored, wanted, ["p"])
    assert rows(one.select("p").distinct()) == [(0,), (2,)]
    assert "Join" not in plan(one) and "p#" in plan(one)[plan(one).index("PartitionFilters") :]
    assert keep_directories(stored, wanted.limit(0), ["p", "q"]).isEmpty()


def test_first_rows(spark):
    df = spark.range(100).selectExpr("99 - id AS id")
    assert rows(first_rows(df, 3, ["id"])) == [(0,), (1,), (2,)]


def test_shuffle_width():
    assert shuffle_width(0) == 200
    assert shuffle_width(100 * 2**30) == 400
    assert shuffle_width(100 * 2**40) == 50_000


def test_shuffles_of_restores_the_width(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        with shuffles_of(spark, 3):
            assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
            raise KeyError
    except KeyError:
        pass
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_total_bytes(spark, folder):
    (Path(folder) / "inner").mkdir()
    for name, size in [("a", 3), ("inner/b", 4)]:
        (Path(folder) / name).write_bytes(b"x" * size)
    assert total_bytes(spark, folder) == 7
