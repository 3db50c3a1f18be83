import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custodia.operators.insights import first_per_group, fixed_sample
from custodia.session import CHECKPOINT_CONF, fresh_path, shared_dir
from custodia.sources import snapshots
from custodia.sources.tables import literal_rows, read_csv

SCHEMA = T.StructType([T.StructField("id", T.DoubleType()), T.StructField("name", T.StringType()), T.StructField("day", T.DateType())])


def test_csv_skips_one_header_line_per_file(spark, tmp_path):
    for i in range(2):
        (tmp_path / f"f{i}.csv").write_text(f'id,name,day\n{i},"a, b",2024-01-0{i + 1}\n{i}.5,,\n')
    rows = read_csv(spark, str(tmp_path), SCHEMA).orderBy("id").collect()
    assert [r["id"] for r in rows] == [0.0, 0.5, 1.0, 1.5]
    assert rows[0]["name"] == "a, b" and rows[1]["name"] is None and rows[2]["day"].day == 2


def test_csv_rejects_malformed_values(spark, tmp_path):
    (tmp_path / "f.csv").write_text("id,name,day\nnot-a-number,a,2024-01-01\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        read_csv(spark, str(tmp_path), SCHEMA).collect()


def test_snapshots(spark):
    one, two = spark.range(3), spark.range(5)
    stored = snapshots.write_snapshot(one, "s")
    assert stored.count() == 3
    path = fresh_path(spark, "named")
    assert snapshots.create_if_absent(one, path).count() == 3
    assert snapshots.create_if_absent(two, path).count() == 3
    assert snapshots.replace_snapshot(two, path).count() == 5


def test_replace_survives_a_failed_write(spark):
    """The old table stays until the new one is whole, and may be what the new one is computed from."""
    path = fresh_path(spark, "named")
    with pytest.raises(ValueError):
        snapshots.read_current(spark, path)
    old = snapshots.replace_snapshot(spark.range(4), path)
    bad = spark.range(100, numPartitions=8).select((F.lit(1) / F.when(F.col("id") == 77, 0).otherwise(1)).alias("id"))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO|zero"):
        snapshots.replace_snapshot(bad, path)
    assert snapshots.read_current(spark, path).count() == 4
    more = snapshots.replace_snapshot(snapshots.read_current(spark, path).union(spark.range(3)), path)
    assert snapshots.read_current(spark, path).count() == more.count() == 7 and old.count() == 4
    assert snapshots.create_if_absent(spark.range(1), path).count() == 7


@pytest.mark.parametrize("through_hadoop", [False, True])
def test_claims_are_written_once(spark, monkeypatch, through_hadoop):
    from concurrent.futures import ThreadPoolExecutor

    from custodia.sources import claims

    if through_hadoop:
        monkeypatch.setattr(claims, "_local", lambda path: None)
    log = claims.Claims(spark, fresh_path(spark, "claims"))
    assert log.numbers() == [] and log.put(1, {"who": "a"}) and not log.put(1, {"who": "b"})
    assert log.records() == [{"who": "a"}]
    if not through_hadoop:  # the local rename of Hadoop is no atomic one
        with ThreadPoolExecutor(8) as pool:
            won = list(pool.map(lambda i: log.put(2, {"who": i}), range(32)))
        assert sum(won) == 1 and log.read(2) == {"who": won.index(True)}
    versions = claims.Versions(spark, fresh_path(spark, "versions"))
    first = versions.create(spark.range(2))
    assert versions.create(spark.range(3)) == first
    second = versions.replace(spark.range(3), expected=first)
    with pytest.raises(RuntimeError):
        versions.replace(spark.range(9), expected=first)
    assert versions.current() == second


def test_insert_update_delete(spark):
    table = spark.createDataFrame([(1, "a"), (2, None)], "id bigint, x string")
    more = snapshots.insert_rows(table, spark.createDataFrame([(3,)], "id int"))
    assert [tuple(r) for r in more.orderBy("id").collect()] == [(1, "a"), (2, None), (3, None)]
    with pytest.raises(ValueError):
        snapshots.insert_rows(table, spark.createDataFrame([(3,)], "nope int"))
    filled = snapshots.update_where(more, {"x": F.lit("new")}, F.col("x").isNull())
    assert [r["x"] for r in filled.orderBy("id").collect()] == ["a", "new", "new"]
    unknown = snapshots.update_where(more, {"x": F.lit("new")}, F.col("x") == "a")
    assert [r["x"] for r in unknown.orderBy("id").collect()] == ["new", None, None]
    assert [r["id"] for r in snapshots.delete_where(more, F.col("x") == "a").orderBy("id").collect()] == [2, 3]


def test_add_column_if_absent(spark):
    df = snapshots.add_column_if_absent(spark.range(1), "note", T.StringType())
    assert df.columns == ["id", "note"]
    assert snapshots.add_column_if_absent(df, "NOTE", T.StringType()).columns == ["id", "note"]


def test_literal_rows(spark):
    df = literal_rows(spark, [("a", 1), (None, None)], "x string, y bigint")
    assert df.schema.simpleString() == "struct<x:string,y:bigint>" and df.count() == 2
    assert literal_rows(spark, [], "x string, y double").count() == 0


def test_shared_dir_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get(CHECKPOINT_CONF)
    assert fresh_path(spark, "x").startswith(shared_dir(spark))
    assert fresh_path(spark, "x") != fresh_path(spark, "x")


def test_first_per_group_and_sample(spark):
    df = spark.range(1000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 0 ELSE id % 7 END AS g")
    got = {r["g"]: r["id"] for r in first_per_group(df, ["g"], ["id"]).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 4: 4, 5: 5, 3: 10, 6: 13}
    a = {r["id"] for r in fixed_sample(df, F.col("id"), 50, "s").collect()}
    b = {r["id"] for r in fixed_sample(df.repartition(7), F.col("id"), 50, "s").collect()}
    c = {r["id"] for r in fixed_sample(df, F.col("id"), 50, "t").collect()}
    assert a == b and len(a) == 50 and a != c
    assert fixed_sample(df.limit(10), F.col("id"), 50, "s").count() == 10
