"""Every query against its SQL in another engine, and the contract of the entry point."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_point
from rangemap.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def same(v):
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v + 0.0:.7g}"
    return str(v)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(same(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_its_sql(spark, sf, oracle, name):
    df = entry_point.queries()[name](spark, sf)
    found = oracle.execute(catalog.ORACLE_SQL[name])
    want = table([d[0] for d in found.description], found.fetchall())
    assert table(df.columns, [tuple(r) for r in df.collect()]) == want


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_other_queries_give_rows(spark, sf, name):
    assert entry_point.queries()[name](spark, sf).count() > 0


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def test_pushdown(spark, sf):
    from rangemap.sources.tables import within_box

    df = within_box(spark.read.parquet(f"{sf}/lineitem.parquet"), (1, 1, 5, 5), ("l_quantity", "l_tax", "l_quantity", "l_tax")).select("l_orderkey")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(l_quantity,1.0)" in plan and "l_comment" not in plan


def test_stream(spark, tmp_path):
    from pyspark.sql import functions as F

    from rangemap.operators import grid, maxent
    from rangemap.streaming import annotate

    spec = grid.GridSpec(0, 100, 10, 10, 10)
    cells = grid.model_grid(spark, spec).select("row", "col", F.col("x").alias("f"))
    rows = [("s_Roost", i, float(i % 100), float(i), int(i % 100 > 60), 1.0, i % 3) for i in range(200)]
    model = maxent.fit_all(spark.createDataFrame(rows, "identifier string, point_id int, f double, g double, class int, sample_weight double, fold int"), ["f"], maxent.Config(kinds=("linear",)))
    spark.createDataFrame([(1, 5.0, 5.0), (2, 95.0, 5.0), (3, 500.0, 5.0)], "point_id int, x double, y double").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("point_id int, x double, y double").parquet(str(tmp_path / "in"))
    q = annotate.write_records(annotate.scored_records(stream, cells, spec, model, ["f"], ["point_id"]), str(tmp_path / "out"), str(tmp_path / "check"))
    q.awaitTermination(120)
    out = {r["point_id"]: r["p"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert set(out) == {1, 2} and out[2] > out[1]


def test_simplify_where_corners_fall_together(spark, tmp_path):
    """Diamonds narrower than the tolerance: the first two corners of some are one place."""
    spark.range(1, 4001).selectExpr("id AS p_partkey", "'b' AS p_brand", "1 AS p_size").write.parquet(str(tmp_path / "part.parquet"))
    spark.range(10).selectExpr("id AS l_orderkey").write.parquet(str(tmp_path / "lineitem.parquet"))
    con = duckdb.connect()
    for t in ("part", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    df = entry_point.queries()["g10_simplify"](spark, str(tmp_path))
    found = con.execute(catalog.ORACLE_SQL["g10_simplify"])
    assert table(df.columns, [tuple(r) for r in df.collect()]) == table([d[0] for d in found.description], found.fetchall())


def test_training_table_of_points_far_apart(spark, tmp_path):
    """The five nearest are farther than the first blocks of the SQL reach."""
    put = lambda name, n, *columns: spark.range(1, n + 1).selectExpr(*columns).write.parquet(str(tmp_path / f"{name}.parquet"))
    put("lineitem", 1596, "id % 42 AS l_partkey", "id DIV 42 AS l_orderkey", "CAST(id % 50 AS DOUBLE) AS l_quantity", "0.05D AS l_discount", "0.02D AS l_tax")
    put("orders", 8, "id * 17 AS o_orderkey", "CAST(id AS DOUBLE) AS o_totalprice")
    put("events", 24, "id * 211 AS event_id", "'a' AS event_type", "2L AS user_id", "1.0D AS value", "TIMESTAMP '2024-01-01 00:00:00' AS ts")
    con = duckdb.connect()
    for t in ("lineitem", "orders", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    df = entry_point.queries()["x9_x10_training_table"](spark, str(tmp_path))
    found = con.execute(catalog.ORACLE_SQL["x9_x10_training_table"])
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) > 15 and table(df.columns, rows) == table([d[0] for d in found.description], found.fetchall())
