"""Cameras of orders where customers' keys go beyond 100000, as in larger tables."""

import duckdb

import __spark_entry__


def test_a_spare_camera_is_no_customer(spark, tmp_path):
    spark.createDataFrame([(1, 5), (2, 100_005), (3, 7), (4, None)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(5,), (100_005,), (100_007,)], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    got = {tuple(r) for r in __spark_entry__.queries()["a18_task_epochs"](spark, str(tmp_path)).collect()}
    db = duckdb.connect()
    for name in ("orders", "customer"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    assert got == set(db.execute(__spark_entry__.oracle_sql()["a18_task_epochs"]).fetchall()) == {(1, "5"), (2, "100005"), (3, None), (4, None)}
