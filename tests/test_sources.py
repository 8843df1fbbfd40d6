"""File sources, sinks, runners."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from lakeops.plans import medallion
from lakeops.plans.catalog.medallion import write_json_arrays
from lakeops.plans.runner import run_queries, run_stages, run_together
from lakeops.sources import files


def test_quotes_commas_and_edge_spaces_survive(spark, tmp_path):
    value = ' 12" "wide", blue '
    df = spark.createDataFrame([(value, 3.5)], "product_name string, sales double")
    files.write_csv(df, str(tmp_path / "q"))
    back = files.read_csv(spark, str(tmp_path / "q"), infer=True)
    assert back.first().asDict() == {"product_name": value, "sales": 3.5}


def test_header_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Order ID` int, `Sub-Category` int, ` Profit ` int")
    assert files.normalize_columns(df).columns == ["order_id", "sub_category", "profit"]
    assert files.normalize_columns(df, lower=False).columns == ["Order_ID", "Sub_Category", "Profit"]


def test_resolve_column(spark):
    df = spark.createDataFrame([(1,)], "discount int")
    assert df.select(files.resolve_column(df, "discount_pct", "discount")).first()[0] == 1
    with pytest.raises(ValueError):
        files.resolve_column(df, "x", "y")


def test_missing_format_falls_back_and_real_failures_do_not(spark, tmp_path):
    df = spark.range(3)
    files.write_table(df, str(tmp_path / "t"), fmt="delta")
    assert files.read_table(spark, str(tmp_path / "t"), fmt="delta").count() == 3
    assert files.table_format(spark, "parquet") == "parquet"
    with pytest.raises(Exception):
        files.read_table(spark, str(tmp_path / "absent"), fmt="parquet").count()


def test_load_order_is_the_file_order(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("k,v\nx,1\ny,2\nx,3\n")
    (tmp_path / "in" / "b.csv").write_text("k,v\nx,0\n")
    files.with_load_order(files.read_csv(spark, str(tmp_path / "in"))).write.parquet(str(tmp_path / "bronze"))
    rows = spark.read.parquet(str(tmp_path / "bronze")).orderBy("seq").collect()
    assert [(r.k, r.v) for r in rows] == [("x", "1"), ("y", "2"), ("x", "3"), ("x", "0")]


def test_gated_copy(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    assert files.copy_csv(spark, source, target) is False
    files.write_csv(spark.range(4), source)
    assert files.copy_csv(spark, source, target) is True
    assert files.read_csv(spark, target).count() == 4


def test_runner_selects_counts_and_rejects(spark, tmp_path):
    queries = {"r01_a": lambda: spark.range(3), "r02_b": lambda: spark.range(5)}
    assert run_queries(queries, str(tmp_path)) == {"r01_a": 3, "r02_b": 5}
    assert run_queries(queries, str(tmp_path), select=["r02"]) == {"r02_b": 5}
    with pytest.raises(ValueError):
        run_queries(queries, str(tmp_path), select=["r09"])


def test_stages_keep_their_order():
    seen = []
    stages = {name: (lambda n=name: seen.append(n)) for name in ("clean", "load", "report")}
    assert run_stages(stages, ["report", "clean"]) == ["clean", "report"] and seen == ["clean", "report"]
    with pytest.raises(ValueError):
        run_stages(stages, ["clean", "paint"])


def test_steps_run_side_by_side_and_all_end_before_a_failure_shows():
    meet, ended = threading.Barrier(2, timeout=20), []

    def fail():
        meet.wait()
        raise ValueError("broken")

    def last():
        meet.wait()
        ended.append("last")

    with pytest.raises(ValueError, match="broken"):
        run_together([fail, last])
    assert ended == ["last"]


def test_queries_run_side_by_side_and_keep_their_order(spark, tmp_path):
    meet = threading.Barrier(2, timeout=20)

    def query(rows):
        meet.wait()
        return spark.range(rows)

    counts = run_queries({"a": lambda: query(3), "b": lambda: query(5)}, str(tmp_path), at_once=2)
    assert list(counts.items()) == [("a", 3), ("b", 5)]
    assert run_together([lambda: 1, lambda: 2]) == [1, 2] == run_together([lambda: 1, lambda: 2], at_once=1)


def test_json_arrays_are_one_file_each_in_one_folder(spark, tmp_path):
    path = str(tmp_path / "people")
    people = spark.range(1, 46).selectExpr("CAST(id AS STRING) AS customer_id", "concat(' n', id) AS name")
    write_json_arrays(people, "customer_id", path, 20)
    parts = [f for f in (tmp_path / "people").iterdir() if f.name.startswith("part")]
    assert len(parts) == 3 and all(f.is_file() for f in parts)
    back = files.read_json_array(spark, path, recursive=True)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, people.collect()))


def test_order_totals_are_exact_sums_of_their_lines(spark):
    raw = spark.createDataFrame([("1", "a"), ("2", "a"), ("3", "a")], "order_id string, customer_id string").selectExpr(
        "*", "'2024-01-01' AS order_date", "'x' AS city", "'y' AS payment_mode", "'z' AS status"
    )
    lines = spark.createDataFrame(
        [("1", "99999999.99", "0.01"), ("1", "99999999.99", None), ("1", "-0.05", "0.10"), ("2", None, None)],
        "order_id string, net string, less string",
    ).selectExpr("order_id", "CAST(net AS DECIMAL(10,2)) AS net_price", "CAST(less AS DECIMAL(10,2)) AS discount_amount")
    silver = medallion.silver_orders(raw, lines)
    assert dict(silver.dtypes)["order_total"] == "decimal(18,2)"
    found = {r.order_id: (str(r.order_total), str(r.total_discount)) for r in silver.collect()}
    assert found == {"1": ("199999999.93", "0.11"), "2": ("0.00", "0.00"), "3": ("0.00", "0.00")}


@pytest.fixture()
def landing(tmp_path):
    """Two days of orders, one of them delivered late, with personal data in JSON."""
    for folder, name, text in [
        ("orders", "d1.csv", "order_id,customer_id,order_date,city,payment_mode,status\n"
                             "O1,C1,2024-04-11 09:00:00, Pune ,UPI, Delivered\nO2,C1,2024-04-11 10:00:00,Pune,UPI,cancelled\n"),
        ("orders", "d2.csv", "order_id,customer_id,order_date,city,payment_mode,status\n"
                             "O3,,2024-04-12 09:00:00,Pune,UPI,returned\nO1,C1,2024-04-11 09:00:00, Pune ,UPI, Delivered\n"),
        ("order_items", "d1.csv", "item_id,order_id,product_id,product_name,category,qty,unit_price,discount\n"
                                  "I1,O1,P1,Tea,Dry,2,10.00,5\nI2,O1,P2,Rice,Dry,1,7.55,\nI3,O3,P1,Tea,Dry,4,10.00,0\n"),
        ("delivery", "d1.csv", "delivery_id,order_id,rider_id,pickup_time,delivery_time,zone,dist_km,status\n"
                               "D1,O1,R1,2024-04-11 09:00:00,2024-04-11 09:30:30, East ,2.5,Success\n"
                               "D2,O3,R1,2024-04-12 09:00:00,,East,1.5,failed\n"),
        ("customers", "customers.json", '[{"customer_id":"C1","name":" Ana ","email":" A@B.co ","phone":"1 ","city":"Pune",'
                                        '"registered_on":"2024-01-02","loyalty_points":"7"},\n {"customer_id":"C2","name":"Bo",'
                                        '"email":"b@c.de","phone":"2","city":"Pune","registered_on":"x","loyalty_points":"y"}]'),
    ]:
        (tmp_path / "raw" / folder).mkdir(parents=True, exist_ok=True)
        (tmp_path / "raw" / folder / name).write_text(text)
    return tmp_path


def test_medallion_from_files_to_gold(spark, landing):
    lake = str(landing / "lake")
    assert run_stages(medallion.stages(spark, str(landing / "raw"), lake)) == ["bronze", "silver", "gold"]

    def read(name):
        return files.read_table(spark, f"{lake}/{name}")

    bronze = read("bronze/raw_orders")
    assert bronze.count() == 4 and {"_ingested_date", "_source_file"} <= set(bronze.columns)
    people = read("silver/customers")
    assert {"email", "phone"}.isdisjoint(people.columns)
    assert people.filter(F.length("email_hash") == 64).count() == 2
    orders = {r.order_id: r for r in read("silver/orders").collect()}
    assert set(orders) == {"O1", "O2", "O3"}
    assert (float(orders["O1"].order_total), float(orders["O1"].total_discount)) == (26.55, 1.0)
    assert float(orders["O2"].order_total) == 0.0 and orders["O1"].status == "delivered"
    trips = {r.delivery_id: r for r in read("silver/delivery_logs").collect()}
    assert trips["D1"].delivery_duration_mins == 30.5 and trips["D1"].is_incomplete is False
    assert trips["D2"].is_incomplete is True and trips["D2"].delivery_duration_mins is None
    products = {r.product_id: r for r in read("gold/product_return_summary").collect()}
    assert (products["P1"].total_units_sold, products["P1"].returned_units, products["P1"].return_rate_pct) == (6, 4, 66.67)
    zone = read("gold/delivery_zone_performance").first()
    assert (zone.zone, zone.failed_deliveries, zone.failure_rate_pct, zone.avg_distance_km) == ("East", 1, 50.0, 2.0)
    summary = {r.customer_id: r for r in read("gold/customer_summary").collect()}
    assert (summary["C1"].total_orders, float(summary["C1"].total_spend)) == (1, 26.55)
    assert (summary["C2"].total_orders, summary["C2"].last_order_date) == (0, None)
