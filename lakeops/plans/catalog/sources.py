"""Registered queries: file sources and sinks. Each writes test tables out and reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.plans import cleaning, retail
from lakeops.plans.catalog.medallion import write_json_arrays
from lakeops.plans.catalog.quality import QUALITY_SQL, RAW_NAMES, mail_ok
from lakeops.plans.registry import query
from lakeops.plans.runner import run_queries
from lakeops.session import scratch_path
from lakeops.sources import files, versions
from lakeops.sources.files import store_below

PARTS = "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part"


def _parts_csv(t) -> str:
    path = scratch_path(t.spark, "parts-csv")
    files.write_csv(t.raw("part"), path)
    return path


@query("s01_csv_inferred", PARTS.replace("p_partkey,", "CAST(p_partkey AS INT) AS p_partkey,"))
def s01(t):
    return files.read_csv(t.spark, _parts_csv(t), infer=True)


QUOTED = "p_name || ', 12\" \"wide\"' AS product_name"


@query("s02_csv_quotes_in_fields", f"SELECT p_partkey, {QUOTED}, CAST(p_retailprice AS DOUBLE) AS sales FROM part")
def s02(t):
    path = scratch_path(t.spark, "quoted-csv")
    quoted = F.concat("p_name", F.lit(', 12" "wide"')).alias("product_name")
    files.write_csv(t.raw("part").select("p_partkey", quoted, F.col("p_retailprice").alias("sales")), path)
    read = files.read_csv(t.spark, path, infer=True)
    return read.withColumn("p_partkey", F.col("p_partkey").cast("bigint"))


@query(
    "s03_csv_all_text",
    "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS zip FROM customer",
)
def s03(t):
    path = scratch_path(t.spark, "text-csv")
    zipped = F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("zip")
    files.write_csv(t.raw("customer").select("c_custkey", "c_name", zipped), path)
    return files.read_csv(t.spark, path, columns=["c_custkey", "c_name", "zip"])


@query("s04_csv_latin1", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name || ' Señor Müller' AS c_name FROM customer")
def s04(t):
    path = scratch_path(t.spark, "latin1-csv")
    named = t.raw("customer").select("c_custkey", F.concat("c_name", F.lit(" Señor Müller")).alias("c_name"))
    named.write.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return files.read_csv(t.spark, path, encoding="ISO-8859-1")


@query("s05_csv_many_files", "SELECT order_id, customer_id, order_date, status FROM feed_orders_v")
def s05(t):
    path = scratch_path(t.spark, "many-csv")
    orders = t.view("feed_orders_v").select("order_id", "customer_id", "order_date", "status")
    # A file per folder; empty texts are quoted by the writer and read back as null.
    parted = orders.withColumn("part", F.trim("status")).write.partitionBy("part")
    files.csv_options(parted).option("emptyValue", "").csv(path)
    return files.read_csv(t.spark, path, recursive=True).fillna({"customer_id": ""})


@query("s06_json_arrays", "SELECT customer_id, name, email, phone, city, registered_on, loyalty_points FROM feed_customers_v")
def s06(t):
    path = scratch_path(t.spark, "json")
    write_json_arrays(t.view("feed_customers_v"), "customer_id", path)
    return files.read_json_array(t.spark, path).drop("part")


@query(
    "s07_ingest_metadata",
    "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, true AS has_day, true AS has_file FROM part",
)
def s07(t):
    read = files.with_ingest_metadata(files.read_csv(t.spark, _parts_csv(t)))
    return read.select(
        "p_partkey",
        F.col("_ingested_date").isNotNull().alias("has_day"),
        F.col("_source_file").endswith(".csv").alias("has_file"),
    )


@query(
    "s07_load_order",
    "SELECT COUNT(*) AS rows, COUNT(*) AS places FROM part",
)
def s07_order(t):
    path = scratch_path(t.spark, "placed")
    files.with_load_order(files.read_csv(t.spark, _parts_csv(t))).write.parquet(path)
    return t.spark.read.parquet(path).agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("seq").alias("places")
    )


@query("s08_parquet", "SELECT * FROM supplier")
def s08(t):
    return t.raw("supplier")


@query("s09_read_at_version", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def s09(t):
    root = scratch_path(t.spark, "suppliers")
    suppliers = t.raw("supplier").select("s_suppkey", "s_name", "s_acctbal")
    versions.write_version(suppliers, root, 0, "WRITE")
    versions.write_version(suppliers.withColumn("s_acctbal", F.col("s_acctbal") + 1), root, 1, "UPDATE")
    return versions.read_version(t.spark, root, 0)


@query("s10_csv_sink", "SELECT p_partkey, p_name, p_retailprice FROM part")
def s10(t):
    path = scratch_path(t.spark, "sink-csv")
    files.write_csv(t.raw("part").select("p_partkey", "p_name", "p_retailprice"), path)
    return t.spark.read.schema("p_partkey bigint, p_name string, p_retailprice double").option("header", True).csv(path)


@query("s11_table_sink_with_fallback", PARTS)
def s11(t):
    path = scratch_path(t.spark, "table")
    files.write_table(t.raw("part"), path, fmt="delta")
    return files.read_table(t.spark, path, fmt="delta")


@query("s12_table_load_with_fallback", "SELECT p_partkey, p_brand FROM part")
def s12(t):
    path = scratch_path(t.spark, "table")
    files.write_table(t.raw("part").select("p_partkey", "p_brand"), path, fmt="parquet")
    return files.read_table(t.spark, path, fmt="delta")


@query("s13_header_normalisation", 'SELECT p_partkey AS part_key, p_name AS product_name, p_type AS sub_category FROM part')
def s13(t):
    messy = t.raw("part").select("p_partkey", "p_name", "p_type").toDF("Part-Key ", " Product Name", "Sub-Category")
    return files.normalize_columns(messy)


@query("s14_column_under_drift", "SELECT l_orderkey, l_linenumber, l_partkey, l_discount AS rate FROM lineitem")
def s14(t):
    old = t.raw("lineitem").withColumnRenamed("l_discount", "discount")
    return old.select(
        "l_orderkey", "l_linenumber", "l_partkey", files.resolve_column(old, "discount_pct", "discount").alias("rate")
    )


@query(
    "s15_star_split",
    """
    SELECT 'customers' AS part, COUNT(*) AS rows FROM (SELECT DISTINCT customer_id, customer_name, segment FROM wide_v)
    UNION ALL SELECT 'products', COUNT(*) FROM (SELECT DISTINCT product_id, category, sub_category, product_name FROM wide_v)
    UNION ALL SELECT 'orders', COUNT(*) FROM (SELECT DISTINCT order_id, order_date, customer_id, product_id, line_no,
      sales, quantity, discount, profit FROM wide_v)""",
)
def s15(t):
    split = files.star_split(
        t.wide("order", "customer", "product"),
        {
            "customers": ["customer_id", "customer_name", "segment"],
            "products": ["product_id", "category", "sub_category", "product_name"],
            "orders": ["order_id", "order_date", "customer_id", "product_id", "line_no", "sales", "quantity",
                       "discount", "profit"],
        },
    )
    whole = None
    for name, df in split.items():
        row = df.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("rows"))
        whole = row if whole is None else whole.unionByName(row)
    return whole


TOUCHED = """
    SELECT touched, COUNT(*) AS customers FROM (
      SELECT CASE WHEN c_acctbal >= 5000 THEN 'high' ELSE 'low' END AS touched FROM {customer}) GROUP BY touched"""


@query("s17_sql_over_views", TOUCHED.replace("{customer}", "customer"))
def s17(t):
    return files.query_views(t.spark, TOUCHED, customer=t.raw("customer"))


@query(
    "s18_batch_query_runner",
    """
    SELECT 'r01_revenue_per_category' AS name, COUNT(DISTINCT category) AS rows FROM revenue_v
    UNION ALL SELECT 'r06_return_rate_per_category', COUNT(DISTINCT category) FROM lines_v
    UNION ALL SELECT 'r22_loaded_span', 1""",
)
def s18(t):
    reports = {
        "r01_revenue_per_category": lambda: retail.revenue_per_category(t.items, t.orders, t.products),
        "r04_customers_never_delivered": lambda: retail.never_delivered(t.orders, t.customers),
        "r06_return_rate_per_category": lambda: retail.return_rates(t.items, t.products),
        "r22_loaded_span": lambda: retail.loaded_span(t.items, t.orders),
    }
    counts = run_queries(reports, scratch_path(t.spark, "reports"), select=["r01", "r06", "r22"])
    return t.spark.createDataFrame(list(counts.items()), "name string, rows bigint")


@query(
    "s19_quality_report_export",
    QUALITY_SQL.replace(
        "UNION ALL SELECT 'all', 'rows:issues'",
        "UNION ALL SELECT 'customers', 'ids:email:malformed', COUNT(*), NULL FROM cj WHERE reason IS NULL AND NOT "
        + mail_ok("mail") + " UNION ALL SELECT 'all', 'rows:issues'",
    ),
)
def s19(t):
    """The report as JSON and the ids apart from it, both returned as read back."""
    root = scratch_path(t.spark, "report")
    raw = {name: t.landed(f"raw_{view}_v") for name, view in RAW_NAMES.items()}
    done = cleaning.clean_all(raw, store_below(t.spark, f"{root}/tables"))
    cleaning.quality_report(done["row_counts"], done["issues"]).write.json(f"{root}/report")
    done["invalid_emails"].write.parquet(f"{root}/invalid_emails")
    report = t.spark.read.schema("`table` string, item string, rows bigint, action string").json(f"{root}/report")
    ids = t.spark.read.parquet(f"{root}/invalid_emails").agg(
        F.lit("customers").alias("table"), F.lit("ids:email:malformed").alias("item"),
        F.count("customer_id").alias("rows"), F.lit(None).cast("string").alias("action"),
    )
    return report.unionByName(ids)


@query(
    "s20_gated_copy",
    "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, true AS copied, false AS missing_copied FROM part",
)
def s20(t):
    target = scratch_path(t.spark, "copy")
    copied = files.copy_csv(t.spark, _parts_csv(t), target)
    missing = files.copy_csv(t.spark, scratch_path(t.spark, "absent"), target + "-absent")
    return files.read_csv(t.spark, target).select(
        "p_partkey", "p_name", F.lit(copied).alias("copied"), F.lit(missing).alias("missing_copied")
    )


@query(
    "s21_source_metadata",
    "SELECT COUNT(*) AS rows, CAST(6 AS BIGINT) AS columns,"
    " 'p_partkey,p_name,p_brand,p_type,p_size,p_retailprice' AS names, true AS has_files FROM part",
)
def s21(t):
    path = _parts_csv(t)
    size = files.source_metadata(t.spark, path, "*.csv")
    found = size.select((F.col("files") > 0) & (F.col("bytes") > 0)).scalar()
    return files.describe_csv(t.spark, path).withColumn("has_files", found)


@query(
    "p12_parquet_without_nulls_to_csv",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE o_custkey END AS user_id FROM orders"
    " WHERE o_orderkey % 20 <> 0",
)
def p12(t):
    source, target = scratch_path(t.spark, "users"), scratch_path(t.spark, "users-csv")
    t.orders.select(F.col("order_id").alias("o_orderkey"), F.col("customer_id").alias("user_id")).write.parquet(source)
    files.write_csv(t.spark.read.parquet(source).filter(F.col("user_id").isNotNull()), target)
    return t.spark.read.schema("o_orderkey bigint, user_id bigint").option("header", True).csv(target)
