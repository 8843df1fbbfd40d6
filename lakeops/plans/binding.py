"""The test tables seen as the retail model: customers, products, orders, items, order lines.

Money is in whole cents here. Columns the test data lacks (guest orders, returns, statuses, profit) are derived from key
arithmetic, so the same rows come out wherever the expression runs. ``binding_sql`` states
the same views as SQL.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.plans.binding_raw import RAW_VIEWS, TABLES_OF
from lakeops.session import written

LINE_REVENUE = (
    "CAST(ROUND(CAST(CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END"
    " AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(18,2))"
)
STATUS = (
    "CASE WHEN o_orderstatus = 'F' THEN 'DELIVERED' WHEN o_orderkey % 7 = 0 THEN 'CANCELLED'"
    " WHEN o_orderstatus = 'O' THEN 'SHIPPED' ELSE 'PLACED' END"
)
SHIP_MODE = (
    "CASE l_suppkey % 4 WHEN 0 THEN 'Same Day' WHEN 1 THEN 'First Class'"
    " WHEN 2 THEN 'Second Class' ELSE 'Standard Class' END"
)


def cents(price: str) -> str:
    """A non-negative price in whole cents."""
    return f"CAST({price} * 100 + 0.5 AS BIGINT)"


# (100 - percent) of a price, rounded half up, in integers.
NET_CENTS = f"({cents('l_extendedprice')} * (100 - {cents('l_discount')}) + 50) div 100"
LINE_CENTS = f"CASE WHEN l_returnflag = 'R' THEN -({NET_CENTS}) ELSE {NET_CENTS} END"


def dealt(df: DataFrame, tasks: int) -> DataFrame:
    """A file table whose rows lie in many tasks: as it is read where its splits are even, else dealt out anew.

    Only the footers are read to tell. Splits are even where the largest is at most twice a core's fair share.
    """
    rows = df.groupBy("_metadata.file_path", "_metadata.file_block_start").agg(F.count(F.lit(1)).alias("n"))
    most, whole = rows.agg(F.max("n"), F.sum("n")).first()
    even = most is None or most * df.sparkSession.sparkContext.defaultParallelism <= 2 * whole
    return df if even else df.repartition(tasks)


class Tables:
    """One directory of test tables and the views the queries are written against."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory
        self._landed: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.directory}/{name}.parquet")

    @cached_property
    def customers(self) -> DataFrame:
        return self.raw("customer").selectExpr(
            "c_custkey AS customer_id",
            "c_name AS customer_name",
            "c_mktsegment AS customer_type",
            "CAST(DATE '1995-01-01' + CAST(c_custkey % 640 AS INT) AS DATE) AS registration_date",
        )

    @cached_property
    def places(self) -> DataFrame:
        """Nation and region of each buyer; both lookups are the fixed 25 and 5 row tables."""
        return (
            self.raw("customer")
            .join(self.raw("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
            .join(self.raw("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .selectExpr("c_custkey AS buyer_id", "n_name AS state", "r_name AS region")
        )

    @cached_property
    def products(self) -> DataFrame:
        return self.raw("part").selectExpr(
            "p_partkey AS product_id",
            "concat(p_name, ' #', CAST(p_partkey AS STRING)) AS product_name",
            "p_type AS category",
            "p_brand AS subcategory",
            "CAST(p_retailprice AS DECIMAL(12,2)) AS cost_price",
        )

    @cached_property
    def orders(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "o_orderkey AS order_id",
            "o_custkey AS buyer_id",
            "CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE o_custkey END AS customer_id",
            "o_orderdate AS order_date",
            "CAST(o_orderdate AS DATE) AS order_day",
            f"{STATUS} AS status",
        )

    @cached_property
    def items(self) -> DataFrame:
        return self.raw("lineitem").selectExpr(
            "l_orderkey AS order_id",
            "l_linenumber AS line_no",
            "l_partkey AS product_id",
            "l_suppkey AS supplier_id",
            "CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS BIGINT) AS quantity",
            f"{LINE_CENTS} AS line_revenue",
        )

    @cached_property
    def order_lines(self) -> DataFrame:
        """Items with their order; product columns are joined only where a query needs them."""
        return self.items.join(self.orders, "order_id")

    @cached_property
    def revenue_lines(self) -> DataFrame:
        return self.order_lines.filter("status <> 'CANCELLED'")

    @cached_property
    def wide_items(self) -> DataFrame:
        """The measures of the denormalised order line, before any lookup."""
        return self.raw("lineitem").selectExpr(
            "l_orderkey AS order_id",
            "l_linenumber AS line_no",
            "l_partkey AS product_id",
            "l_suppkey AS supplier_id",
            "CAST(l_shipdate AS DATE) AS ship_date",
            f"{SHIP_MODE} AS ship_mode",
            f"{cents('l_extendedprice')} AS sales",
            "CAST(l_quantity AS BIGINT) AS quantity",
            "CAST(CAST(l_discount AS DECIMAL(4,2)) * 5 AS DECIMAL(4,2)) AS discount",
            f"{NET_CENTS} AS net_sales",
        )

    @cached_property
    def catalogue(self) -> DataFrame:
        """Product catalogue with a price text, a rating and gaps in the seller and the discount."""
        price = F.regexp_replace(F.expr("CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS STRING)"), r"(\d)(\d{3}\.)", "$1,$2")
        return self.raw("part").select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("title"),
            F.col("p_type").alias("category"),
            F.expr("CAST(p_retailprice * 1.25 AS DECIMAL(12,2))").alias("initial_price"),
            F.concat(F.lit('"₹'), price, F.lit('"')).alias("final_price"),
            F.expr("CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE p_size * 2 END").alias("discount"),
            F.expr("CAST(CAST(p_partkey * 7 % 51 AS DECIMAL(4,1)) * 0.1 AS DECIMAL(3,1))").alias("rating"),
            F.expr("p_partkey * 37 % 1009").alias("ratings_count"),
            F.expr("CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_brand END").alias("seller_name"),
        )

    def view(self, name: str, tasks: int | None = None) -> DataFrame:
        """A raw view, from the SQL text it shares with the other engine; made by as many tasks, if they are given."""
        sources = {table: self.raw(table) for table in TABLES_OF[name]}
        if tasks:
            sources = {table: dealt(df, tasks) for table, df in sources.items()}
        sql = RAW_VIEWS[name]
        for table in sources:
            sql = re.sub(rf"(FROM|JOIN) {table}\b", rf"\1 {{{table}}}", sql)
        return self.spark.sql(sql, **sources)

    def landed(self, name: str) -> DataFrame:
        """A raw view written out once, the way a landed table is read several times by a job."""
        if name not in self._landed:
            # A test table may come as a single row group, for one task; what lands then comes as many files all the same.
            tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            self._landed[name] = written(self.view(name, tasks), name, row_group_bytes=4 << 20)
        return self._landed[name]

    @cached_property
    def raw_customers(self) -> DataFrame:
        return self.view("raw_customers_v")

    @cached_property
    def raw_products(self) -> DataFrame:
        return self.view("raw_products_v")

    @cached_property
    def raw_orders(self) -> DataFrame:
        return self.view("raw_orders_v")

    @cached_property
    def raw_items(self) -> DataFrame:
        return self.view("raw_items_v")

    @cached_property
    def deliveries(self) -> DataFrame:
        feed = self.view("feed_deliveries_v")
        return feed.select(
            "delivery_id",
            F.col("order_id").cast("bigint").alias("order_id"),
            F.col("pickup_time").cast("timestamp_ntz").alias("pickup_time"),
            F.col("delivery_time").cast("timestamp_ntz").alias("delivery_time"),
            F.lower(F.trim("status")).alias("status"),
        )

    def placed(self, *lookups: str) -> DataFrame:
        """Orders with the lookups asked for: ``customer``, ``place``."""
        orders = self.raw("orders").selectExpr(
            "o_orderkey AS order_id", "o_custkey AS customer_id", "CAST(o_orderdate AS DATE) AS order_date"
        )
        if "customer" in lookups:
            buyers = self.raw("customer").selectExpr(
                "c_custkey AS customer_id", "c_name AS customer_name", "c_mktsegment AS home_segment"
            )
            orders = orders.join(buyers, "customer_id").withColumn(
                "segment", F.expr("CASE WHEN order_id % 5 = 0 THEN 'HOUSEHOLD' ELSE home_segment END")
            )
        if "place" in lookups:
            places = self.places.withColumnRenamed("buyer_id", "customer_id")
            orders = orders.join(places, "customer_id").withColumn(
                "city", F.expr("concat(state, '-', CAST(order_id % 3 AS STRING))")
            )
        return orders

    def weighted_orders(self, *lookups: str) -> DataFrame:
        """Orders that have lines, with their number: lines are counted before anything is joined."""
        per_order = self.wide_items.groupBy("order_id").agg(F.count(F.lit(1)).alias("num_lines"))
        return per_order.join(self.placed(*lookups), "order_id")

    def wide(self, *lookups: str) -> DataFrame:
        """Order lines with the lookups asked for: ``order``, ``customer``, ``place``, ``product``."""
        df = self.wide_items
        if {"order", "customer", "place"} & set(lookups):
            # Customer columns meet the orders, not the lines: the lines are shuffled once.
            df = df.join(self.placed(*lookups), "order_id")
        if "product" in lookups:
            parts = self.raw("part").selectExpr(
                "p_partkey AS product_id",
                "concat(p_name, ' #', CAST(p_partkey AS STRING)) AS product_name",
                "p_type AS category",
                "p_brand AS sub_category",
                f"{cents('p_retailprice')} AS retail",
            )
            df = df.join(parts, "product_id").withColumn("profit", F.expr("net_sales - retail * quantity"))
        return df
