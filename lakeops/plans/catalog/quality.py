"""Registered queries: cleaning and data quality."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from lakeops.functions import dates, money, text
from lakeops.operators import dedupe, profile
from lakeops.operators.rules import Judged, clamp, one_of
from lakeops.plans import cleaning
from lakeops.plans.catalog.projections import title_sql
from lakeops.plans.catalog.retail import pct
from lakeops.plans import retail_job
from lakeops.plans.registry import query
from lakeops.plans.runner import run_stages, run_together
from lakeops.session import scratch_path
from lakeops.sources.files import store_below

# --- SQL pieces ----------------------------------------------------------------------------


def tidy(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def nulled(x: str) -> str:
    return f"CASE WHEN lower({tidy(x)}) NOT IN ('', 'null', 'none', 'nan', 'na', 'n/a', '-') THEN {tidy(x)} END"


def number(x: str) -> str:
    return f"TRY_CAST({nulled(x)} AS DECIMAL(18,4))"


def any_date(x: str) -> str:
    layouts = "['%Y-%m-%d %H:%M:%S', '%Y-%m-%d', '%d-%m-%Y %H:%M:%S', '%d-%m-%Y', '%d/%m/%Y']"
    return f"try_strptime({nulled(x)}, {layouts})"


def mail_ok(x: str) -> str:
    return f"COALESCE(regexp_matches({x}, '^[^@\\s]+@[^@\\s.]+(\\.[^@\\s.]+)+$'), false)"


JUDGED = f"""
cb AS (SELECT *, {nulled('customer_id')} AS id, {tidy('customer_name')} AS nm, lower({nulled('email')}) AS mail,
              CAST({any_date('registration_date')} AS DATE) AS reg, upper({tidy('customer_type')}) AS typ
       FROM raw_customers_v),
cj AS (SELECT *, CASE WHEN id IS NULL THEN 'customer_id:missing'
                      WHEN row_number() OVER (PARTITION BY id ORDER BY seq) > 1 THEN 'customer_id:repeated'
                      WHEN reg IS NULL THEN 'registration_date:unreadable' END AS reason FROM cb),
pb AS (SELECT *, {nulled('product_id')} AS id, {tidy('product_name')} AS nm, {tidy('category')} AS cat,
              {tidy('subcategory')} AS sub, CAST(ROUND({number('cost_price')}, 2) AS DECIMAL(12,2)) AS cost
       FROM raw_products_v),
pj AS (SELECT *, CASE WHEN id IS NULL THEN 'product_id:missing'
                      WHEN row_number() OVER (PARTITION BY id ORDER BY seq) > 1 THEN 'product_id:repeated'
                      WHEN cost IS NULL OR cost <= 0 THEN 'cost_price:not_positive' END AS reason FROM pb),
ob AS (SELECT *, {nulled('order_id')} AS id, {nulled('customer_id')} AS cust, {any_date('order_date')} AS placed,
              upper({tidy('status')}) AS st,
              CASE WHEN upper({tidy('region_code')}) <> '' THEN upper({tidy('region_code')}) ELSE 'UNKNOWN' END AS reg
       FROM raw_orders_v),
oj AS (SELECT *, CASE WHEN id IS NULL THEN 'order_id:missing'
                      WHEN row_number() OVER (PARTITION BY id ORDER BY seq) > 1 THEN 'order_id:repeated'
                      WHEN placed IS NULL THEN 'order_date:unreadable'
                      WHEN placed > TIMESTAMP '2026-08-01 23:59:59' THEN 'order_date:future'
                      WHEN st NOT IN ('PLACED', 'SHIPPED', 'DELIVERED', 'CANCELLED', 'RETURNED')
                        THEN 'status:unknown' END AS reason FROM ob),
ib AS (SELECT *, {nulled('item_id')} AS id, {nulled('order_id')} AS oid, {nulled('product_id')} AS pid,
              CAST(trunc({number('quantity')}) AS INT) AS qty,
              CAST(ROUND({number('unit_price')}, 2) AS DECIMAL(12,2)) AS price, {number('discount_percent')} AS disc
       FROM raw_items_v),
ij AS (SELECT *, CASE WHEN id IS NULL THEN 'item_id:missing'
                      WHEN row_number() OVER (PARTITION BY id ORDER BY seq) > 1 THEN 'item_id:repeated'
                      WHEN oid IS NULL OR pid IS NULL THEN 'parent:missing'
                      WHEN oid NOT IN (SELECT id FROM oj WHERE reason IS NULL)
                        THEN 'order_id:orphan'
                      WHEN pid NOT IN (SELECT id FROM pj WHERE reason IS NULL)
                        THEN 'product_id:orphan'
                      WHEN qty IS NULL OR qty = 0 THEN 'quantity:zero_or_unreadable'
                      WHEN price IS NULL OR price <= 0 THEN 'unit_price:not_positive' END AS reason
       FROM ib)
"""


def judged(body: str) -> str:
    body = body.strip()
    return f"WITH {JUDGED.strip()}" + (f",\n{body[5:]}" if body.startswith("WITH ") else f"\n{body}")


CLAMPED = "least(greatest(COALESCE(disc, 0), 0), 100)"


def _products(t) -> Judged:
    return cleaning.clean_products(t.landed("raw_products_v"))


def _orders(t) -> Judged:
    return cleaning.clean_orders(t.landed("raw_orders_v"))


def _items(t) -> Judged:
    return cleaning.clean_order_items(
        t.landed("raw_items_v"), _orders(t).clean.select("order_id"), _products(t).clean.select("product_id")
    )


# --- single rules --------------------------------------------------------------------------


@query("q01_tidy", f"SELECT seq, {tidy('product_name')} AS product_name FROM raw_products_v")
def q01(t):
    return t.raw_products.select("seq", text.tidy(F.col("product_name")).alias("product_name"))


@query("q02_blank_to_null", f"SELECT seq, {nulled('email')} AS email FROM raw_customers_v")
def q02(t):
    return t.raw_customers.select("seq", text.blank_to_null(F.col("email")).alias("email"))


@query(
    "q03_trim_all_columns",
    "SELECT seq, " + ", ".join(
        f"NULLIF(trim({c}), '') AS {c}" for c in ("product_id", "product_name", "category", "subcategory", "cost_price")
    ) + " FROM raw_products_v",
)
def q03(t):
    names = ["product_id", "product_name", "category", "subcategory", "cost_price"]
    return t.raw_products.select("seq", *[text.empty_to_null(F.col(n)).alias(n) for n in names])


@query(
    "q04_case_standardisation",
    f"SELECT seq, {title_sql('c')} AS category, upper(s) AS sub_upper, lower(n) AS name_lower FROM"
    f" (SELECT seq, {tidy('category')} AS c, {tidy('subcategory')} AS s, {tidy('product_name')} AS n FROM raw_products_v)",
)
def q04(t):
    return t.raw_products.select(
        "seq",
        text.title_case(text.tidy(F.col("category"))).alias("category"),
        F.upper(text.tidy(F.col("subcategory"))).alias("sub_upper"),
        F.lower(text.tidy(F.col("product_name"))).alias("name_lower"),
    )


@query(
    "q05_currency_text",
    "SELECT product_id, CAST(TRY_CAST(regexp_replace(final_price, '[\"₹,]', '', 'g') AS DECIMAL(18,2)) AS DOUBLE)"
    " AS final_price FROM catalogue_v",
)
def q05(t):
    price = text.currency_to_decimal(F.col("final_price"))
    return t.catalogue.select("product_id", money.as_double(price).alias("final_price"))


@query("q06_numeric_coerce", f"SELECT seq, item_id, CAST({number('quantity')} AS DOUBLE) AS quantity FROM raw_items_v")
def q06(t):
    return t.raw_items.select("seq", "item_id", money.as_double(text.number_or_null(F.col("quantity"))).alias("quantity"))


@query("q07_multi_format_dates", f"SELECT seq, {any_date('order_date')} AS order_date FROM raw_orders_v")
def q07(t):
    return t.raw_orders.select("seq", dates.parse_date(F.col("order_date")).alias("order_date"))


@query(
    "q08_single_format_timestamp",
    "SELECT o_orderkey, o_orderdate AS order_ts FROM orders",
)
def q08(t):
    written = t.raw("orders").select("o_orderkey", F.date_format("o_orderdate", "M/d/yyyy").alias("order_date"))
    parsed = F.try_to_timestamp("order_date", F.lit("M/d/yyyy")).cast("timestamp_ntz")
    return written.withColumn("order_date", parsed).withColumnRenamed("order_date", "order_ts")


@query(
    "q09_fill_constants",
    "SELECT product_id, COALESCE(discount, 0) AS discount, COALESCE(seller_name, 'Unknown') AS seller_name FROM catalogue_v",
)
def q09(t):
    filled = t.catalogue.na.fill({"discount": 0, "seller_name": "Unknown"})
    return filled.select("product_id", "discount", "seller_name")


TIER = (
    "CASE WHEN {0} >= 5000 THEN 'PLATINUM' WHEN {0} >= 2500 THEN 'GOLD' WHEN {0} >= 1000 THEN 'SILVER' ELSE 'BRONZE' END"
)


def normal_dimension(source: str) -> str:
    """SQL of normalise_dimension over a raw view."""
    bare = "NULLIF(trim({0}), '')".format
    return f"""
    SELECT {bare('customer_id')} AS customer_id, regexp_replace({bare('customer_name')}, '\\s+', ' ', 'g') AS customer_name,
           {title_sql('sg')} AS segment, country, {title_sql('ct')} AS city, {bare('state')} AS state,
           {bare('postal_code')} AS postal_code, {title_sql('rg')} AS region,
           TRY_CAST({bare('total_orders')} AS INT) AS total_orders,
           CAST(ROUND(TRY_CAST({bare('total_sales')} AS DECIMAL(18,4)), 2) AS DECIMAL(18,2)) AS total_sales,
           CAST(ROUND(TRY_CAST({bare('total_profit')} AS DECIMAL(18,4)), 2) AS DECIMAL(18,2)) AS total_profit,
           CAST(try_strptime({bare('last_order_date')}, '%Y-%m-%d') AS DATE) AS last_order_date,
           upper({bare('loyalty_tier')}) AS loyalty_tier, lower({bare('email')}) AS email,
           try_strptime({bare('record_updated_at')}, '%Y-%m-%d %H:%M:%S') AS record_updated_at
    FROM (SELECT *, {bare('segment')} AS sg, {bare('city')} AS ct, {bare('region')} AS rg FROM {source})"""


SLUG = "replace(trim(regexp_replace(lower(customer_name), '[^a-z ]', '', 'g')), ' ', '.')"


def clean_dimension_sql(source: str, name: str) -> str:
    """CTEs ``<name>_n`` (normalised), ``<name>_k`` (latest version) and ``<name>`` (imputed)."""
    return f"""
{name}_n AS ({normal_dimension(source)}),
{name}_k AS (SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY record_updated_at DESC NULLS LAST) AS rn
    FROM (SELECT DISTINCT * FROM {name}_n WHERE customer_id IS NOT NULL)) WHERE rn = 1),
{name} AS (
  SELECT customer_id, customer_name, COALESCE(segment, 'Unknown') AS segment,
         COALESCE(country, 'United States') AS country, COALESCE(city, 'Unknown') AS city,
         COALESCE(state, 'Unknown') AS state, COALESCE(postal_code, '00000') AS postal_code,
         COALESCE(region, 'Unknown') AS region, COALESCE(total_orders, 0) AS total_orders,
         COALESCE(total_sales, 0) AS total_sales, COALESCE(total_profit, 0) AS total_profit, last_order_date,
         COALESCE(loyalty_tier, {TIER.format('COALESCE(total_sales, 0)')}) AS loyalty_tier,
         COALESCE(email, {SLUG} || '@unknown.local') AS email, record_updated_at
  FROM {name}_k)"""


DIM_SQL = (
    "customer_id, customer_name, segment, country, city, state, postal_code, region, total_orders,"
    " CAST(total_sales AS DOUBLE) AS total_sales, CAST(total_profit AS DOUBLE) AS total_profit, last_order_date,"
    " loyalty_tier, email, record_updated_at"
)


def dimension_output(df):
    return df.withColumns({n: money.as_double(F.col(n)) for n in ("total_sales", "total_profit")})


@query(
    "q10_fill_derived",
    f"WITH {clean_dimension_sql('raw_dimension_v', 'd').strip()}\nSELECT customer_id, loyalty_tier, email FROM d",
)
def q10(t):
    kept = cleaning.latest_versions(cleaning.normalise_dimension(t.view("raw_dimension_v")))
    return cleaning.impute_dimension(kept).select("customer_id", "loyalty_tier", "email")


@query(
    "q11_drop_missing_key",
    f"SELECT seq, {nulled('customer_id')} AS customer_id FROM raw_customers_v WHERE {nulled('customer_id')} IS NOT NULL",
)
def q11(t):
    keyed = t.raw_customers.select("seq", text.blank_to_null(F.col("customer_id")).alias("customer_id"))
    return keyed.filter(F.col("customer_id").isNotNull())


@query("q12_exact_dedupe", "SELECT DISTINCT * FROM raw_dimension_v")
def q12(t):
    return t.view("raw_dimension_v").dropDuplicates()


@query(
    "q13_dedupe_on_keys",
    "SELECT l_orderkey, l_partkey, l_linenumber, l_quantity FROM (SELECT *, row_number() OVER ("
    "PARTITION BY l_orderkey, l_partkey ORDER BY l_linenumber, l_quantity) AS n FROM lineitem) WHERE n = 1",
)
def q13(t):
    held = t.raw("lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    return dedupe.keep_first(held, ["l_orderkey", "l_partkey"], ["l_linenumber"])


@query(
    "q14_keep_first_occurrence",
    "SELECT * EXCLUDE n FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY seq) AS n"
    " FROM raw_products_v) WHERE n = 1",
)
def q14(t):
    return dedupe.keep_first(t.raw_products, ["product_id"], ["seq"])


@query(
    "q15_keep_latest",
    f"WITH {clean_dimension_sql('raw_dimension_v', 'd').strip()}\n"
    f"SELECT {DIM_SQL} FROM d_k",
)
def q15(t):
    return dimension_output(cleaning.latest_versions(cleaning.normalise_dimension(t.view("raw_dimension_v"))))


@query(
    "q16_enum_with_default",
    f"SELECT seq, CASE WHEN upper({tidy('customer_type')}) IN ('REGULAR', 'PREMIUM', 'VIP')"
    f" THEN upper({tidy('customer_type')}) ELSE 'REGULAR' END AS customer_type FROM raw_customers_v",
)
def q16(t):
    kind = F.upper(text.tidy(F.col("customer_type")))
    valid = one_of(kind, cleaning.CUSTOMER_TYPES)
    return t.raw_customers.select("seq", F.when(valid, kind).otherwise(cleaning.DEFAULT_TYPE).alias("customer_type"))


@query(
    "q17_enum_drop",
    f"SELECT seq, upper({tidy('status')}) AS status FROM raw_orders_v"
    f" WHERE upper({tidy('status')}) IN ('PLACED', 'SHIPPED', 'DELIVERED', 'CANCELLED', 'RETURNED')",
)
def q17(t):
    coded = t.raw_orders.select("seq", F.upper(text.tidy(F.col("status"))).alias("status"))
    return coded.filter(one_of(F.col("status"), cleaning.ORDER_STATUSES))


@query("q18_invalid_emails", judged(f"SELECT id AS customer_id FROM cj WHERE reason IS NULL AND NOT {mail_ok('mail')}"))
def q18(t):
    return cleaning.invalid_emails(cleaning.clean_customers(t.landed("raw_customers_v")).clean)


@query(
    "q19_orphans",
    "SELECT seq, item_id, order_id FROM raw_items_v WHERE order_id NOT IN (SELECT order_id FROM raw_orders_v)",
)
def q19(t):
    return dedupe.orphans(t.raw_items.select("seq", "item_id", "order_id"), "order_id", t.raw_orders, "order_id")


@query(
    "q20_unknown_customers",
    judged(
        "SELECT COUNT(*) AS unknown_orders FROM oj WHERE reason IS NULL AND cust IS NOT NULL"
        " AND cust NOT IN (SELECT id FROM cj WHERE reason IS NULL)"
    ),
)
def q20(t):
    found = cleaning.unknown_customers(_orders(t).clean, cleaning.clean_customers(t.landed("raw_customers_v")).clean)
    return found.agg(F.count(F.lit(1)).alias("unknown_orders"))


@query(
    "q21_clamp",
    f"SELECT seq, item_id, CAST(least(greatest(COALESCE({number('discount_percent')}, 0), 0), 100) AS DOUBLE) AS discount"
    " FROM raw_items_v",
)
def q21(t):
    value = clamp(text.number_or_null(F.col("discount_percent")), 0, 100)
    return t.raw_items.select("seq", "item_id", money.as_double(value).alias("discount"))


@query(
    "q22_positive_numbers",
    f"SELECT seq, product_id, {number('cost_price')} > 0 IS TRUE AS cost_ok FROM raw_products_v",
)
def q22(t):
    positive = F.coalesce(text.number_or_null(F.col("cost_price")) > 0, F.lit(False))
    return t.raw_products.select("seq", "product_id", positive.alias("cost_ok"))


@query(
    "q23_nonzero_quantity",
    judged("SELECT seq, item_id, qty AS quantity FROM ib WHERE qty IS NOT NULL AND qty <> 0"),
)
def q23(t):
    read = t.raw_items.select("seq", "item_id", text.number_or_null(F.col("quantity")).cast("int").alias("quantity"))
    return read.filter((F.col("quantity") != 0) & F.col("quantity").isNotNull())


@query(
    "q24_future_dates",
    judged("SELECT seq, order_id, placed AS order_date FROM ob WHERE placed > TIMESTAMP '2026-08-01 23:59:59'"),
)
def q24(t):
    parsed = t.raw_orders.select("seq", "order_id", dates.parse_date(F.col("order_date")).alias("order_date"))
    now = F.lit(cleaning.REFERENCE_TIME.isoformat(sep=" ")).cast("timestamp_ntz")
    return parsed.filter(F.col("order_date") > now)


@query("q25_return_flag", judged("SELECT seq, item_id, CAST(qty < 0 AS INT) AS is_return FROM ib"))
def q25(t):
    quantity = text.number_or_null(F.col("quantity")).cast("int")
    return t.raw_items.select("seq", "item_id", (quantity < 0).cast("int").alias("is_return"))


@query(
    "q26_other_date_layouts",
    judged("SELECT COUNT(*) AS non_iso FROM ob WHERE placed IS NOT NULL AND length(order_date) <> 19"),
)
def q26(t):
    parsed = dates.parse_date(F.col("order_date")).isNotNull()
    return t.raw_orders.agg(F.count_if(parsed & (F.length("order_date") != 19)).alias("non_iso"))


# --- rule engine ---------------------------------------------------------------------------

ISSUES = {
    "orders": f"""
  SELECT 'orders' AS "table", reason AS issue, COUNT(*) AS rows,
         CASE WHEN reason LIKE '%:repeated' THEN 'first kept' ELSE 'dropped' END AS action
  FROM oj WHERE reason IS NOT NULL GROUP BY reason
  UNION ALL SELECT 'orders', 'customer_id:absent', COUNT(*), 'null kept'
  FROM oj WHERE cust IS NULL
  UNION ALL SELECT 'orders', 'order_date:other_layout', COUNT(*), 'written as ISO'
  FROM oj WHERE length(order_date) <> 19
    AND (reason IS NULL OR reason IN ('order_date:future', 'status:unknown'))""",
    "order_items": f"""
  SELECT 'order_items' AS "table", reason AS issue, COUNT(*) AS rows,
         CASE WHEN reason LIKE '%:repeated' THEN 'first kept' ELSE 'dropped' END AS action
  FROM ij WHERE reason IS NOT NULL GROUP BY reason
  UNION ALL SELECT 'order_items', 'discount_percent:out_of_range', COUNT(*), 'clamped'
  FROM ij WHERE reason IS NULL AND (disc IS NULL OR disc NOT BETWEEN 0 AND 100)
  UNION ALL SELECT 'order_items', 'quantity:return', COUNT(*), 'flagged'
  FROM ij WHERE reason IS NULL AND qty < 0""",
    "customers": f"""
  SELECT 'customers' AS "table", reason AS issue, COUNT(*) AS rows,
         CASE WHEN reason LIKE '%:repeated' THEN 'first kept' ELSE 'dropped' END AS action
  FROM cj WHERE reason IS NOT NULL GROUP BY reason
  UNION ALL SELECT 'customers', 'customer_type:unknown', COUNT(*), 'default set'
  FROM cj WHERE reason IS NULL AND typ NOT IN ('REGULAR', 'PREMIUM', 'VIP')
  UNION ALL SELECT 'customers', 'email:malformed', COUNT(*), 'listed'
  FROM cj WHERE reason IS NULL AND NOT {mail_ok('mail')}""",
    "products": f"""
  SELECT 'products' AS "table", reason AS issue, COUNT(*) AS rows,
         CASE WHEN reason LIKE '%:repeated' THEN 'first kept' ELSE 'dropped' END AS action
  FROM pj WHERE reason IS NOT NULL GROUP BY reason
  UNION ALL SELECT 'products', 'product_name:rewritten', COUNT(*), 'rewritten'
  FROM pj WHERE {title_sql('nm')} <> product_name""",
}


@query(
    "q27_quarantine",
    judged(
        "SELECT reason AS quarantine_reason, seq, item_id, order_id, product_id, quantity, unit_price, discount_percent"
        " FROM ij WHERE reason IS NOT NULL"
    ),
)
def q27(t):
    return _items(t).quarantine


REPORT = " UNION ALL ".join(
    f"SELECT '{name}' AS \"table\", 'rows:{state}' AS item, COUNT(*) FILTER ({test}) AS rows, CAST(NULL AS VARCHAR) AS action FROM {cte}"
    for name, cte in (("customers", "cj"), ("products", "pj"), ("orders", "oj"), ("order_items", "ij"))
    for state, test in (("raw", "true"), ("clean", "reason IS NULL"), ("dropped", "reason IS NOT NULL"))
)
EXTRA_ISSUES = """
  SELECT 'order_items' AS "table", 'order_id:never_seen' AS issue, COUNT(*) AS rows, 'dropped, counted as orphan too' AS action
  FROM raw_items_v WHERE order_id NOT IN (SELECT order_id FROM raw_orders_v)
  UNION ALL SELECT 'orders', 'customer_id:unknown', COUNT(*), 'anonymous' FROM oj
  WHERE reason IS NULL AND cust IS NOT NULL AND cust NOT IN (SELECT id FROM cj WHERE reason IS NULL)"""
QUALITY_SQL = judged(
    f"""WITH issues AS (SELECT * FROM ({' UNION ALL '.join([*ISSUES.values(), EXTRA_ISSUES])}) WHERE rows > 0)
    {REPORT} UNION ALL SELECT "table", issue, rows, action FROM issues
    UNION ALL SELECT 'all', 'rows:issues', CAST(SUM(rows) AS BIGINT), NULL FROM issues"""
)


@query("q28_issue_log", QUALITY_SQL)
def q28(t):
    """All issues of the four tables, their row counts, and the total of issue rows."""
    done = _clean_all(t)
    return cleaning.quality_report(done["row_counts"], done["issues"])


@query("q28_issues_of_one_table", judged(f"SELECT * FROM ({ISSUES['order_items']}) WHERE rows > 0"))
def q28_one(t):
    return _items(t).issues()


RAW_NAMES = {"customers": "customers", "products": "products", "orders": "orders", "order_items": "items"}


def _clean_all(t):
    raw = {name: t.landed(f"raw_{view}_v") for name, view in RAW_NAMES.items()}
    return cleaning.clean_all(raw, store_below(t.spark, scratch_path(t.spark, "clean")))


@query(
    "q29_constraint_suite",
    judged(
        """WITH b AS (SELECT raw_items_v.*, TRY_CAST(trim(quantity) AS DECIMAL(18,4)) AS q,
                          TRY_CAST(trim(unit_price) AS DECIMAL(18,4)) AS u,
                          TRY_CAST(trim(discount_percent) AS DECIMAL(18,4)) AS d FROM raw_items_v),
        p AS (SELECT TRY_CAST(trim(cost_price) AS DECIMAL(18,4)) AS c FROM raw_products_v),
        v AS (
        SELECT 'order_items' AS "table", 'unique item_id' AS "constraint",
               COUNT(*) FILTER (n > 1) AS violations
        FROM (SELECT item_id, COUNT(*) AS n FROM raw_items_v WHERE item_id IS NOT NULL GROUP BY 1)
        UNION ALL SELECT 'order_items', 'check quantity', COUNT(*) FILTER (q = 0) FROM b
        UNION ALL SELECT 'order_items', 'check discount_percent', COUNT(*) FILTER (d NOT BETWEEN 0 AND 100) FROM b
        UNION ALL SELECT 'order_items', 'check unit_price', COUNT(*) FILTER (u <= 0) FROM b
        UNION ALL SELECT 'order_items', 'required unit_price', COUNT(*) FILTER (u IS NULL) FROM b
        UNION ALL SELECT 'products', 'check cost_price', COUNT(*) FILTER (c <= 0) FROM p
        UNION ALL SELECT 'products', 'required cost_price', COUNT(*) FILTER (c IS NULL) FROM p
        UNION ALL SELECT 'orders', 'check status',
          COUNT(*) FILTER (status NOT IN ('PLACED', 'SHIPPED', 'DELIVERED', 'CANCELLED', 'RETURNED')) FROM raw_orders_v
        UNION ALL SELECT 'order_items', 'required quantity', COUNT(*) FILTER (q IS NULL) FROM b
        UNION ALL SELECT 'order_items', 'required discount_percent', COUNT(*) FILTER (d IS NULL) FROM b
        UNION ALL SELECT 'order_items', 'reference order_id', COUNT(*) FROM b
          WHERE order_id NOT IN (SELECT order_id FROM raw_orders_v)
        UNION ALL SELECT 'order_items', 'reference product_id', COUNT(*) FROM b
          WHERE product_id NOT IN (SELECT product_id FROM raw_products_v)
        UNION ALL SELECT 'customers', 'unique customer_id', COUNT(*) FILTER (n > 1)
          FROM (SELECT customer_id, COUNT(*) AS n FROM raw_customers_v GROUP BY 1)
        UNION ALL SELECT 'customers', 'check customer_type',
          COUNT(*) FILTER (customer_type NOT IN ('REGULAR', 'PREMIUM', 'VIP')) FROM raw_customers_v
        UNION ALL SELECT 'orders', 'unique order_id', COUNT(*) FILTER (n > 1)
          FROM (SELECT order_id, COUNT(*) AS n FROM raw_orders_v GROUP BY 1)
        UNION ALL SELECT 'orders', 'reference customer_id', COUNT(*) FROM raw_orders_v
          WHERE customer_id NOT IN (SELECT customer_id FROM raw_customers_v)
        UNION ALL SELECT 'products', 'unique product_id', COUNT(*) FILTER (n > 1)
          FROM (SELECT product_id, COUNT(*) AS n FROM raw_products_v GROUP BY 1))
        SELECT * FROM v WHERE violations > 0"""
    ),
)
def q29(t):
    def read(name: str):
        return F.trim(name).try_cast("decimal(18,4)").alias(name)

    items = t.raw_items.select(
        "item_id", "order_id", "product_id", read("quantity"), read("unit_price"), read("discount_percent")
    ).withColumn("is_return", (F.col("quantity") < 0).cast("int"))
    products = t.raw_products.withColumn("cost_price", read("cost_price"))
    return cleaning.constraint_violations(t.raw_customers, products, t.raw_orders, items).filter("violations > 0")


@query("q29_clean_tables_hold", judged("SELECT CAST(0 AS BIGINT) AS violations"))
def q29_clean(t):
    done = _clean_all(t)
    tables = [done[f"clean/{name}"] for name in ("customers", "products", "orders", "order_items")]
    suite = cleaning.constraint_violations(*tables)
    known = F.col("constraint") != "reference customer_id"  # a soft reference: unknown customers are kept
    return suite.filter(known).agg(F.sum("violations").alias("violations"))


@query(
    "q30_row_reconciliation",
    judged(
        " UNION ALL ".join(
            f"SELECT '{name}' AS \"table\", COUNT(*) AS raw, COUNT(*) FILTER (reason IS NULL) AS clean,"
            f" COUNT(*) FILTER (reason IS NOT NULL) AS dropped FROM {cte}"
            for name, cte in (("customers", "cj"), ("products", "pj"), ("orders", "oj"), ("order_items", "ij"))
        )
    ),
)
def q30(t):
    parts = [cleaning.clean_customers(t.landed("raw_customers_v")), _products(t), _orders(t), _items(t)]
    counts = parts[0].row_counts()
    for part in parts[1:]:
        counts = counts.unionByName(part.row_counts())
    return counts


# --- profiles and reports ------------------------------------------------------------------

DIM = cleaning.DIMENSION
DIM_N = f"WITH n AS ({normal_dimension('raw_dimension_v')})"


def null_rows(source: str, columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", COUNT(*) FILTER ({c} IS NULL) AS nulls FROM {source}" for c in columns
    )


@query("q31_null_counts", f"{DIM_N} {null_rows('n', DIM)}")
def q31(t):
    return profile.null_counts(cleaning.normalise_dimension(t.view("raw_dimension_v")))


DOC_TYPES = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}


@query(
    "q32_column_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{k}' AS type, COUNT(*) FILTER ({c} IS NULL) AS nulls,"
        f" {pct(f'COUNT(*) FILTER ({c} IS NULL)', 'COUNT(*)')} AS null_pct, COUNT(DISTINCT {c}) AS distinct FROM documents"
        for c, k in DOC_TYPES.items()
    ).replace("AS distinct FROM", 'AS "distinct" FROM'),
)
def q32(t):
    return profile.column_profile(t.raw("documents").select(*DOC_TYPES))


def table_profile_sql(source: str) -> str:
    cells = " + ".join(f"CAST({c} IS NULL AS INT)" for c in DIM)
    hit = " + ".join(f"CAST(COUNT(*) FILTER ({c} IS NULL) > 0 AS INT)" for c in DIM)
    return f"""
    SELECT unnest(['rows', 'exact_duplicate_rows', 'duplicate_keys', 'distinct_keys', 'columns_with_nulls', 'null_cells'])
             AS metric,
           unnest([r, r - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM {source})),
                   r - k - z, k, c, x]) AS value
    FROM (SELECT COUNT(*) AS r, COUNT(DISTINCT customer_id) AS k, {hit} AS c, CAST(SUM({cells}) AS BIGINT) AS x,
                 CAST(COUNT(*) FILTER (customer_id IS NULL) > 0 AS INT) AS z FROM {source})"""


@query("q32_table_profile", f"{DIM_N} {table_profile_sql('n')}")
def q32_table(t):
    return profile.table_profile(cleaning.normalise_dimension(t.view("raw_dimension_v")), "customer_id")


@query(
    "q33_profile_before_and_after",
    f"""{DIM_N},{clean_dimension_sql('raw_dimension_v', 'd')},
    b AS ({table_profile_sql('n')}), a AS ({table_profile_sql('d')})
    SELECT metric, b.value AS before, a.value AS after, a.value - b.value AS delta FROM b JOIN a USING (metric)""",
)
def q33(t):
    raw = t.view("raw_dimension_v")
    before = profile.table_profile(cleaning.normalise_dimension(raw), "customer_id")
    after = profile.table_profile(cleaning.clean_dimension(raw), "customer_id")
    return profile.compare_profiles(before, after)


@query(
    "q34_cleaning_report",
    f"""WITH {clean_dimension_sql('raw_dimension_v', 'd').strip()}
    SELECT 'rows_in' AS metric, COUNT(*) AS value FROM d_n
    UNION ALL SELECT 'dropped_null_key', COUNT(*) FROM d_n WHERE customer_id IS NULL
    UNION ALL SELECT 'dropped_exact_duplicates', (SELECT COUNT(*) FROM d_n WHERE customer_id IS NOT NULL)
      - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM d_n WHERE customer_id IS NOT NULL))
    UNION ALL SELECT 'dropped_duplicate_keys', (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM d_n
      WHERE customer_id IS NOT NULL)) - (SELECT COUNT(*) FROM d_k)
    UNION ALL SELECT 'nulls_filled', (SELECT CAST(SUM({' + '.join(f'CAST({c} IS NULL AS INT)' for c in DIM
                                                        if c not in ('customer_id', 'total_orders'))}) AS BIGINT) FROM d_k)
      - (SELECT CAST(SUM({' + '.join(f'CAST({c} IS NULL AS INT)' for c in DIM)}) AS BIGINT) FROM d)
    UNION ALL SELECT 'remaining_nulls', CAST(SUM({' + '.join(f'CAST({c} IS NULL AS INT)' for c in DIM)}) AS BIGINT) FROM d
    UNION ALL SELECT 'rows_removed', (SELECT COUNT(*) FROM d_n) - (SELECT COUNT(*) FROM d)
    UNION ALL SELECT 'rows_out', COUNT(*) FROM d""",
)
def q34(t):
    return cleaning.dimension_report(t.view("raw_dimension_v"))


@query(
    "q35_duplicate_keys",
    "SELECT order_id, product_id, COUNT(*) AS times_repeated FROM wide_v GROUP BY 1, 2 HAVING COUNT(*) > 1",
)
def q35(t):
    return dedupe.repeated_keys(t.wide_items, "order_id", "product_id")


@query(
    "q36_exact_duplicates_on_wider_key",
    "SELECT order_id, product_id, CAST(sales AS DOUBLE) AS sales, quantity, CAST(discount AS DOUBLE) AS discount,"
    " COUNT(*) AS times_repeated FROM (SELECT * FROM wide_v UNION ALL SELECT * FROM wide_v WHERE order_id % 60 = 7)"
    " GROUP BY 1, 2, 3, 4, 5 HAVING COUNT(*) > 1",
)
def q36(t):
    """Lines that repeat in every measure; some are loaded twice, as a second delivery of a file would."""
    lines = t.wide_items.select("order_id", "product_id", "sales", "quantity", "discount")
    twice = lines.unionByName(lines.filter("order_id % 60 = 7"))
    found = dedupe.repeated_keys(twice, "order_id", "product_id", "sales", "quantity", "discount")
    return found.withColumns({"sales": money.amount(F.col("sales")), "discount": money.as_double(F.col("discount"))})


@query(
    "q37_range_sanity",
    """
    SELECT CAST(MIN(discount) AS DOUBLE) AS min_discount, CAST(MAX(discount) AS DOUBLE) AS max_discount,
           CAST(MIN(profit) AS DOUBLE) AS min_profit, CAST(MAX(profit) AS DOUBLE) AS max_profit,
           COUNT(*) FILTER (profit < 0) AS loss_lines FROM wide_v""",
)
def q37(t):
    return t.wide("product").agg(
        *[
            form(fold(name)).alias(f"{label}_{name}")
            for name, form in (("discount", money.as_double), ("profit", money.amount))
            for label, fold in (("min", F.min), ("max", F.max))
        ],
        F.count_if(F.col("profit") < 0).alias("loss_lines"),
    )


@query(
    "q38_hashed_personal_data",
    "SELECT customer_id, sha256(lower(trim(email))) AS email_hash, sha256(trim(phone)) AS phone_hash FROM feed_customers_v",
)
def q38(t):
    return t.view("feed_customers_v").select(
        "customer_id",
        money.hashed_email(F.col("email")).alias("email_hash"),
        money.hashed_phone(F.col("phone")).alias("phone_hash"),
    )


@query(
    "q39_clean_customers",
    judged(
        f"SELECT id AS customer_id, {title_sql('nm')} AS customer_name, mail AS email, reg AS registration_date,"
        " CASE WHEN typ IN ('REGULAR', 'PREMIUM', 'VIP') THEN typ ELSE 'REGULAR' END AS customer_type"
        " FROM cj WHERE reason IS NULL"
    ),
)
def q39_customers(t):
    return cleaning.published(cleaning.clean_customers(t.landed("raw_customers_v")))


@query(
    "q39_clean_products",
    judged(
        f"SELECT id AS product_id, {title_sql('nm')} AS product_name, {title_sql('cat')} AS category,"
        f" {title_sql('sub')} AS subcategory, CAST(cost AS DOUBLE) AS cost_price FROM pj WHERE reason IS NULL"
    ),
)
def q39_products(t):
    return cleaning.published(_products(t)).withColumn("cost_price", money.as_double(F.col("cost_price")))


@query(
    "q39_clean_orders",
    judged(
        "SELECT id AS order_id, cust AS customer_id, placed AS order_date, st AS status, reg AS region_code"
        " FROM oj WHERE reason IS NULL"
    ),
)
def q39_orders(t):
    return cleaning.published(_orders(t))


@query(
    "q39_clean_order_items",
    judged(
        f"SELECT id AS item_id, oid AS order_id, pid AS product_id, qty AS quantity, CAST(price AS DOUBLE) AS unit_price,"
        f" CAST({CLAMPED} AS DOUBLE) AS discount_percent, CAST(qty < 0 AS INT) AS is_return FROM ij WHERE reason IS NULL"
    ),
)
def q39_items(t):
    clean = cleaning.published(_items(t))
    return clean.withColumns({n: money.as_double(F.col(n)) for n in ("unit_price", "discount_percent")})


@query(
    "q40_clean_dimension",
    f"WITH {clean_dimension_sql('raw_dimension_v', 'd').strip()}\nSELECT {DIM_SQL} FROM d",
)
def q40(t):
    return dimension_output(cleaning.clean_dimension(t.view("raw_dimension_v")))


@query(
    "q41_clean_all_issues",
    judged(
        f"""SELECT * FROM ({ISSUES['customers']} UNION ALL {ISSUES['products']} UNION ALL {ISSUES['orders']}
        UNION ALL {ISSUES['order_items']}
        UNION ALL SELECT 'order_items', 'order_id:never_seen', COUNT(*),
          'dropped, counted as orphan too' FROM raw_items_v
          WHERE order_id NOT IN (SELECT order_id FROM raw_orders_v)
        UNION ALL SELECT 'orders', 'customer_id:unknown', COUNT(*),
          'anonymous' FROM oj WHERE reason IS NULL AND cust IS NOT NULL
          AND cust NOT IN (SELECT id FROM cj WHERE reason IS NULL)) WHERE rows > 0"""
    ),
)
def q41(t):
    return _clean_all(t)["issues"]


@query(
    "q42_edge_spaces",
    "SELECT doc_id FROM documents WHERE regexp_matches(text, '^\\s|\\s$') UNION ALL"
    " SELECT seq + 1000000000 FROM raw_products_v WHERE regexp_matches(product_name, '^\\s|\\s$')",
)
def q42(t):
    documents = t.raw("documents").filter(text.has_edge_space(F.col("text"))).select("doc_id")
    products = t.raw_products.filter(text.has_edge_space(F.col("product_name")))
    return documents.unionAll(products.select(F.col("seq") + 1000000000))


@query("q43_rated_only", "SELECT product_id, CAST(rating AS DOUBLE) AS rating FROM catalogue_v WHERE rating > 0")
def q43(t):
    return t.catalogue.filter("rating > 0").select("product_id", money.as_double(F.col("rating")).alias("rating"))


@query(
    "q44_repaired_rows",
    f"""WITH {clean_dimension_sql('raw_dimension_v', 'd').strip()}
    SELECT customer_id, k.segment AS raw_segment, k.city AS raw_city, k.email AS raw_email,
           d.segment AS clean_segment, d.city AS clean_city, d.email AS clean_email
    FROM d_k k JOIN d USING (customer_id) WHERE k.segment IS NULL OR k.city IS NULL OR k.email IS NULL""",
)
def q44(t):
    return cleaning.repaired_rows(t.view("raw_dimension_v"), ["segment", "city", "email"])


@query(
    "q44_superseded_rows",
    f"""WITH {clean_dimension_sql('raw_dimension_v', 'd').strip()}
    SELECT DISTINCT customer_id, CAST(n.total_sales AS DOUBLE) AS total_sales, n.record_updated_at,
           k.record_updated_at AS kept_at
    FROM d_n n JOIN d_k k USING (customer_id) WHERE n.record_updated_at < k.record_updated_at""",
)
def q44_superseded(t):
    found = cleaning.superseded_rows(t.view("raw_dimension_v"))
    return found.withColumn("total_sales", money.as_double(F.col("total_sales")))


@query(
    "q45_drop_rows_with_nulls",
    "SELECT product_id, discount, seller_name FROM catalogue_v WHERE discount IS NOT NULL AND seller_name IS NOT NULL",
)
def q45(t):
    return t.catalogue.na.drop(subset=["discount", "seller_name"]).select("product_id", "discount", "seller_name")


@query(
    "r00_retail_job",
    judged(
        f"""WITH held AS (
          SELECT ij.oid, pj.cat, ij.qty, ROUND(CAST(ij.qty AS DECIMAL(10,0)) * ij.price
                 * (100 - CAST({CLAMPED} AS DECIMAL(5,2))), 0) AS cents
          FROM ij JOIN pj ON pj.id = ij.pid AND pj.reason IS NULL JOIN oj ON oj.id = ij.oid AND oj.reason IS NULL
          WHERE ij.reason IS NULL AND oj.st <> 'CANCELLED')
        SELECT {title_sql('cat')} AS category, COUNT(DISTINCT oid) AS orders, CAST(SUM(qty) AS BIGINT) AS net_units,
               CAST(SUM(cents) / 100 AS DOUBLE) AS total_revenue FROM held GROUP BY 1"""
    ),
)
def r00_job(t):
    """Clean, gate and analyse as one job; returned is one analysis as it was written."""
    landed = run_together([partial(t.landed, f"raw_{view}_v") for view in RAW_NAMES.values()])
    raw = dict(zip(RAW_NAMES, landed))
    root = scratch_path(t.spark, "retail-job")
    run_stages(retail_job.stages(t.spark, raw, root))
    return t.spark.read.parquet(f"{root}/analysis/revenue_per_category")
