"""Results that were stated elsewhere, before this library: small inputs typed in, outputs and printed figures asserted."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakeops.functions import money
from lakeops.sources import files

SOURCE = """product_id,category,price,old_name,status,amount,base_price,region,priority,user_id
P101,Electronics,299.99,Item Alpha,Completed,1250.00,250.00,North,High,U1001
P102,Furniture,149.50,Item Beta,Pending,450.00,120.00,South,Low,U1002
P103,Electronics,899.00,Item Gamma,Completed,3200.50,750.00,East,High,
P104,Clothing,45.00,Item Delta,Completed,80.00,35.00,North,Medium,U1004
P105,Electronics,120.00,Item Epsilon,Cancelled,1500.00,100.00,West,Low,U1005
P106,Office Supplies,15.99,Item Zeta,Completed,2200.00,12.50,North,Low,U1006
P107,Electronics,450.00,Item Eta,Completed,950.00,380.00,South,High,U1007
P108,Furniture,620.00,Item Theta,Pending,1800.00,500.00,West,High,
P109,Electronics,1299.99,Item Iota,Completed,1450.00,1100.00,North,Medium,U1009
P110,Clothing,85.50,Item Kappa,Completed,600.00,70.00,East,Low,U1010
"""
ELECTRONICS = {"P101": 299.99, "P103": 899.0, "P105": 120.0, "P107": 450.0, "P109": 1299.99}
HIGH_VALUE = {"P101", "P103", "P106", "P109"}
NORTH_OR_HIGH = {"P101", "P103", "P104", "P106", "P107", "P108", "P109"}
TAXED = {
    "P101": 295.0, "P102": 141.6, "P103": 885.0, "P104": 41.3, "P105": 118.0,
    "P106": 14.75, "P107": 448.4, "P108": 590.0, "P109": 1298.0, "P110": 82.6,
}
# Revenue of a city and day, its orders, and the mean basket, as printed.
BASKETS = [
    ("12091.25", 18, 671.74), ("7808.70", 20, 390.44), ("11536.95", 20, 576.85),
    ("12305.50", 17, 723.85), ("17040.45", 21, 811.45), ("10079.65", 15, 671.98),
]
# Units sold, units returned, and the return rate of a product.
RETURNS = {
    "PRD-903": (194, 59, 30.41), "PRD-503": (161, 46, 28.57), "PRD-732": (121, 33, 27.27),
    "PRD-602": (115, 29, 25.22), "PRD-402": (151, 38, 25.17), "PRD-603": (120, 30, 25.0),
}
# Deliveries of a zone, how many of them failed, and the failure rate.
ZONES = {
    "Rohini": (22, 10, 45.45), "Whitefield": (11, 4, 36.36), "Andheri West": (19, 6, 31.58),
    "Bandra": (16, 5, 31.25), "Dwarka": (16, 5, 31.25),
}
# Sales of a sub-category, its order lines, and the mean sale.
SUB_CATEGORIES = [
    ("330007.05", 889, 371.21), ("328449.10", 617, 532.33), ("223843.61", 846, 264.59), ("206965.53", 319, 648.79),
]


@pytest.fixture()
def products(spark, tmp_path):
    (tmp_path / "source.csv").write_text(SOURCE)
    return files.read_csv(spark, str(tmp_path / "source.csv"), infer=True)


def keys(df) -> set[str]:
    return {r["product_id"] for r in df.collect()}


def test_the_source_is_read_with_its_types(products):
    kinds = dict(products.dtypes)
    assert kinds["price"] == kinds["amount"] == kinds["base_price"] == "double" and kinds["product_id"] == "string"
    assert products.count() == 10 and products.filter("user_id IS NULL").count() == 2


def test_selections(products):
    electronics = products.filter(F.col("category") == "Electronics").select("product_id", "price")
    assert {r.product_id: r.price for r in electronics.collect()} == ELECTRONICS
    completed = products.filter((F.col("status") == "Completed") & (F.col("amount") > 1000))
    assert keys(completed) == HIGH_VALUE
    assert keys(products.filter((F.col("region") == "North") | (F.col("priority") != "Low"))) == NORTH_OR_HIGH


def test_taxed_prices(products):
    taxed = products.select("product_id", money.with_tax(F.col("base_price")).alias("final_price"))
    assert {r.product_id: float(r.final_price) for r in taxed.collect()} == TAXED


def test_printed_means_and_rates(spark):
    means = spark.createDataFrame([*BASKETS, *SUB_CATEGORIES], "total string, n long, mean double")
    made = means.select(money.mean(F.col("total").cast("decimal(18,2)"), F.col("n")).alias("made"), "mean").collect()
    assert [r.made for r in made] == [r["mean"] for r in made] and len(made) == 10
    rates = spark.createDataFrame([v for v in (*RETURNS.values(), *ZONES.values())], "whole long, part long, rate double")
    made = rates.select(money.percent(F.col("part"), F.col("whole")).alias("made"), "rate").collect()
    assert [r.made for r in made] == [r["rate"] for r in made] and len(made) == 11
