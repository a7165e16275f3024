"""Two company lists derived from the TPC-H tables (recipe in FIXTURES.md).

The planted truth is the part key: keys with ``% 10 = 4`` appear in both lists with equal
clean names, ``% 10 = 5`` in both with a one-character typo, ``0-3`` only in list 1 and
``6-9`` only in list 2.  The md5 prefix spreads the fuzzy blocks.  Some names have two rows on a
side, some rows have a name that is blank once cleaned, and some names are long.

``shipped_before`` builds the lists as they stood at a date: only line items shipped
earlier count, and only parts with such a line item are listed.  Two dates give two
batches of the same registry for upsert runs.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _sorted_set(c: Column | str) -> Column:
    return F.array_join(F.sort_array(F.collect_set(c)), "|")


def _hundredths(c: str, digits: int) -> Column:
    """The double ``c`` as decimal(digits, 2), in hundredths, as a long.  A double that is nearest to a number of
    hundredths (of fewer than 15 digits, so to one only) stands for just that number; all others are converted by their text."""
    x = F.col(c)
    near = F.rint(x * F.lit(100.0))
    exact = (F.abs(x) < F.lit(10.0 ** min(digits - 2, 11))) & (near / F.lit(100.0) == x)
    return F.when(exact, near.cast("bigint")).otherwise((x.cast(f"decimal({digits},2)") * F.lit(100)).cast("bigint"))


def _product_sum(price: Column, factor: Column) -> Column:
    """Exact sum of price * factor, both in hundredths, as a decimal of scale 4.  Longs are summed, of the price's
    millions and of what is left: a sum has room for 460,000 rows of the greatest price and factor, and for more of any others."""
    part = lambda p: F.sum(p * factor).cast("decimal(20,0)")
    rest = price % F.lit(1_000_000)
    millions = F.floor((price - rest) / F.lit(1_000_000))  # whole, and below 2^53: the division is exact
    return part(millions) * F.lit(Decimal("100")) + part(rest) * F.lit(Decimal("0.0001"))


def _spelling(x: Column, key: Column, offset: int) -> Column:
    """One of four ways to write a name that clean alike: shouted, with the suffix in front, in
    brackets behind, or with slashes for blanks."""
    r = (key * 3 + F.lit(offset)) % 4
    return (F.when(r == 0, F.upper(x)).when(r == 1, F.concat(F.lit("Co. "), x))
             .when(r == 2, F.concat(x, F.lit(" (Limited)"))).otherwise(F.replace(x, F.lit(" "), F.lit(" / "))))


def _base_name(name: Column, key: Column) -> Column:
    """A name that ends in the part key; of every fiftieth part one of more than 62 characters."""
    k = key.cast("string")
    name = F.when(key % 50 == 35, F.concat_ws(" ", *[name] * 6)).otherwise(name)
    return F.concat(F.substring(F.md5(k), 1, 3), F.lit(" "), name, F.lit(" "), k)


def _as_of(spark: SparkSession, sf_dir: str, shipped_before: str | None):
    lineitem = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    if shipped_before is not None:
        lineitem = lineitem.filter(F.col("l_shipdate") < F.expr(f"TIMESTAMP_NTZ '{shipped_before}'"))
        part = part.join(lineitem.select(F.col("l_partkey").alias("p_partkey")), "p_partkey", "left_semi")
    return part, lineitem


def source1(spark: SparkSession, sf_dir: str, shipped_before: str | None = None) -> DataFrame:
    part, lineitem = _as_of(spark, sf_dir, shipped_before)
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    lists = (lineitem.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
             .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
             .groupBy("l_partkey")
             .agg(F.collect_set("l_suppkey").alias("_suppliers"), _sorted_set("n_name").alias("activity_places"))
             .withColumn("top_suppliers", F.array_join(F.sort_array(F.transform("_suppliers", lambda k: F.concat(F.lit("S"), k.cast("string")))), "|")).drop("_suppliers"))
    key = F.col("p_partkey")
    name = _base_name(F.col("p_name"), key)
    rows = (part.filter(key % 10 < 6)
            .join(lists, key == F.col("l_partkey"), "left")
            .select(_spelling(name, key, 0).alias("corporate_name_s1"),
                    F.concat(F.col("p_size").cast("string"), F.lit(" "), F.col("p_type"),
                             F.lit(" Street, "), F.col("p_brand")).alias("address"),
                    "activity_places", "top_suppliers"))
    # second rows of some names, in another spelling, with an address and lists of their own
    again = part.filter((key % 50).isin(1, 4)).select(
        _spelling(name, key, 1).alias("corporate_name_s1"), F.concat("p_type", F.lit(" Road")).alias("address"),
        F.col("p_type").alias("activity_places"), F.concat("p_brand", F.lit("|S0|"), "p_brand").alias("top_suppliers"))
    # rows whose name is a suffix and nothing else: blank once cleaned
    suffix_only = part.filter(key % 100 == 2).select(
        F.when(key % 200 == 2, F.lit("Inc.")).otherwise(F.lit("Co. Ltd")).alias("corporate_name_s1"),
        F.concat(F.col("p_size").cast("string"), F.lit(" Road")).alias("address"),
        F.lit(None).cast("string").alias("activity_places"), F.lit(None).cast("string").alias("top_suppliers"))
    return rows.unionByName(again).unionByName(suffix_only)


def source2(spark: SparkSession, sf_dir: str, shipped_before: str | None = None) -> DataFrame:
    part, lineitem = _as_of(spark, sf_dir, shipped_before)
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    price, disc, tax = F.col("_price"), F.col("_disc"), F.col("_tax")  # in hundredths
    finance = (lineitem.select("l_partkey", _hundredths("l_extendedprice", 15).alias("_price"),
                               _hundredths("l_discount", 4).alias("_disc"), _hundredths("l_tax", 4).alias("_tax"))
               .groupBy("l_partkey")
               .agg(_product_sum(price, F.lit(100) - disc).alias("rev"),
                    _product_sum(price, F.lit(12) - disc - tax).alias("prof"))
               .withColumnRenamed("l_partkey", "f_partkey"))
    # customers meet the orders, so that line items pass one exchange only before they are aggregated
    segments = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_mktsegment")
    customers = (lineitem.join(segments, F.col("l_orderkey") == F.col("o_orderkey"))
                 .groupBy("l_partkey").agg(_sorted_set("c_mktsegment").alias("main_customers"))
                 .withColumnRenamed("l_partkey", "y_partkey"))
    key = F.col("p_partkey")
    name = F.when(key % 10 == 5, F.expr("substr(p_name, 1, char_length(p_name) - 1)")).otherwise(F.col("p_name"))
    base = _base_name(name, key)
    rows = (part.filter(key % 10 >= 4)
            .join(finance, key == F.col("f_partkey"), "left")
            .join(customers, key == F.col("y_partkey"), "left")
            .select(_spelling(base, key, 2).alias("corporate_name_s2"),
                    "main_customers",
                    F.col("rev").cast("double").alias("revenue"),
                    F.col("prof").cast("double").alias("profit")))
    again = part.filter((key % 50).isin(4, 7)).select(
        _spelling(base, key, 3).alias("corporate_name_s2"), F.lit("WHOLESALE|BUILDING").alias("main_customers"),
        F.col("p_retailprice").cast("double").alias("revenue"), F.lit(None).cast("double").alias("profit"))
    suffix_only = part.filter(key % 100 == 6).select(
        F.lit("Limited").alias("corporate_name_s2"), F.lit(None).cast("string").alias("main_customers"),
        F.col("p_retailprice").cast("double").alias("revenue"), F.lit(0.0).alias("profit"))
    return rows.unionByName(again).unionByName(suffix_only)


def company_sources(spark: SparkSession, sf_dir: str, batch_id: str = "batch_001",
                    shipped_before: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Both lists, tagged with lineage like an ingested batch."""
    from ledgerlink.sources.companies import tag_source
    return (tag_source(source1(spark, sf_dir, shipped_before), "source1", batch_id),
            tag_source(source2(spark, sf_dir, shipped_before), "source2", batch_id))
