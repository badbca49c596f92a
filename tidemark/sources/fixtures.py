"""Map the star-schema test tables onto the roles a feature book needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.plans.book import BookTables
from tidemark.plans.spec import BookSpec

# Column types of the test tables.  Declared, so that no job infers them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
        " o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
        " l_extendedprice double, l_discount double, l_tax double, l_returnflag string,"
        " l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

BRANDS = tuple(f"Brand#{i}" for i in range(1, 20))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table; zone-less timestamps are read as instants in the session zone."""
    df = spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")
    ntz = [f.name for f in df.schema if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({n: F.col(n).cast("timestamp") for n in ntz}) if ntz else df


def _spec(**overrides) -> BookSpec:
    return BookSpec(
        status_value="F",
        categories=BRANDS,
        category_columns={b: "qtd_" + b.lower().replace("#", "_") for b in BRANDS},
        money_scale=4,
        **overrides,
    )


SUPPLIER_SPEC = _spec()
CUSTOMER_SPEC = _spec(entity="customer_id", entity_on="orders")


def book_tables(spark: SparkSession, sf_dir: str, entity: str = "supplier") -> BookTables:
    """Orders, items, products, reviews and geography under the names of the base tables."""
    c = F.col
    lineitem = table(spark, sf_dir, "lineitem")
    shipped = lineitem.groupBy(c("l_orderkey").alias("order_id")).agg(
        F.max("l_shipdate").alias("order_delivered_customer_date")
    )
    orders = (
        table(spark, sf_dir, "orders")
        .select(
            c("o_orderkey").alias("order_id"),
            c("o_custkey").alias("customer_id"),
            c("o_orderstatus").alias("order_status"),
            c("o_orderdate").alias("order_purchase_timestamp"),
            c("o_orderdate").alias("order_approved_at"),
            F.expr("o_orderdate + INTERVAL 60 DAYS").alias("order_estimated_delivery_date"),
        )
        .join(shipped, "order_id", "left")
    )
    items = lineitem.select(
        c("l_orderkey").alias("order_id"),
        c("l_partkey").alias("product_id"),
        c("l_suppkey").alias("seller_id"),
        c("l_extendedprice").alias("price"),
        (c("l_extendedprice") * c("l_tax")).alias("freight_value"),
    )
    products = table(spark, sf_dir, "part").select(
        c("p_partkey").alias("product_id"), c("p_brand").alias("product_category_name")
    )
    reviews = table(spark, sf_dir, "events").select(
        c("event_id").alias("review_id"),
        F.call_function("div", c("event_id"), F.lit(2)).alias("order_id"),
        (1 + F.pmod(F.floor("value"), F.lit(5))).cast("int").alias("review_score"),
    )
    return BookTables(orders, items, products, reviews, _geography(spark, sf_dir, entity))


def _geography(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    c = F.col
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), c("n_regionkey") == c("r_regionkey")
    ).select("n_nationkey", c("r_name").alias("seller_city"), c("n_name").alias("seller_state"))
    if entity == "supplier":
        base = table(spark, sf_dir, "supplier").select(
            c("s_suppkey").alias("seller_id"), c("s_nationkey").alias("n_nationkey")
        )
    else:
        base = table(spark, sf_dir, "customer").select(
            c("c_custkey").alias("customer_id"), c("c_nationkey").alias("n_nationkey")
        )
    return base.join(places, "n_nationkey", "left").drop("n_nationkey")
