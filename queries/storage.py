"""Loading, appending and stored vintages: written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries.book import ABT_DATES, CUSTOMER_SPEC, SUPPLIER_DATE, SUPPLIER_DATES, SUPPLIER_SPEC
from queries.registry import ORACLES, query
from tidemark.operators.encode import apply_saved_levels, apply_saved_one_hot, one_hot_and_save, save_levels
from tidemark.plans.book import build_book
from tidemark.plans.jobs import abt_job, book_increment_job, book_job, store_tables
from tidemark.session import configure_wide, shared_path
from tidemark.sources.fixtures import book_tables, table
from tidemark.sources.loading import append_table, load_table


def _write_csv(df, path: str) -> None:
    """One file with the rows in order."""
    df.coalesce(1).write.option("header", True).option("quote", '"').option("escape", '"').csv(path)


@query(
    "load_and_append",
    """SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, CAST(s_nationkey AS INTEGER) AS seller_zip_code_prefix,
         CASE WHEN s_suppkey % 3 <> 0 THEN 'a "quoted", line' ELSE 'late' END AS seller_city, s_name AS seller_state
       FROM supplier""",
)
def _(spark, sf_dir):
    """Two thirds of the suppliers are loaded, then all are appended; repeated keys keep their first row."""
    suppliers = table(spark, sf_dir, "supplier")

    def rows(city, where="true"):
        return suppliers.where(where).select(
            F.col("s_suppkey").alias("seller_id"),
            F.col("s_nationkey").alias("seller_zip_code_prefix"),
            F.lit(city).alias("seller_city"),
            F.col("s_name").alias("seller_state"),
        )

    first, second, out = (shared_path(spark) for _ in range(3))
    _write_csv(rows('a "quoted", line', "s_suppkey % 3 <> 0").unionByName(rows("repeated", "s_suppkey % 3 = 1")), first)
    _write_csv(rows("late").unionByName(rows("repeated")), second)
    load_table(spark, "tb_sellers", first, out)
    return append_table(spark, "tb_sellers", second, out)


@query("book_stored", ORACLES["book_supplier"])
def _(spark, sf_dir):
    """A second run of the job replaces the vintage."""
    path = shared_path(spark)
    book_job(book_tables(spark, sf_dir), [SUPPLIER_DATE], path, SUPPLIER_SPEC)
    return book_job(book_tables(spark, sf_dir), [SUPPLIER_DATE], path, SUPPLIER_SPEC)


@query("book_copartitioned", ORACLES["book_multi_vintage"])
def _(spark, sf_dir):
    """Twelve vintages over orders, items and reviews in buckets of the order id."""
    path = shared_path(spark)
    tables = store_tables(book_tables(spark, sf_dir), path, SUPPLIER_SPEC, 16, f"book_{path[-8:]}")
    return build_book(tables, SUPPLIER_DATES, SUPPLIER_SPEC)


@query("book_increments", ORACLES["book_multi_vintage"])
def _(spark, sf_dir):
    """The same vintages, four runs of three that carry the first sales from one to the next."""
    path, state, files = (shared_path(spark) for _ in range(3))
    tables = store_tables(book_tables(spark, sf_dir), files, SUPPLIER_SPEC, 16, f"book_{files[-8:]}")
    for i in range(0, len(SUPPLIER_DATES), 3):
        book = book_increment_job(tables, SUPPLIER_DATES[i : i + 3], path, state, SUPPLIER_SPEC)
    return book


@query("abt_stored", ORACLES["abt_customer"])
def _(spark, sf_dir):
    """The base table from a stored book."""
    tables, path = book_tables(configure_wide(spark), sf_dir, "customer"), shared_path(spark)
    book_job(tables, ABT_DATES, path, CUSTOMER_SPEC)
    return abt_job(spark, tables, path, shared_path(spark), CUSTOMER_SPEC)


@query(
    "one_hot_saved",
    """SELECT p_size, CAST(p_retailprice AS DOUBLE) AS p_retailprice, CAST(p_partkey AS BIGINT) AS p_partkey,
         count(*) OVER (PARTITION BY p_brand) AS same_brand, 1 AS brands_set FROM part""",
)
def _(spark, sf_dir):
    """Save a one-hot encoder, load it and apply it: one brand is set in every row."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice", "p_brand")
    path = shared_path(spark)
    one_hot_and_save(part, "p_partkey", path)
    coded = apply_saved_one_hot(part, path, "p_partkey")
    brands = [c for c in coded.columns if c.startswith("p_brand_")]
    sizes = coded.agg(*[F.sum(F.col(f"`{b}`").cast("long")).alias(f"n{i}") for i, b in enumerate(brands)]).first()
    same = sum((F.col(f"`{b}`") * F.lit(sizes[i]) for i, b in enumerate(brands)), F.lit(0).cast("long"))
    return coded.select(
        "p_size",
        "p_retailprice",
        "p_partkey",
        same.alias("same_brand"),
        sum((F.col(f"`{b}`").cast("int") for b in brands), F.lit(0)).alias("brands_set"),
    )


@query(
    "one_hot_sparse_saved",
    """WITH k AS (SELECT *, CAST(l_orderkey AS VARCHAR) AS a, CAST(l_partkey AS VARCHAR) AS b FROM lineitem)
       SELECT l_orderkey, l_partkey, l_linenumber,
         CAST(dense_rank() OVER (ORDER BY a) - 1 AS INTEGER) AS order_place,
         CAST(dense_rank() OVER (ORDER BY b) - 1 AS INTEGER) AS part_place,
         CAST((SELECT count(DISTINCT a) FROM k) AS INTEGER) AS order_levels,
         CAST((SELECT count(DISTINCT b) FROM k) AS INTEGER) AS part_levels FROM k""",
)
def _(spark, sf_dir):
    """A saved level table with a level per order and per part, applied as sparse vectors."""
    c, path = F.col, shared_path(spark)
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        c("l_orderkey").cast("string").alias("a"),
        c("l_partkey").cast("string").alias("b"),
    )
    save_levels(rows, ["a", "b"], path)
    coded = apply_saved_levels(rows, ["a", "b"], path)
    sparse = {name: F.unwrap_udt(c(name)) for name in ("a", "b")}
    return coded.select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        F.get(sparse["a"]["indices"], F.lit(0)).alias("order_place"),
        F.get(sparse["b"]["indices"], F.lit(0)).alias("part_place"),
        sparse["a"]["size"].alias("order_levels"),
        sparse["b"]["size"].alias("part_levels"),
    )
