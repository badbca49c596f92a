"""Hand-made cases of the feature book, the label and the vintage tables."""

import re
import time
from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from queries import book, load_all
from queries.registry import QUERIES
from tidemark.plans.book import BookTables, build_book, first_sales
from tidemark.plans.jobs import abt_job, book_increment_job, book_job, store_tables
from tidemark.plans.label import build_abt, label_inactivity, monthly_activity
from tidemark.plans.spec import BookSpec, month_starts, shift_months
from tidemark.session import configure_wide, materialize, shared_path
from tidemark.sources.fixtures import CUSTOMER_SPEC, SUPPLIER_SPEC, book_tables
from tidemark.sources.tables import latest_vintage, read_vintages, write_vintages

D = date(2018, 1, 1)
SF = "/root/testdata/sf0.001"


def ts(text):
    return datetime.fromisoformat(text)


def make(spark, orders, items, reviews=(), products=(("p1", "bebes"), ("p2", "unlisted"), ("p3", None))):
    o = spark.createDataFrame(
        [(i, "c", s, a, a, dlv, est) for i, s, a, dlv, est in orders],
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp,"
        " order_approved_at timestamp, order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp",
    )
    i = spark.createDataFrame(
        items, "order_id string, product_id string, seller_id string, price double, freight_value double"
    )
    p = spark.createDataFrame(list(products), "product_id string, product_category_name string")
    r = spark.createDataFrame(list(reviews), "review_id string, order_id string, review_score int")
    g = spark.createDataFrame([("s1", "town", "ST")], "seller_id string, seller_city string, seller_state string")
    return BookTables(o, i, p, r, g)


def order(i, at, status="delivered", delivered=None, due=None):
    return (i, status, ts(at), delivered and ts(delivered), due and ts(due))


def one(df, seller="s1"):
    rows = df.where(F.col("seller_id") == seller).collect()
    assert len(rows) == 1
    return rows[0]


def test_window_is_half_open(spark):
    tables = make(
        spark,
        [
            order("a", "2017-07-01T00:00:00"),
            order("b", "2017-12-31T23:59:59"),
            order("c", "2018-01-01T00:00:00"),
            order("d", "2017-06-30T23:59:59"),
            order("e", "2017-10-01T00:00:00", status="shipped"),
        ],
        [(k, "p1", "s1", 10.0, 1.0) for k in "abcde"],
    )
    row = one(build_book(tables, [D]))
    assert row.qtd_vendas == 2 and row.receita_tot == 20.0
    # The first sale lies before the window but still sets the age.
    assert row.idade_dias_base == pytest.approx(184.0, abs=0.01)
    assert row.seller_city == "town"


def test_items_and_reviews_multiply(spark):
    tables = make(
        spark,
        [order("a", "2017-12-01T00:00:00", delivered="2017-12-20T00:00:00", due="2017-12-10T00:00:00")],
        [("a", "p1", "s1", 10.0, 1.0), ("a", "p2", "s1", 30.0, 2.0)],
        [("r1", "a", 5), ("r2", "a", 2), ("r3", "a", None)],
    )
    row = one(build_book(tables, [D]))
    assert row.receita_tot == 120.0 and row.receita_frete_total == 9.0
    assert row.qtd_prod_vend == 6 and row.qtd_prod_dst_vend == 2 and row.qtd_vendas == 1
    assert row.qtd_avaliacoes_recebidas == 3 and row.review_score_medio == 3.5
    assert row.prop_reviews_positivos == 0.33 and row.qtd_atraso == 6 and row.prop_atraso == 6
    assert row.media_dias_atraso == 10.0 and row.qtd_bebes == 3 and row.qtd_outros == 3
    once = one(build_book(tables, [D], fanout="preaggregate"))
    assert once.receita_tot == 40.0 and once.qtd_prod_vend == 2 and once.qtd_atraso == 1
    assert once.review_score_medio == 3.5 and once.qtd_bebes == 1


def test_missing_category_counts_nowhere_and_zero_price_divides_to_null(spark):
    tables = make(
        spark,
        [order("a", "2017-12-01T00:00:00")],
        [("a", "p3", "s1", 0.0, 1.0), ("a", None, "s1", 0.0, 1.0)],
    )
    row = one(build_book(tables, [D]))
    assert row.qtd_outros == 0 and row.qtd_prod_vend == 1 and row.qtd_prod_dst_vend == 1
    assert row.proporcao_frete_sobre_vendas is None and row.review_score_medio is None
    assert row.qtd_avaliacoes_recebidas == 0 and row.prop_reviews_positivos is None


def test_order_without_items_is_the_null_group(spark):
    tables = make(
        spark,
        [order("a", "2017-12-01T00:00:00"), order("b", "2017-12-02T00:00:00")],
        [("a", "p1", "s1", 5.0, 1.0)],
        [("r1", "b", 4)],
    )
    book = build_book(tables, [D])
    row = book.where("seller_id IS NULL").collect()[0]
    assert row.qtd_vendas == 0 and row.qtd_avaliacoes_recebidas == 1 and row.receita_tot is None
    assert row.idade_dias_base is None and row.perc_tempo_ativado is None and row.prop_atraso is None
    assert row.meses_ativado == 1 and row.qtd_prod_vend == 0 and row.med_prod_por_vendas is None
    kept = label_inactivity(book, tables, null_entity="parity").where("seller_id IS NULL").collect()
    assert len(kept) == 1 and kept[0].flag_churn_3m == 1 and kept[0].dt_ref is None
    assert build_abt(tables, [D]).where("seller_id IS NULL").count() == 0
    assert build_book(tables, [D], null_entity=False).count() == 1


def test_seven_calendar_months_in_a_mid_month_window(spark):
    stamps = ["2017-08-20", "2017-09-20", "2017-10-20", "2017-11-20", "2017-12-20", "2018-01-20", "2018-02-10"]
    tables = make(
        spark,
        [order(str(i), f"{s}T00:00:00") for i, s in enumerate(stamps)],
        [(str(i), "p1", "s1", 5.0, 1.0) for i in range(7)],
    )
    row = one(build_book(tables, [date(2018, 2, 15)]))
    assert row.meses_ativado == 7 and row.perc_tempo_ativado == round(7 / 6, 2)


def test_label_looks_at_four_months_from_a_month_start(spark):
    for month, flag in (("2018-04-30", 0), ("2018-05-01", 1), ("2018-01-01", 0)):
        tables = make(
            spark,
            [order("a", "2017-12-01T00:00:00"), order("b", f"{month}T12:00:00")],
            [("a", "p1", "s1", 5.0, 1.0), ("b", "p1", "s1", 5.0, 1.0)],
        )
        assert one(build_abt(tables, [D])).flag_churn_3m == flag


def test_label_agrees_with_an_anti_join(spark):
    tables = book_tables(spark, SF)
    dates = month_starts(date(2000, 1, 1), date(2001, 9, 1))
    book = build_book(tables, dates, SUPPLIER_SPEC).select("dt_ref", "seller_id")
    flagged = label_inactivity(book, tables, SUPPLIER_SPEC)
    active = monthly_activity(tables, SUPPLIER_SPEC).withColumnRenamed("seller_id", "s")
    near = (F.col("seller_id") == F.col("s")) & F.col("dt_venda").between(F.col("dt_ref"), F.add_months("dt_ref", 3))
    idle = book.where("seller_id IS NOT NULL").join(active, near, "left_anti")
    ones = flagged.where("flag_churn_3m = 1").drop("flag_churn_3m")
    assert ones.exceptAll(idle).count() == 0 and idle.exceptAll(ones).count() == 0


def test_many_dates_equal_single_dates(spark):
    tables = book_tables(spark, SF)
    dates = [date(1997, 1, 1), date(1997, 2, 1), date(1997, 5, 17)]
    together = build_book(tables, dates, SUPPLIER_SPEC)
    apart = build_book(tables, dates[:1], SUPPLIER_SPEC)
    for d in dates[1:]:
        apart = apart.unionByName(build_book(tables, [d], SUPPLIER_SPEC))
    assert together.exceptAll(apart).count() == 0 and apart.exceptAll(together).count() == 0


def test_shuffled_joins_and_hot_keys_give_the_same_book(spark):
    """A third of all items in one order, one seller, one product; no broadcast joins."""
    hot = [("o0", "p1", "s1", 1.0, 0.5)] * 300
    rest = [(f"o{i}", f"p{i % 3 + 1}", f"s{i % 50}", float(i), 1.0) for i in range(1, 600)]
    tables = make(
        spark,
        [order(f"o{i}", "2017-11-05T10:00:00") for i in range(620)],
        hot + rest,
        [(f"r{i}", f"o{i % 40}", i % 5 + 1) for i in range(200)],
    )
    want = {tuple(r) for r in build_book(tables, [D]).collect()}
    old = {
        k: spark.conf.get(k)
        for k in (
            "spark.sql.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes",
        )
    }
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "1KB")
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1KB")
        got = {tuple(r) for r in build_book(tables, [D]).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == want
    row = one(build_book(tables, [D]))
    # 300 items seen with 5 reviews each, plus the seller's other items.
    other = [r for r in rest if r[2] == "s1"]
    weight = lambda o: max(sum(1 for i in range(200) if f"o{i % 40}" == o), 1)
    assert row.receita_tot == 300 * 5 + sum(r[3] * weight(r[0]) for r in other)


def test_rerun_leaves_the_table_unchanged_and_append_does_not(spark, tmp_path):
    tables = book_tables(spark, SF)
    book, abt = str(tmp_path / "book"), str(tmp_path / "abt")
    dates = [date(1997, 1, 1), date(1997, 2, 1)]
    n = book_job(tables, dates, book, SUPPLIER_SPEC).count()
    assert book_job(tables, dates[1:], book, SUPPLIER_SPEC).count() == n
    m = abt_job(spark, tables, book, abt, SUPPLIER_SPEC).count()
    assert abt_job(spark, tables, book, abt, SUPPLIER_SPEC, dates=dates[:1]).count() == m
    assert latest_vintage(read_vintages(spark, abt)).select("dt_ref").distinct().collect()[0][0] == dates[1]
    write_vintages(read_vintages(spark, book).where(F.col("dt_ref") == dates[0]), book, mode="append")
    assert read_vintages(spark, book).count() > n


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def test_stored_book_and_base_table_leave_no_shuffle_files(spark, tmp_path):
    tables = book_tables(spark, SF, "customer")
    dates = month_starts(date(1997, 1, 1), date(1997, 3, 1))
    built, before = build_abt(tables, dates, CUSTOMER_SPEC).collect(), _shuffle_files(spark)
    path = str(tmp_path / "book")
    book_job(tables, dates, path, CUSTOMER_SPEC)
    done = abt_job(spark, tables, path, str(tmp_path / "abt"), CUSTOMER_SPEC)
    until = time.monotonic() + 20
    while (left := _shuffle_files(spark) - before) and time.monotonic() < until:
        time.sleep(0.2)  # they are removed behind the job
    assert not left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert sorted(map(str, done.select(*built[0].__fields__).collect())) == sorted(map(str, built))


def test_latest_vintage_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(10).withColumn("dt_ref", F.expr("date_add(DATE'2018-01-01', CAST(id AS int))"))
    write_vintages(df, path)
    latest = latest_vintage(read_vintages(spark, path))
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt_ref" in plan and latest.count() == 1


def test_months_clamp():
    assert shift_months(date(2017, 8, 31), -6) == date(2017, 2, 28)
    assert shift_months(date(2017, 11, 30), 3) == date(2018, 2, 28)
    assert month_starts(date(2017, 11, 5), date(2018, 1, 1)) == [date(2017, 12, 1), date(2018, 1, 1)]


def test_filters_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = (
        build_book(book_tables(spark, SF), [date(1998, 1, 1)], SUPPLIER_SPEC)
        ._jdf.queryExecution()
        .executedPlan()
        .toString()
    )
    assert "EqualTo(o_orderstatus,F)" in plan and "LessThan(o_orderdate," in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_unknown_options_are_refused(spark):
    tables = make(spark, [order("a", "2017-12-01T00:00:00")], [("a", "p1", "s1", 1.0, 1.0)])
    with pytest.raises(ValueError):
        build_book(tables, [D], fanout="other")
    with pytest.raises(ValueError):
        build_book(tables, [], BookSpec())


def test_queries_of_all_metrics_leave_none_out(spark):
    load_all()
    metrics = set(book.customer_abt(spark, SF).columns) - {"customer_id", "dt_ref", "flag_churn_3m"}
    assert len(metrics) == 50  # 48 and two places
    assert {r["Variavel"] for r in QUERIES["iv_table_abt_all"](spark, SF).collect()} == metrics
    assert set(QUERIES["book_preaggregated_all"](spark, SF).columns) == metrics | {"dt_ref", "seller_id"}


def test_generated_code_of_wide_rows_stays_small_enough_to_be_compiled(spark):
    """the JVM never compiles a method of more than 8,000 bytes."""
    book_tables(configure_wide(spark), SF)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def _stored(spark, entity, spec):
    path = shared_path(spark)
    return store_tables(book_tables(spark, SF, entity), path, spec, 4, f"book_{path[-8:]}")


def test_orders_are_computed_once_for_the_stored_tables(spark):
    tables = book_tables(spark, SF)
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def status(text):
        seen.add(1)
        return text

    orders = materialize(tables.orders)
    looked = orders.withColumn("order_approved_at", F.when(status("order_status").isNotNull(), F.col("order_approved_at")))
    path = shared_path(spark)
    store_tables(replace(tables, orders=looked), path, SUPPLIER_SPEC, 4, f"book_{path[-8:]}")
    assert seen.value == orders.count()


def test_base_table_is_dealt_into_many_small_shares(spark):
    QUERIES["abt_customer"](spark, SF)
    assert int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) >= 1024
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "8MB"
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) == 4


@pytest.mark.parametrize("entity, spec", [("supplier", SUPPLIER_SPEC), ("customer", CUSTOMER_SPEC)])
def test_increments_equal_the_full_build(spark, entity, spec):
    tables = _stored(spark, entity, spec)
    # A gap longer than the window, a day inside a month, and a run that comes twice.
    runs = [[date(1996, 3, 1)], [date(1996, 4, 15), date(1996, 5, 1)], [date(1997, 6, 1)], [date(1997, 6, 1)], [date(1997, 7, 1)]]
    path, state = shared_path(spark), shared_path(spark)
    for dates in runs:
        got = book_increment_job(tables, dates, path, state, spec)
    days = sorted({d for r in runs for d in r})
    full = build_book(book_tables(spark, SF, entity), days, spec).select(*got.columns)
    assert sorted(map(str, got.collect())) == sorted(map(str, full.collect()))
    kept = {r.through for r in spark.read.parquet(state).select("through").distinct().collect()}
    assert kept == {r[-1] for r in runs}


def test_increment_reads_only_recent_orders(spark):
    tables = _stored(spark, "supplier", SUPPLIER_SPEC)
    known = materialize(first_sales(tables, SUPPLIER_SPEC, date(1998, 1, 1)))
    with pytest.raises(ValueError):
        build_book(tables, [date(1998, 1, 1)], SUPPLIER_SPEC, first_sales=known, since=date(1997, 7, 2))
    book = build_book(tables, [date(1998, 1, 1)], SUPPLIER_SPEC, first_sales=known, since=date(1997, 7, 1))
    scans = [line for line in _plan(book).splitlines() if "PushedFilters" in line and "Bucketed: true" in line]
    # Two reads each of orders, items and reviews, all from the day on.
    assert len(scans) == 6
    assert all("GreaterThanOrEqual(order_approved_at,1997" in s for s in scans)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_tables_meet_without_a_shuffle(spark):
    tables = _stored(spark, "supplier", SUPPLIER_SPEC)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = _plan(build_book(tables, [date(1998, 1, 1)], SUPPLIER_SPEC, null_entity=True))
        plain = _plan(build_book(book_tables(spark, SF), [date(1998, 1, 1)], SUPPLIER_SPEC, null_entity=True))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)

    def by_order(plan):
        return [x for x in plan.splitlines() if re.search(r"Exchange hashpartitioning\((order_id|l_orderkey|o_orderkey|_groupingexpression)#\d+L?, \d+\)", x)]

    assert by_order(plain) and not by_order(stored)
    assert "Bucketed: true" in stored or "SelectedBucketsCount" in stored
