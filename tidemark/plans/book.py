"""Per-entity feature book at one or many reference dates, in one job.

Shape of the job.  The reference dates and their window starts cut time into segments; an
order falls into exactly one segment, and every window is a run of segments.  Items are joined
once to the orders of the whole history, reviews having been summed per order before the join.
The joined rows are then aggregated twice in one pass (grouping sets), per (entity, order) and
per (entity, product), which replaces the row multiplication "items x reviews" and the distinct
counts by weighted sums: an order seen with ``r`` reviews counts each of its items ``max(r, 1)``
times.  These are summed per (entity, segment), and only those sums are expanded to reference
dates.

Hot keys.  The item join is an inner join, whose both sides adaptive execution may split;
orders without items come from an anti-join against distinct order ids.  All groupings combine
on the map side, so no key, however frequent, is gathered in one task.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.scalars import count_below
from tidemark.plans.spec import BookSpec, shift_months
from tidemark.session import materialize

# Grain of an aggregate row.
_NO_ITEM, _BY_ORDER, _BY_PRODUCT = 0, 1, 2


@dataclass(frozen=True)
class BookTables:
    """Input frames; ``geo`` is keyed by the entity and may be absent."""

    orders: DataFrame
    items: DataFrame
    products: DataFrame
    reviews: DataFrame
    geo: DataFrame | None = None


@dataclass(frozen=True)
class Timeline:
    """Segments of time cut by the reference dates and their window starts."""

    dates: tuple[date, ...]
    cuts: tuple[date, ...]
    window_months: int

    @classmethod
    def of(cls, dates: list[date], window_months: int) -> "Timeline":
        if not dates:
            raise ValueError("at least one reference date is needed")
        days = tuple(sorted(set(dates)))
        cuts = sorted({c for d in days for c in (d, shift_months(d, -window_months))})
        return cls(days, tuple(cuts), window_months)

    def segment(self, ts: Column) -> Column:
        """0 before every window, else the position of the last cut at or before ``ts``."""
        micros = F.unix_micros(ts.cast("timestamp"))
        return count_below(micros, [_micros(c) for c in self.cuts], inclusive=True)

    def _spans(self) -> list[tuple[date, int, int]]:
        """(date, first segment, end segment) of every window."""
        position = {c: i + 1 for i, c in enumerate(self.cuts)}
        return [(d, position[shift_months(d, -self.window_months)], position[d]) for d in self.dates]

    def covering(self) -> str:
        """Literal array: for each segment the (dt_ref, first segment of its window) pairs."""
        empty = "CAST(array() AS array<struct<dt_ref: date, first_seg: int>>)"
        cells = []
        for seg in range(len(self.cuts) + 1):
            hits = [
                f"named_struct('dt_ref', DATE'{d.isoformat()}', 'first_seg', {lo})"
                for d, lo, hi in self._spans()
                if lo <= seg < hi
            ]
            cells.append(f"array({', '.join(hits)})" if hits else empty)
        return f"array({', '.join(cells)})"

    def earliest(self) -> str:
        """Literal array: for each segment the first segment of the windows covering it."""
        starts = [
            min((lo for _, lo, hi in self._spans() if lo <= seg < hi), default=seg)
            for seg in range(len(self.cuts) + 1)
        ]
        return f"array({', '.join(map(str, starts))})"


def _micros(day: date) -> int:
    return (day - date(1970, 1, 1)).days * 86_400_000_000


def _days(later: str, earlier: str) -> str:
    return f"(unix_micros({later}) - unix_micros({earlier})) / 86400000000D"


# One bit per calendar month, so that OR-ing counts distinct months without a shuffle.
_MONTH_BIT = "shiftleft(1, month(approved) - 1)"

# Order-grain measures, before they are weighted.
_REVIEW_SUMS = {
    "s_scored": "r_scored",
    "s_score": "r_sum",
    "s_ids": "r_ids",
    "s_good": "r_good",
    "s_poor": "r_poor",
}
_DELAY_SUMS = {
    "s_rows": "{w}",
    "s_late": "late * {w}",
    "s_days_late": "days_late * {w}",
    "s_days_planned": "days_planned * {w}",
    "s_planned": "CASE WHEN days_planned IS NOT NULL THEN {w} END",
}
_ORDER_MEASURES = [*_REVIEW_SUMS, *_DELAY_SUMS]
# Item-grain measures: rows, rows with a product, priced rows and money.
_ITEM_MEASURES = {
    "m_rows": "{w}",
    "m_products": "CASE WHEN product IS NOT NULL THEN {w} END",
    "m_priced": "CASE WHEN price IS NOT NULL THEN {w} END",
    "m_price": "price * {w}",
    "m_freighted": "CASE WHEN freight IS NOT NULL THEN {w} END",
    "m_freight": "freight * {w}",
}


def _order_measures(weight: str) -> list[str]:
    sums = {**_REVIEW_SUMS, **{k: v.format(w=weight) for k, v in _DELAY_SUMS.items()}}
    return [f"{v} AS {k}" for k, v in sums.items()]


def build_book(
    tables: BookTables,
    dates: list[date],
    spec: BookSpec = BookSpec(),
    fanout: str = "reference",
    null_entity: bool = True,
    first_sales: DataFrame | None = None,
    since: date | None = None,
    stored: bool = False,
) -> DataFrame:
    """Feature book at grain (entity, dt_ref).

    ``fanout="reference"`` keeps the weights that joining items and reviews per order gives;
    ``"preaggregate"`` counts every item, order and review once.  Orders without items, or items
    without an entity, form one group with a NULL entity unless ``null_entity`` is off.

    Beyond the windows only an entity's first sale matters.  With ``first_sales`` (entity, first_at),
    which cover all orders before some day, orders before ``since`` are not read; it must lie neither
    after that day nor after the start of any window.

    ``stored`` writes the sums per entity and segment to the shared folder first, so that the joins
    before them and the wide rows behind them are on disk in different jobs.
    """
    if fanout not in ("reference", "preaggregate"):
        raise ValueError(f"unknown fanout {fanout!r}")
    line = Timeline.of(dates, spec.window_months)
    if since is not None:
        if since > line.cuts[0]:
            raise ValueError(f"orders from {line.cuts[0]} on are needed, not from {since}")
        tables = recent(tables, since, spec)
    if not null_entity:
        kept = f"{spec.entity} IS NOT NULL"
        if spec.entity_on == "orders":
            tables = replace(tables, orders=tables.orders.where(kept))
        else:
            tables = replace(tables, items=tables.items.where(kept))
    orders = _order_facts(tables, line, spec)
    parts = _item_facts(tables, orders, line, spec, fanout)
    if null_entity or spec.entity_on == "orders":
        parts = parts.unionByName(_itemless_facts(tables, line, spec), allowMissingColumns=True)
    placed = _per_segment(parts, line, len(spec.categories))
    metrics = _per_vintage(materialize(placed) if stored else placed, line, spec, first_sales)
    return _with_geo(metrics, tables.geo, spec)


def recent(tables: BookTables, since: date, spec: BookSpec) -> BookTables:
    """Only orders approved from ``since`` on; items and reviews too where they carry that time."""

    def cut(df: DataFrame) -> DataFrame:
        return df.where(f"{spec.approved} >= DATE'{since.isoformat()}'") if spec.approved in df.columns else df

    return replace(tables, orders=cut(tables.orders), items=cut(tables.items), reviews=cut(tables.reviews))


def first_sales(tables: BookTables, spec: BookSpec, before: date, since: date | None = None) -> DataFrame:
    """(entity, first_at): first delivered order of every entity, of those before the day and from ``since`` on."""
    if since is not None:
        tables = recent(tables, since, spec)
    delivered = f"{spec.status} = '{spec.status_value}' AND {spec.approved} < DATE'{before.isoformat()}'"
    sold = tables.orders.where(delivered).selectExpr(
        f"{spec.order_id} AS order_id",
        *([f"{spec.entity} AS entity"] if spec.entity_on == "orders" else []),
        f"CAST({spec.approved} AS timestamp) AS approved",
    )
    if spec.entity_on != "orders":
        sold = tables.items.selectExpr(f"{spec.order_id} AS order_id", f"{spec.entity} AS entity").join(sold, "order_id")
    return sold.where("entity IS NOT NULL").groupBy("entity").agg(F.min("approved").alias("first_at"))


def _order_facts(tables: BookTables, line: Timeline, spec: BookSpec) -> DataFrame:
    """Delivered orders before the last reference date with their review sums."""
    entity = [f"{spec.entity} AS entity"] if spec.entity_on == "orders" else []
    late = "coalesce(estimated < delivered, false)"
    orders = (
        tables.orders.where(
            f"{spec.status} = '{spec.status_value}' AND {spec.approved} < DATE'{line.dates[-1].isoformat()}'"
        )
        .selectExpr(
            f"{spec.order_id} AS order_id",
            *entity,
            f"CAST({spec.approved} AS timestamp) AS approved",
            f"CAST({spec.purchased} AS timestamp) AS purchased",
            f"CAST({spec.delivered} AS timestamp) AS delivered",
            f"CAST({spec.estimated} AS timestamp) AS estimated",
        )
        .withColumn("segment", line.segment(F.col("approved")))
        .selectExpr(
            "order_id",
            *(["entity"] if entity else []),
            "approved",
            "segment",
            f"CAST({late} AS bigint) AS late",
            f"CASE WHEN {late} THEN {_days('delivered', 'estimated')} ELSE 0D END AS days_late",
            f"{_days('estimated', 'purchased')} AS days_planned",
        )
    )
    score = spec.review_score
    reviews = tables.reviews.sparkSession.sql(
        f"""
        SELECT {spec.order_id} AS order_id, count(1) AS r_rows, count({spec.review_id}) AS ids,
               count({score}) AS scored, CAST(sum({score}) AS double) AS total,
               CAST(max({score}) AS double) AS r_max, CAST(min({score}) AS double) AS r_min,
               count(CASE WHEN {score} >= 4 THEN 1 END) AS good, count(CASE WHEN {score} < 4 THEN 1 END) AS poor
        FROM {{reviews}} GROUP BY {spec.order_id}
        """,
        reviews=tables.reviews,
    )
    return orders.join(reviews, "order_id", "left").selectExpr(
        *orders.columns,
        "r_max",
        "r_min",
        "coalesce(ids, 0L) AS r_ids",
        "coalesce(scored, 0L) AS r_scored",
        "coalesce(total, 0D) AS r_sum",
        "coalesce(good, 0L) AS r_good",
        "coalesce(poor, 0L) AS r_poor",
        "greatest(coalesce(r_rows, 0L), 1L) AS weight",
    )


def _item_facts(
    tables: BookTables, orders: DataFrame, line: Timeline, spec: BookSpec, fanout: str
) -> DataFrame:
    """Aggregates per (entity, segment, order) and per (entity, segment, product)."""
    entity = [] if spec.entity_on == "orders" else [f"{spec.entity} AS entity"]
    scale = spec.money_scale

    def units(money: str) -> str:
        # Whole units, so that sums do not depend on row order.
        return f"CAST(rint({money} * {10**scale}D) AS bigint)"

    items = tables.items.selectExpr(
        f"{spec.order_id} AS order_id",
        *entity,
        f"{spec.product} AS product",
        f"{units(spec.price)} AS price",
        f"{units(spec.freight)} AS freight",
    )
    weight = "weight" if fanout == "reference" else "1L"
    # Order measures repeat on every item of an order: summing them over items keeps the
    # row-multiplying reading, one value per (entity, order) gives the corrected one.
    per_order, order_grain = ("sum", 0) if fanout == "reference" else ("max", 1)
    # Orders before every window only matter for the first sale; they collapse to one key each.
    measured = items.join(orders, "order_id", "inner").selectExpr(
        "entity",
        "segment",
        "approved",
        "CASE WHEN segment > 0 THEN order_id END AS order_id",
        "CASE WHEN segment > 0 THEN product END AS product",
        *[f"{v.format(w=weight)} AS {k}" for k, v in _ITEM_MEASURES.items()],
        "r_ids",
        "r_max",
        "r_min",
        *_order_measures(weight),
    )
    facts = tables.items.sparkSession.sql(
        f"""
        SELECT entity, segment, order_id, product, first_at, last_at, months, r_max, r_min,
          CASE WHEN of_order = 1 THEN {_BY_ORDER} ELSE {_BY_PRODUCT} END AS grain,
          CASE WHEN of_order = 1 AND segment > 0 THEN 1L ELSE 0L END AS n_orders,
          CASE WHEN of_order = 1 THEN o_reviews END AS n_reviews,
          {", ".join(f"CASE WHEN of_order = 0 THEN {m} END AS {m}" for m in _ITEM_MEASURES)},
          {", ".join(f"CASE WHEN of_order = {order_grain} THEN {m} END AS {m}" for m in _ORDER_MEASURES)}
        FROM (
          SELECT entity, segment, order_id, product, grouping(product) AS of_order,
            min(approved) AS first_at, max(approved) AS last_at, bit_or({_MONTH_BIT}) AS months,
            max(r_ids) AS o_reviews, max(r_max) AS r_max, min(r_min) AS r_min,
            {", ".join(f"sum({m}) AS {m}" for m in _ITEM_MEASURES)},
            {", ".join(f"{per_order}({m}) AS {m}" for m in _ORDER_MEASURES)}
          FROM {{measured}}
          GROUP BY GROUPING SETS ((entity, segment, order_id), (entity, segment, product)))
        """,
        measured=measured,
    )
    facts = _with_category(facts, tables.products, spec)
    if len(line.dates) == 1:
        return facts.withColumn("prev_segment", F.lit(None).cast("int"))
    # A product sold in several segments of a window counts once: remember its previous segment.
    return facts.selectExpr(
        "*",
        """lag(CASE WHEN segment > 0 THEN segment END)
           OVER (PARTITION BY grain, entity, product, order_id ORDER BY segment) AS prev_segment""",
    )


def _with_category(facts: DataFrame, products: DataFrame, spec: BookSpec) -> DataFrame:
    """Product category of the per-product rows.

    Rows without a product match nothing; a second key spreads them over the partitions.
    """
    lookup = products.selectExpr(
        f"{spec.product} AS product_key",
        # Position in the named list, 0 for any other category: compared as a number later on.
        f"CAST(array_position(array({', '.join(map(_text, spec.categories))}), {spec.category}) AS int) AS category",
        f"CAST({spec.product} IS NULL AS int) AS product_spread",
    )
    keyed = facts.selectExpr(
        "*", "CASE WHEN product IS NULL THEN 1 + pmod(hash(entity, order_id), 4096) ELSE 0 END AS spread"
    )
    on = F.expr("product = product_key AND spread = product_spread")
    return keyed.join(lookup, on, "left").drop("product_key", "product_spread", "spread")


def _itemless_facts(tables: BookTables, line: Timeline, spec: BookSpec) -> DataFrame:
    """Orders that have no item at all; without an entity of their own only the windows matter.

    The anti-join comes first, so that only those orders meet their reviews.
    """
    with_items = tables.items.select(spec.order_id).distinct()
    lone = tables.orders.join(with_items, spec.order_id, "left_anti")
    lone = _order_facts(replace(tables, orders=lone), line, spec)
    if spec.entity_on != "orders":
        # No item, no entity: the group of the NULL key, typed like the items' key.
        lone = lone.where("segment > 0").withColumn(
            "entity", F.lit(None).cast(tables.items.schema[spec.entity].dataType)
        )
    return lone.sparkSession.sql(
        f"""
        SELECT entity, segment, {_NO_ITEM} AS grain, min(approved) AS first_at, max(approved) AS last_at,
          bit_or({_MONTH_BIT}) AS months, max(r_max) AS r_max, min(r_min) AS r_min,
          sum(r_ids) AS n_reviews, sum(weight) AS m_rows,
          {", ".join(f"sum({x.rsplit(' AS ', 1)[0]}) AS {x.rsplit(' AS ', 1)[1]}" for x in _order_measures("weight"))}
        FROM {{lone}} GROUP BY entity, segment
        """,
        lone=lone,
    )


def _per_segment(parts: DataFrame, line: Timeline, categories: int) -> DataFrame:
    """Sum to (entity, segment, earlier segment of the same products).

    Only that earlier segment decides in which windows a product is new, so everything else
    can be summed before it is expanded to reference dates.
    """
    first_seen = f"get({line.earliest()}, segment)"
    return parts.sparkSession.sql(
        f"""
        SELECT entity, segment, seen, min(first_at) AS first_at, max(last_at) AS last_at,
          bit_or(months) AS months, max(r_max) AS r_max, min(r_min) AS r_min,
          sum(n_orders) AS n_orders, sum(n_reviews) AS n_reviews,
          count(CASE WHEN grain = {_BY_PRODUCT} THEN product END) AS n_products,
          {", ".join(f"sum({m}) AS {m}" for m in [*_ITEM_MEASURES, *_ORDER_MEASURES])},
          {", ".join(f"sum(CASE WHEN category = {i} THEN m_rows END) AS c_{i}" for i in range(categories + 1))}
        FROM (
          SELECT *, CASE WHEN prev_segment >= {first_seen} THEN prev_segment END AS seen FROM {{parts}})
        GROUP BY entity, segment, seen
        """,
        parts=parts,
    )


def _per_vintage(segments: DataFrame, line: Timeline, spec: BookSpec, known: DataFrame | None = None) -> DataFrame:
    """Expand segment sums to reference dates and finish the metrics.

    The segment sums are placed by entity once; grouping by date and the first sale over the
    whole history, which the row without a date still holds, both reuse that placement.  An
    entity has at most a few rows per segment here.
    """
    sums = [*_ITEM_MEASURES, *_ORDER_MEASURES]
    per_category = [
        f"coalesce(sum(c_{i}), 0L) AS `{spec.category_column(c)}`" for i, c in enumerate(spec.categories, 1)
    ]
    total = segments.sparkSession.sql(
        f"""
        SELECT *, min(seen_at) OVER (PARTITION BY entity) AS first_at FROM (
          SELECT entity, vintage.dt_ref AS dt_ref, min(first_at) AS seen_at, max(last_at) AS last_at,
            bit_or(months) AS months, max(r_max) AS r_max, min(r_min) AS r_min,
            coalesce(sum(n_orders), 0L) AS n_orders, coalesce(sum(n_reviews), 0L) AS n_reviews,
            sum(CASE WHEN seen IS NULL OR seen < vintage.first_seg THEN n_products ELSE 0L END) AS n_products,
            {", ".join(f"sum({m}) AS {m}" for m in sums)},
            {", ".join(per_category)},
            coalesce(sum(c_0), 0L) AS qtd_outros
          FROM (SELECT *, explode_outer(get({line.covering()}, segment)) AS vintage FROM {{placed}})
          GROUP BY entity, vintage.dt_ref)
        """,
        placed=segments.repartition("entity"),
    )
    if known is not None:
        earlier = known.selectExpr("entity", "first_at AS known_at")
        total = total.join(earlier, "entity", "left").withColumn("first_at", F.least("first_at", "known_at"))
    named_terms = total.where("dt_ref IS NOT NULL").selectExpr("*", *_terms(spec))
    return named_terms.selectExpr("dt_ref", f"entity AS {spec.entity}", *_metrics(spec))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _terms(spec: BookSpec) -> list[str]:
    """Intermediate terms of the metrics."""
    at, unit = "CAST(dt_ref AS timestamp)", f"{10**spec.money_scale}D"
    age = f"CASE WHEN entity IS NOT NULL THEN round({_days(at, 'first_at')}, 2) END"
    months = f"1 + CAST({age} / 30 AS bigint)"
    return [
        f"{age} AS age",
        f"{months} AS age_months",
        # NULL when the age is unknown: least() alone would skip it.
        f"CASE WHEN {age} IS NOT NULL THEN least({months}, {spec.window_months}L) END AS capped",
        "CAST(bit_count(months) AS bigint) AS active",
        "coalesce(m_products, 0L) AS n_sold",
        f"m_price / {unit} AS price",
        f"m_freight / {unit} AS freight",
        f"CAST({_days(at, 'last_at')} AS bigint) AS idle",
    ]


def _metrics(spec: BookSpec) -> list[str]:
    """Metric columns.  Fixed values: their names and their order."""

    def per(top: str, bottom: str, name: str, places: int = 2) -> str:
        return f"round({top} / nullif({bottom}, 0), {places}) AS {name}"

    return [
        "n_reviews AS qtd_avaliacoes_recebidas",
        per("s_score", "s_scored", "review_score_medio"),
        "round(r_max, 2) AS review_score_max",
        "round(r_min, 2) AS review_score_min",
        per("s_good", "s_ids", "prop_reviews_positivos"),
        per("s_poor", "s_ids", "prop_reviews_negativos"),
        "age AS idade_dias_base",
        "age_months AS idade_meses_base",
        "idle AS idade_dias_ult_venda",
        "active AS meses_ativado",
        per("active", "capped", "perc_tempo_ativado"),
        "s_late AS qtd_atraso",
        "s_late div nullif(n_orders, 0) AS prop_atraso",
        per("s_days_late", "s_rows", "media_dias_atraso"),
        per("s_days_planned", "s_planned", "med_dias_entrega_estimada", 0),
        "round(price, 2) AS receita_tot",
        "n_orders AS qtd_vendas",
        per("price", "m_priced", "preco_medio_produto"),
        per("freight", "m_freighted", "frete_medio"),
        "round(freight, 2) AS receita_frete_total",
        per("m_freight", "m_price", "proporcao_frete_sobre_vendas"),
        per("price", "n_orders", "tkt_med_venda"),
        per("price", "capped", "tkt_med_venda_mes"),
        per("price", "active", "tkt_med_venda_mes_ativado"),
        "n_sold AS qtd_prod_vend",
        "n_products AS qtd_prod_dst_vend",
        per("price", "n_sold", "tkt_med_venda_prod"),
        "n_sold div nullif(n_orders, 0) AS med_prod_por_vendas",
        *[f"`{spec.category_column(cat)}`" for cat in spec.categories],
        "qtd_outros",
    ]


def _with_geo(metrics: DataFrame, geo: DataFrame | None, spec: BookSpec) -> DataFrame:
    rest = [x for x in metrics.columns if x != "dt_ref"]
    if geo is None:
        return metrics.select("dt_ref", *rest)
    lookup = geo.select(spec.entity, *spec.geo)
    return metrics.join(lookup, spec.entity, "left").select("dt_ref", *spec.geo, *rest)
