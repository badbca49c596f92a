"""What a feature book is built from."""

from __future__ import annotations

import calendar
from dataclasses import dataclass, field
from datetime import date

# Product categories counted one by one in the book.
NAMED_CATEGORIES = (
    "cama_mesa_banho",
    "beleza_saude",
    "esporte_lazer",
    "moveis_decoracao",
    "informatica_acessorios",
    "utilidades_domesticas",
    "relogios_presentes",
    "telefonia",
    "ferramentas_jardim",
    "automotivo",
    "brinquedos",
    "cool_stuff",
    "perfumaria",
    "bebes",
    "eletronicos",
    "papelaria",
    "fashion_bolsas_e_acessorios",
    "pet_shop",
    "moveis_escritorio",
)


@dataclass(frozen=True)
class BookSpec:
    """Column names and constants of a book.

    ``entity_on`` tells which table carries the entity key: the items (sellers) or the orders
    (customers).  Money is summed in whole units of ``10**-money_scale``, so that sums do not depend on
    the order of rows; digits below a millionth are dropped by default.  Orders, products and reviews
    must be unique on their keys; the loader sees to it.
    """

    entity: str = "seller_id"
    entity_on: str = "items"
    order_id: str = "order_id"
    status: str = "order_status"
    status_value: str = "delivered"
    approved: str = "order_approved_at"
    purchased: str = "order_purchase_timestamp"
    delivered: str = "order_delivered_customer_date"
    estimated: str = "order_estimated_delivery_date"
    product: str = "product_id"
    price: str = "price"
    freight: str = "freight_value"
    category: str = "product_category_name"
    review_id: str = "review_id"
    review_score: str = "review_score"
    geo: tuple[str, ...] = ("seller_city", "seller_state")
    categories: tuple[str, ...] = NAMED_CATEGORIES
    category_columns: dict[str, str] = field(default_factory=dict)
    window_months: int = 6
    money_scale: int = 6

    def category_column(self, category: str) -> str:
        return self.category_columns.get(category, f"qtd_{category}")


def shift_months(day: date, months: int) -> date:
    """Calendar month arithmetic that clamps to the last day of the month."""
    index = day.year * 12 + day.month - 1 + months
    year, month = divmod(index, 12)
    last = calendar.monthrange(year, month + 1)[1]
    return date(year, month + 1, min(day.day, last))


def month_starts(first: date, last: date) -> list[date]:
    """Every month start from ``first`` to ``last``."""
    out, day = [], first.replace(day=1)
    while day <= last:
        if day >= first:
            out.append(day)
        day = shift_months(day, 1)
    return out
