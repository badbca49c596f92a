"""Column types and keys of the nine base tables.

Fixed values: table names, column names and column types of the marketplace extract.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TEXT, _INT, _REAL, _TIME = T.StringType(), T.IntegerType(), T.DoubleType(), T.TimestampType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns.items()])


SCHEMAS: dict[str, T.StructType] = {
    "tb_orders": _struct(
        order_id=_TEXT,
        customer_id=_TEXT,
        order_status=_TEXT,
        order_purchase_timestamp=_TIME,
        order_approved_at=_TIME,
        order_delivered_carrier_date=_TIME,
        order_delivered_customer_date=_TIME,
        order_estimated_delivery_date=_TIME,
    ),
    "tb_items": _struct(
        order_id=_TEXT,
        order_item_id=_INT,
        product_id=_TEXT,
        seller_id=_TEXT,
        shipping_limit_date=_TIME,
        price=_REAL,
        freight_value=_REAL,
    ),
    "tb_customers": _struct(
        customer_id=_TEXT,
        customer_unique_id=_TEXT,
        customer_zip_code_prefix=_INT,
        customer_city=_TEXT,
        customer_state=_TEXT,
    ),
    "tb_sellers": _struct(
        seller_id=_TEXT,
        seller_zip_code_prefix=_INT,
        seller_city=_TEXT,
        seller_state=_TEXT,
    ),
    "tb_products": _struct(
        product_id=_TEXT,
        product_category_name=_TEXT,
        product_name_lenght=_REAL,
        product_description_lenght=_REAL,
        product_photos_qty=_REAL,
        product_weight_g=_REAL,
        product_length_cm=_REAL,
        product_height_cm=_REAL,
        product_width_cm=_REAL,
    ),
    "tb_reviews": _struct(
        review_id=_TEXT,
        order_id=_TEXT,
        review_score=_INT,
        review_comment_title=_TEXT,
        review_comment_message=_TEXT,
        review_creation_date=_TIME,
        review_answer_timestamp=_TIME,
    ),
    "tb_payments": _struct(
        order_id=_TEXT,
        payment_sequential=_INT,
        payment_type=_TEXT,
        payment_installments=_INT,
        payment_value=_REAL,
    ),
    "tb_geolocation": _struct(
        geolocation_zip_code_prefix=_INT,
        geolocation_lat=_REAL,
        geolocation_lng=_REAL,
        geolocation_city=_TEXT,
        geolocation_state=_TEXT,
    ),
    "tb_category": _struct(
        product_category_name=_TEXT,
        product_category_name_english=_TEXT,
    ),
}

# Tables with a declared key; loading keeps the first row of each key.
PRIMARY_KEYS: dict[str, str] = {
    "tb_orders": "order_id",
    "tb_sellers": "seller_id",
    "tb_products": "product_id",
    "tb_reviews": "review_id",
}
