"""Declared schemas of the three layers and their contracts.

Ids are text, money is ``decimal(10,2)``, timestamps carry no zone. Surrogate
keys are 64 bit so that dimensions may outgrow 2^31 rows.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "s": T.StringType(),
    "i": T.IntegerType(),
    "h": T.ShortType(),
    "l": T.LongType(),
    "b": T.BooleanType(),
    "d": T.DateType(),
    "t": T.TimestampNTZType(),
    "m": T.DecimalType(10, 2),
    "m20": T.DecimalType(20, 2),
    "m38": T.DecimalType(38, 2),
    "f": T.DoubleType(),
    "lat": T.DecimalType(10, 8),
    "lng": T.DecimalType(11, 8),
}


def _table(spec: str) -> tuple[T.StructType, dict[str, int]]:
    """Parse ``name:type`` items; ``name:s50`` also declares a maximum length."""
    fields, limits = [], {}
    for item in spec.split():
        name, code = item.split(":")
        if code[0] == "s" and code[1:]:
            limits[name] = int(code[1:])
            code = "s"
        fields.append(T.StructField(name, _TYPES[code]))
    return T.StructType(fields), limits


# Column names, types and text lengths of the raw, staging and
# warehouse tables. `product_name_lenght` is misspelt in the source data.
_SOURCE = {
    "customers": "customer_id:s50 customer_unique_id:s50 customer_zip_code_prefix:i customer_city:s100 customer_state:s2",
    "geolocation": "geolocation_zip_code_prefix:i geolocation_lat:lat geolocation_lng:lng geolocation_city:s100 geolocation_state:s2",
    "orders": "order_id:s50 customer_id:s50 order_status:s20 order_purchase_timestamp:t order_approved_at:t "
    "order_delivered_carrier_date:t order_delivered_customer_date:t order_estimated_delivery_date:t",
    "order_items": "order_id:s50 order_item_id:i product_id:s50 seller_id:s50 shipping_limit_date:t price:m freight_value:m",
    "order_payments": "order_id:s50 payment_sequential:i payment_type:s20 payment_installments:i payment_value:m",
    "order_reviews": "review_id:s50 order_id:s50 review_score:h review_comment_title:s200 review_comment_message:s4000 "
    "review_creation_date:t review_answer_timestamp:t",
    "products": "product_id:s50 product_category_name:s100 product_name_lenght:i product_description_lenght:i "
    "product_photos_qty:i product_weight_g:i product_length_cm:i product_height_cm:i product_width_cm:i",
    "sellers": "seller_id:s50 seller_zip_code_prefix:i seller_city:s100 seller_state:s2",
    "category_translation": "product_category_name:s100 product_category_name_english:s100",
}

_STAGING = {
    "stg_customers": "customer_id:s50 customer_unique_id:s50 customer_city:s100 customer_state:s10 customer_zip_code_prefix:s10",
    "stg_geolocation": "zip_code_prefix:s10 latitude:lat longitude:lng",
    "stg_order_items": "order_id:s50 order_item_id:i product_id:s50 seller_id:s50 price:m freight_value:m",
    "stg_orders": "order_id:s50 customer_id:s50 order_status:s30 order_purchase_timestamp:t order_approved_at:t "
    "order_delivered_carrier_date:t order_delivered_customer_date:t order_estimated_delivery_date:t",
    "stg_payments": "order_id:s50 payment_sequential:i payment_type:s30 payment_installments:i payment_value:m",
    "stg_products": "product_id:s50 product_category_name:s100 product_category_name_eng:s100 product_weight_g:i "
    "product_length_cm:i product_height_cm:i product_width_cm:i",
    "stg_reviews": "review_id:s50 order_id:s50 review_score:i",
    "stg_sellers": "seller_id:s50 seller_city:s100 seller_state:s10 seller_zip_code_prefix:s10",
}

_ADDRESS = "city:s100 state:s10 zip_code:s10 country:s30 latitude:lat longitude:lng"

_WAREHOUSE = {
    "dim_customer": "customer_key:l customer_unique_id:s50",
    "dim_date": "date_key:i full_date:d year:i quarter:i month:i month_name:s20 day_of_week:i day_name:s20 is_weekend:b",
    "dim_order": "order_key:l order_id:s50 order_status:s20 " + _ADDRESS,
    "dim_product": "product_key:l product_id:s50 category_name_english:s100 product_weight_g:i product_length_cm:i "
    "product_height_cm:i product_width_cm:i",
    "dim_seller": "seller_key:l seller_id:s50 " + _ADDRESS,
    "fact_order_items": "fact_key:l order_id:s50 order_item_id:i order_key:l customer_key:l seller_key:l product_key:l "
    "purchase_date_key:i delivered_date_key:i purchase_timestamp:t delivered_carrier_date:t delivered_customer_date:t "
    "estimated_delivery_date:t price:m freight_value:m delivery_delay_days:i actual_delivery_days:i",
    "fact_payments": "fact_key:l order_id:s50 payment_sequential:i order_key:l customer_key:l purchase_date_key:i "
    "payment_type:s30 payment_installments:i payment_value:m",
    "fact_reviews": "fact_key:l review_id:s50 order_id:s50 order_key:l customer_key:l purchase_date_key:i review_score:i",
}

# tables beside the warehouse that reports read
_MIRROR = {
    "order_totals": "order_key:l order_id:s customer_key:l order_status:s customer_city:s customer_state:s purchase_timestamp:t "
    "purchase_date_key:i items:l items_revenue:m20 freight:m20 delay_days:i actual_days:i delivered_date_key:i payments:l paid:m20 "
    "reviews:l review_total:l handling_minutes:l transit_minutes:l",
    "order_spine": "order_id:s customer_id:s order_status:s order_purchase_timestamp:t order_approved_at:t "
    "order_delivered_carrier_date:t order_delivered_customer_date:t order_estimated_delivery_date:t order_key:l customer_key:l "
    "city:s state:s zip_code:s latitude:lat longitude:lng country:s purchase_date_key:i",
    "order_sellers": "order_key:l seller_key:l purchase_date_key:i item_rows:l dated_rows:l price:m20 freight_value:m20 actual_days:i "
    "order_status:s customer_city:s customer_state:s seller_id:s seller_city:s seller_state:s distance:f route_type:s handling_minutes:l "
    "transit_minutes:l first_of_state:b first_of_distance:b first_of_route:b",
    "zip_centres": "zip_code_prefix:s latitude:lat longitude:lng",
    "seller_revenue_ranks": "revenue:m38 n:l pct_rank:f",
}

_PARSED = {name: _table(spec) for layer in (_SOURCE, _STAGING, _WAREHOUSE, _MIRROR) for name, spec in layer.items()}

SCHEMAS: dict[str, T.StructType] = {name: parsed[0] for name, parsed in _PARSED.items()}
LENGTHS: dict[str, dict[str, int]] = {name: parsed[1] for name, parsed in _PARSED.items()}

SRC_SCHEMAS = {name: SCHEMAS[name] for name in _SOURCE}
STG_SCHEMAS = {name: SCHEMAS[name] for name in _STAGING}
DWH_SCHEMAS = {name: SCHEMAS[name] for name in _WAREHOUSE}
MIRROR_SCHEMAS = {name: SCHEMAS[name] for name in _MIRROR}

# Natural key of every table that has one (geolocation deliberately has none).
GRAINS = {
    "customers": ["customer_id"],
    "orders": ["order_id"],
    "order_items": ["order_id", "order_item_id"],
    "order_payments": ["order_id", "payment_sequential"],
    "order_reviews": ["review_id", "order_id"],
    "products": ["product_id"],
    "sellers": ["seller_id"],
    "category_translation": ["product_category_name"],
    "dim_customer": ["customer_unique_id"],
    "dim_date": ["date_key"],
    "dim_order": ["order_id"],
    "dim_product": ["product_id"],
    "dim_seller": ["seller_id"],
    "fact_order_items": ["order_id", "order_item_id"],
    "fact_payments": ["order_id", "payment_sequential"],
    "fact_reviews": ["review_id", "order_id"],
}

# child table, child column, parent table, parent column
FOREIGN_KEYS = [
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("order_items", "seller_id", "sellers", "seller_id"),
    ("order_payments", "order_id", "orders", "order_id"),
    ("order_reviews", "order_id", "orders", "order_id"),
]
