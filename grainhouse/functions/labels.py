"""Fixed label tables of the semantic layer and the columns built from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from grainhouse.functions.scalar import as_col, bucket, bucket_rank

# Product category -> rollup group. Odd spellings are the keys
# found in the data.
CATEGORY_GROUPS: dict[str, list[str]] = {
    "Home & Furniture": [
        "bed_bath_table", "furniture_decor", "housewares", "office_furniture", "furniture_living_room",
        "home_confort", "home_comfort_2", "kitchen_dining_laundry_garden_furniture", "furniture_bedroom",
        "furniture_mattress_and_upholstery", "portateis_cozinha_e_preparadores_de_alimentos", "la_cuisine",
    ],
    "Electronics & Appliances": [
        "computers_accessories", "telephony", "computers", "small_appliances", "electronics", "consoles_games",
        "home_appliances_2", "home_appliances", "fixed_telephony", "air_conditioning", "audio",
        "small_appliances_home_oven_and_coffee", "tablets_printing_image", "cine_photo", "music", "dvds_blu_ray",
        "cds_dvds_musicals", "pc_gamer",
    ],
    "Fashion & Accessories": [
        "watches_gifts", "cool_stuff", "fashion_bags_accessories", "luggage_accessories", "fashion_shoes",
        "fashion_male_clothing", "fashion_underwear_beach", "fashio_female_clothing", "fashion_sport",
        "fashion_childrens_clothes",
    ],
    "Health, Beauty & Baby": ["health_beauty", "baby", "perfumery", "diapers_and_hygiene"],
    "Sports, Leisure & Pets": [
        "sports_leisure", "toys", "pet_shop", "musical_instruments", "christmas_supplies", "party_supplies", "flowers",
    ],
    "Home Improvement & Auto": [
        "auto", "garden_tools", "construction_tools_construction", "home_construction", "construction_tools_lights",
        "construction_tools_safety", "costruction_tools_garden", "costruction_tools_tools", "signaling_and_security",
    ],
    "Books, Stationery & Art": [
        "stationery", "books_general_interest", "books_technical", "books_imported", "art", "arts_and_craftmanship",
    ],
    "Food, Industry & Other": [
        "agro_industry_and_commerce", "industry_commerce_and_business", "market_place", "food", "food_drink", "drinks",
        "security_and_services",
    ],
    "Unclassified": ["Unknown"],
}
UNCLASSIFIED = "Unclassified"
CATEGORIES = [name for group, names in CATEGORY_GROUPS.items() if group != UNCLASSIFIED for name in names]

# Inclusive upper bounds and labels.
DELIVERY_STEPS, DELIVERY_REST = [(3, "0-3"), (7, "4-7"), (14, "8-14")], "15+"
BAND_STEPS = [(9, "5-9d"), (14, "10-14d"), (19, "15-19d"), (24, "20-24d"), (29, "25-29d")]
SEVERITY_STEPS = [(3, "1-3 delay days"), (7, "4-7 delay days"), (14, "8-14 delay days")]
SEVERITY_REST = "15+ delay days"
DISTANCE_STEPS, DISTANCE_REST = [(5, "0-5"), (15, "5-15"), (30, "15-30")], "30+"
WEIGHT_STEPS, WEIGHT_REST = [(500, "0-500g"), (2000, "500-2000g"), (5000, "2000-5000g")], "5000g+"
VALUE_STEPS, VALUE_REST = [(50, "0-50"), (150, "50-150"), (300, "150-300")], "300+"

# Statuses left out of net revenue.
NOT_NET = ("canceled", "unavailable")
DELIVERED = "delivered"


def category_group(category: Column | str) -> Column:
    """Rollup group of a category; text is compared without case.

    The table is a constant map inside the expression, so no join is planned.
    """
    pairs = [F.lit(text) for group, names in CATEGORY_GROUPS.items() for name in names for text in (name.lower(), group)]
    found = F.try_element_at(F.create_map(*pairs), F.lower(as_col(category)))
    return F.coalesce(found, F.lit(UNCLASSIFIED))


def delivery_bucket(actual_days: Column | str) -> Column:
    """Days from purchase to arrival; no arrival is ``N/A``; negative days fall in the first bucket."""
    return bucket(actual_days, DELIVERY_STEPS, DELIVERY_REST, missing="N/A")


def delivery_bucket_sort(actual_days: Column | str) -> Column:
    return bucket_rank(actual_days, DELIVERY_STEPS, missing=len(DELIVERY_STEPS) + 2)


def duration_band(actual_days: Column | str) -> Column:
    """Five-day bands from 5 to 29 days; outside of them NULL."""
    days = as_col(actual_days)
    return F.when((days > 4) & (days <= 29), bucket(days, BAND_STEPS, ""))


def duration_band_sort(actual_days: Column | str) -> Column:
    days = as_col(actual_days)
    return F.when((days > 4) & (days <= 29), bucket_rank(days, BAND_STEPS))


def promise_status(delay_days: Column | str) -> Column:
    """Broken when late. A missing delay counts as kept, as a blank is not above zero."""
    return F.when(as_col(delay_days) > 0, F.lit("Broken")).otherwise(F.lit("Kept"))


def delay_severity(delay_days: Column | str) -> Column:
    return bucket(delay_days, SEVERITY_STEPS, SEVERITY_REST)


def is_delivered(status: Column | str = "order_status") -> Column:
    return as_col(status) == DELIVERED


def is_net(status: Column | str = "order_status") -> Column:
    """True for orders counted in net revenue. A missing status does not count."""
    return ~as_col(status).isin(*NOT_NET)


def customer_label(customer_key: Column | str) -> Column:
    return F.concat(F.lit("Customer #"), as_col(customer_key).cast("string"))


def seller_label(city: Column | str, seller_key: Column | str) -> Column:
    """City and key of a seller; a missing city leaves the key alone."""
    return F.concat_ws(" ", as_col(city), as_col(seller_key).cast("string"))
