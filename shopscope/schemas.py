"""Declared schemas of the five entities, in their document layout.

Timestamps are ISO text in the documents and are parsed by the cleaning step.
``cart_contents`` is an object keyed by product id and has to be declared as a
map: inference would turn every product id into a struct field. Schemas are
DDL text, which readers take as it is.
"""

from __future__ import annotations

TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"

USERS = (
    "user_id string, name string, email string, age int, gender string, "
    "geo_data struct<city:string,state:string,country:string>, "
    "registration_date string, last_active string, preferred_payment string"
)

CATEGORIES = (
    "category_id string, name string, "
    "subcategories array<struct<subcategory_id:string,name:string,profit_margin:double>>"
)

PRODUCTS = (
    "product_id string, name string, category_id string, subcategory_id string, brand string, "
    "base_price double, current_price double, current_stock bigint, is_active boolean, "
    "price_history array<struct<price:double,date:string>>, "
    "creation_date string, rating double, review_count bigint"
)

SESSIONS = (
    "session_id string, user_id string, start_time string, end_time string, duration_seconds bigint, "
    "geo_data struct<city:string,state:string,country:string,ip_address:string>, "
    "device_profile struct<type:string,os:string,browser:string>, "
    "viewed_products array<string>, "
    "page_views array<struct<timestamp:string,page_type:string,product_id:string,"
    "category_id:string,view_duration:bigint>>, "
    "cart_contents map<string,struct<quantity:int,price:double>>, "
    "conversion_status string, referrer string"
)

TRANSACTIONS = (
    "transaction_id string, session_id string, user_id string, timestamp string, "
    "items array<struct<product_id:string,quantity:bigint,unit_price:double,subtotal:double>>, "
    "subtotal double, discount double, total double, payment_method string, status string"
)

ENTITIES = {
    "users": USERS,
    "categories": CATEGORIES,
    "products": PRODUCTS,
    "sessions": SESSIONS,
    "transactions": TRANSACTIONS,
}

# Keys that must be unique per entity; a sparse key ignores rows where it is null.
UNIQUE_KEYS = (
    ("categories", "category_id", False),
    ("users", "user_id", False),
    ("users", "email", True),
    ("products", "product_id", False),
    ("transactions", "transaction_id", False),
)
