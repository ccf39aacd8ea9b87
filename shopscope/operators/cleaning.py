"""Cleaning of the raw entities, one function per entity.

``strict=True`` drops rows without their required keys and normalises every
column; ``strict=False`` is the lenient variant of the integrated analytics,
which keeps such rows and leaves secondary columns as they came. Columns a
source lacks come in as typed nulls, so any subset of the documents can be
cleaned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, MapType, StringType

from ..functions import bands, calendar
from ..schemas import TIMESTAMP_FORMAT

OPTIONAL_USER_COLUMNS = {
    "name": "string",
    "email": "string",
    "age": "int",
    "gender": "string",
    "preferred_payment": "string",
}


def add_missing(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add the named columns that ``df`` lacks, as nulls of the given type."""
    return df.withColumns(
        {c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns}
    )


def required(df: DataFrame, *names: str) -> DataFrame:
    """Drop rows where one of the columns is null (or not a number). Plain
    comparisons, which a Parquet scan can use, unlike ``dropna``."""
    for c in names:
        df = df.filter(F.col(c).isNotNull())
        if isinstance(df.schema[c].dataType, (DoubleType, FloatType)):
            df = df.filter(~F.isnan(c))
    return df


def parse_timestamp(df: DataFrame, *names: str) -> DataFrame:
    """Parse ISO text columns; text that is no timestamp becomes null. Columns
    already typed as timestamps pass through."""
    return df.withColumns({
        c: F.try_to_timestamp(c, F.lit(TIMESTAMP_FORMAT))
        for c in names
        if c in df.columns and isinstance(df.schema[c].dataType, StringType)
    })


def flatten(df: DataFrame, struct: str, fields: dict[str, str]) -> DataFrame:
    """Lift ``fields`` (new column -> struct field) out of a struct column and
    drop the struct. A frame without the struct keeps the columns it has."""
    if struct not in df.columns:
        return add_missing(df, dict.fromkeys(fields, "string"))
    present = set(df.schema[struct].dataType.fieldNames())
    lifted = {
        new: F.col(f"{struct}.{old}") if old in present else F.lit(None).cast("string")
        for new, old in fields.items()
    }
    return df.withColumns(lifted).drop(struct)


def default_email(email: Column, user_id: Column, blank_as_null: bool = False, trim: bool = False) -> Column:
    """Lower-cased email with a placeholder for a missing one.

    The document load also treats an empty address as missing and trims;
    the analytics do neither.
    """
    if blank_as_null:
        email = F.nullif(email, F.lit(""))
    placeholder = F.concat(user_id.cast("string"), F.lit("@placeholder.local"))
    out = F.coalesce(email, placeholder)
    return F.lower(F.trim(out) if trim else out)


def clean_users(users: DataFrame, strict: bool = True) -> DataFrame:
    if strict:
        users = required(users, "user_id", "registration_date")
    users = add_missing(users, OPTIONAL_USER_COLUMNS)
    geo = {"city": "city", "state": "state"} | ({"country": "country"} if strict else {})
    users = flatten(users, "geo_data", geo)
    users = parse_timestamp(users, "registration_date", *(["last_active"] if strict else []))
    return users.withColumns({
        "email": default_email(F.col("email"), F.col("user_id")),
        "age_group": bands.age_band(F.col("age")),
        "reg_month": calendar.month_label("registration_date"),
    })


def load_users(users: DataFrame) -> DataFrame:
    """Document-load form: emails made unique and tidy, ages banded with a
    missing age in the youngest band."""
    users = add_missing(users, OPTIONAL_USER_COLUMNS)
    return users.withColumns({
        "email": default_email(F.col("email"), F.col("user_id"), blank_as_null=True, trim=True),
        "age_group": bands.age_band(F.col("age"), null_label=bands.AGE_BANDS[0][1]),
    })


def clean_products(products: DataFrame, strict: bool = True) -> DataFrame:
    if strict:
        products = required(products, "product_id", "category_id", "base_price")
    price = F.coalesce("current_price", "base_price")
    products = products.withColumns({"current_price": price, "price_tier": bands.price_tier(price)})
    if strict:
        products = products.withColumn("current_stock", F.greatest(F.col("current_stock"), F.lit(0)))
        products = parse_timestamp(products, "creation_date")
    return products


def clean_transactions(transactions: DataFrame, strict: bool = True) -> DataFrame:
    if strict:
        transactions = required(transactions, "transaction_id", "user_id", "timestamp", "total")
        transactions = transactions.withColumn("payment_method", F.lower(F.trim("payment_method")))
    transactions = parse_timestamp(transactions, "timestamp").filter(F.col("total") > 0)
    return transactions.withColumns({
        "txn_date": F.to_date("timestamp"),
        "txn_month": calendar.month_label("timestamp"),
        "txn_week": calendar.us_week("timestamp"),
    })


def clean_sessions(sessions: DataFrame, strict: bool = True, nested: bool | None = None) -> DataFrame:
    """``nested`` keeps the nested columns, which the lenient variant drops by itself."""
    if strict:
        sessions = required(sessions, "session_id", "user_id", "start_time")
    device = {"device_type": "type", "device_os": "os"} | ({"device_browser": "browser"} if strict else {})
    sessions = flatten(sessions, "device_profile", device)
    sessions = parse_timestamp(sessions, "start_time", *(["end_time"] if strict else []))
    sessions = add_sizes(sessions.filter(F.col("duration_seconds") > 0))
    keep = strict if nested is None else nested
    return sessions if keep else sessions.drop("cart_contents", "page_views")


def add_sizes(sessions: DataFrame) -> DataFrame:
    """Element counts of the nested session columns, zero where they are null.

    The analytics read these counts rather than the collections, so a source
    that can count without building the collections need not build them.
    """
    nested = {"viewed_count": "viewed_products", "cart_count": "cart_contents", "page_count": "page_views"}
    return sessions.withColumns({
        count: F.coalesce(F.size(source), F.lit(0)).cast("bigint")
        for count, source in nested.items()
        if count not in sessions.columns
        and source in sessions.columns
        and isinstance(sessions.schema[source].dataType, (ArrayType, MapType))
    })


def coerce_numeric(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Read text columns as numbers of the given types; text that is no number
    becomes null. Columns that are numbers already stay as they are."""
    return df.withColumns({
        c: F.col(c).try_cast(t) for c, t in types.items() if isinstance(df.schema[c].dataType, StringType)
    })
