"""A small hand-made shop. Every row is there for a rule of the analytics."""

from __future__ import annotations

import json
import pathlib


def user(user_id, age, registered, email, **more):
    return {"user_id": user_id, "age": age, "registration_date": registered, "email": email,
            "geo_data": {"city": "C", "state": "S", "country": "US"}, "last_active": "2025-03-01T00:00:00", **more}


USERS = [
    user("u1", 24, "2024-12-30T10:00:00", " A@X.COM ", gender="F", preferred_payment="paypal"),
    user("u2", None, "2025-01-15T00:00:00", "", gender="M", preferred_payment="credit_card"),
    user("u3", 55, "2025-02-01T00:00:00", None, gender="M"),
    user("u4", 30, "2025-02-02T00:00:00", "u4@x.com", gender="Other", preferred_payment="paypal"),
    user(None, 40, "2025-02-03T00:00:00", "nobody@x.com"),
]


def product(product_id, category, base, current, stock, **more):
    return {"product_id": product_id, "name": f"Product {product_id}", "category_id": category, "base_price": base,
            "current_price": current, "current_stock": stock, "creation_date": "2024-07-01T00:00:00", **more}


PRODUCTS = [
    product("p1", "cat_a", 25.0, 19.99, 5),
    product("p2", "cat_a", 50.0, None, -3),
    product("p3", "cat_b", 310.0, 300.0, None),
    product("p4", "cat_b", 20.0, 20.0, 1),
]


def transaction(transaction_id, user_id, session_id, at, status, total, *items):
    return {
        "transaction_id": transaction_id, "user_id": user_id, "session_id": session_id, "timestamp": at,
        "status": status, "total": total, "payment_method": " PayPal ",
        "items": [{"product_id": p, "quantity": q, "unit_price": round(s / q, 2), "subtotal": s} for p, q, s in items],
    }


TRANSACTIONS = [
    transaction("t1", "u1", "s1", "2025-01-04T23:59:59", "completed", 139.98, ("p1", 2, 39.98), ("p2", 2, 100.0)),
    transaction("t2", "u1", "s2", "2025-01-05T00:00:00", "refunded", 300.0, ("p3", 1, 300.0)),
    transaction("t3", "u2", "s3", "2025-02-10T00:00:00", "shipped", 370.0,
                ("p1", 1, 20.0), ("p2", 1, 50.0), ("p3", 1, 300.0)),
    transaction("t4", "u9", "s9", "2025-02-10T12:00:00", None, 20.0, ("p4", 1, 20.0)),
    transaction("t5", "u2", None, "2025-02-11T00:00:00", "completed", 0.0),
    transaction("t6", "u3", "s7", "2025-02-20T00:00:00", "completed", 1001.0, ("p9", 1, 1001.0)),
]


def session(session_id, user_id, start, seconds, device, referrer, viewed, cart, conversion):
    return {
        "session_id": session_id, "user_id": user_id, "start_time": start, "end_time": start,
        "duration_seconds": seconds, "device_profile": {"type": device, "os": "iOS", "browser": "Safari"},
        "referrer": referrer, "viewed_products": viewed, "conversion_status": conversion,
        "cart_contents": {p: {"quantity": 1, "price": 1.5} for p in cart},
        "page_views": [{"product_id": p, "page_type": "product_detail"} for p in viewed or []],
        "geo_data": {"city": "C", "state": "S", "country": "US", "ip_address": "10.0.0.1"},
    }


SESSIONS = [
    [
        session("s1", "u1", "2025-01-04T23:40:00", 1199, "mobile", None, ["p1", "p2"], ["p1", "p2"], "converted"),
        session("s2", "u1", "2025-01-04T23:50:00", 600, "desktop", "email", ["p3"], ["p3"], "converted"),
        session("s3", "u2", "2025-02-10T00:00:00", 900, "mobile", "email", ["p1", "p2", "p3"], ["p1", "p2", "p3"],
                "converted"),
        session("s4", "u2", "2025-02-11T00:00:00", 300, "mobile", "direct", [], [], "abandoned"),
    ],
    [
        session("s5", "u1", "2025-02-11T00:00:00", 0, "mobile", "direct", ["p1"], [], "abandoned"),
        session("s6", "u9", "2025-02-11T00:00:00", 60, "tablet", "direct", None, [], None),
        session("s7", "u3", "2025-02-20T00:00:00", 120, "desktop", "email", ["p1"], [], "abandoned"),
    ],
]

CATEGORIES = [
    {"category_id": "cat_a", "name": "A", "subcategories": [{"subcategory_id": "x", "name": "X", "profit_margin": 0.2}]}
]


def write_documents(folder: pathlib.Path) -> None:
    """The shop as document files: JSON arrays, sessions in several files."""
    files = {"users": USERS, "products": PRODUCTS, "transactions": TRANSACTIONS, "categories": CATEGORIES}
    files |= {f"sessions_{n}": part for n, part in enumerate(SESSIONS)}
    for name, rows in files.items():
        (folder / f"{name}.json").write_text(json.dumps(rows, indent=2))
