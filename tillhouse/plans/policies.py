"""Default policies for the six retail tables; every job takes others as arguments."""

# The table names, column contracts, types, null policies, keys, rules and enums of the retail data.

TABLES = ["events", "order_items", "orders", "products", "reviews", "users"]

COLUMNS = {
    "events": ["event_id", "user_id", "product_id", "event_type", "event_timestamp"],
    "order_items": ["order_item_id", "order_id", "product_id", "user_id", "quantity", "item_price", "item_total"],
    "orders": ["order_id", "user_id", "order_date", "order_status", "total_amount"],
    "products": ["product_id", "product_name", "category", "brand", "price", "rating"],
    "reviews": ["review_id", "order_id", "product_id", "user_id", "rating", "review_text", "review_date"],
    "users": ["user_id", "name", "email", "gender", "city", "signup_date"],
}

CASTS = {
    "events": {"event_timestamp": "timestamp"},
    "order_items": {"quantity": "int", "item_price": "double", "item_total": "double"},
    "orders": {"order_date": "timestamp", "total_amount": "double"},
    "products": {"price": "double", "rating": "double"},
    "reviews": {"rating": "int", "review_date": "timestamp"},
    "users": {"signup_date": "date"},
}

NULL_POLICIES = {
    "events": {
        "event_id": "drop",
        "user_id": "drop",
        "product_id": "drop",
        "event_type": "drop",
        "event_timestamp": "drop",
    },
    "order_items": {
        "order_item_id": "drop",
        "order_id": "drop",
        "product_id": "drop",
        "user_id": "drop",
        "quantity": "drop",
        "item_price": "drop",
        "item_total": "drop",
    },
    "orders": {
        "order_id": "drop",
        "user_id": "flagging",
        "order_date": "flagging",
        "order_status": "fill_unknown",
        "total_amount": "flagging",
    },
    "products": {
        "product_id": "drop",
        "product_name": "fill_unknown",
        "category": "fill_unknown",
        "brand": "fill_empty",
        "price": "flagging",
        "rating": "flagging",
    },
    "reviews": {
        "review_id": "drop",
        "order_id": "drop",
        "product_id": "drop",
        "user_id": "drop",
        "rating": "drop",
        "review_text": "fill_empty",
    },
    "users": {
        "user_id": "drop",
        "name": "fill_empty",
        "email": "fill_unknown",
        "gender": "fill_unknown",
        "city": "fill_empty",
    },
}

KEYS = {
    "events": ["event_id"],
    "order_items": ["order_item_id"],
    "orders": ["order_id"],
    "products": ["product_id"],
    "reviews": ["review_id"],
    "users": ["user_id"],
}

RULES = {
    "events": {
        "user_id": "df_users",
        "product_id": "df_products",
        "event_type": "in_enum",
        "event_timestamp": "is_past",
    },
    "order_items": {
        "order_id": "df_orders",
        "product_id": "df_products",
        "user_id": "df_users",
        "quantity": "is_positive",
        "item_price": "is_positive",
        "item_total": "is_positive",
    },
    "orders": {
        "user_id": "df_users",
        "order_date": "is_past",
        "order_status": "in_enum",
        "total_amount": "is_positive",
    },
    "products": {"category": "in_enum", "price": "is_positive", "rating": "is_positive"},
    "reviews": {
        "order_id": "df_orders",
        "product_id": "df_products",
        "user_id": "df_users",
        "rating": "is_positive",
        "review_date": "is_past",
    },
    "users": {"gender": "in_enum", "signup_date": "is_past"},
}

ENUMS = {
    "event_type": ["wishlist", "purchase", "view", "cart"],
    "order_status": ["completed", "shipped", "cancelled", "returned", "processing"],
    "category": [
        "home & kitchen",
        "sports",
        "pet supplies",
        "groceries",
        "electronics",
        "clothing",
        "automotive",
        "books",
        "beauty",
        "toys",
    ],
    "gender": ["female", "other", "male"],
}


def typed_columns(table: str) -> list[tuple[str, str]]:
    """The ``(column, type)`` pairs a cleaned table must have: contract columns, strings unless cast."""
    return [(column, CASTS[table].get(column, "string")) for column in COLUMNS[table]]


CLEAN_SCHEMA = {
    table: [pair for pair in typed_columns(table) if (table, pair[0]) != ("users", "email")] for table in TABLES
}
