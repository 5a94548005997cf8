"""Declared shape of the raw layer: column types and the source tables' constraints.

Spark tables do not enforce constraints; ``cartlake.operators.quality`` turns
these declarations into checks (``check_raw_layer``).
"""

from __future__ import annotations

# Declared raw-table schemas (name, type).
RAW_COLUMNS = {
    "departments": [("department_id", "int"), ("department", "string")],
    "aisles": [("aisle_id", "int"), ("aisle", "string")],
    "products": [("product_id", "int"), ("product_name", "string"), ("aisle_id", "int"),
                 ("department_id", "int")],
    "orders": [("order_id", "int"), ("user_id", "int"), ("eval_set", "string"), ("order_number", "int"),
               ("order_dow", "int"), ("order_hour_of_day", "int"), ("days_since_prior", "int")],
    "order_products__prior": [("order_id", "int"), ("product_id", "int"), ("add_to_cart_order", "int"),
                              ("reordered", "string")],
    "order_products__train": [("order_id", "int"), ("product_id", "int"), ("add_to_cart_order", "int"),
                              ("reordered", "string")],
}

# Constraints declared on the source tables.
PRIMARY_KEYS = {"orders": "order_id", "aisles": "aisle_id", "departments": "department_id",
                "products": "product_id"}
NOT_NULL = {
    "orders": ["user_id", "eval_set", "order_number", "order_dow", "order_hour_of_day"],
    "aisles": ["aisle"],
    "departments": ["department"],
    "products": ["product_name", "aisle_id", "department_id"],
    "order_products__prior": ["order_id", "product_id", "add_to_cart_order", "reordered"],
    "order_products__train": ["order_id", "product_id", "add_to_cart_order", "reordered"],
}
MAX_LENGTH = {"orders": {"eval_set": 20}, "aisles": {"aisle": 255}, "departments": {"department": 255},
              "products": {"product_name": 255}}
# Declared but disabled at the source (commented out there): checked on request.
COMPOSITE_KEYS = {"order_products__prior": ["order_id", "product_id"],
                  "order_products__train": ["order_id", "product_id"]}
FOREIGN_KEYS = [  # (child, column, parent, parent column)
    ("products", "aisle_id", "aisles", "aisle_id"),
    ("products", "department_id", "departments", "department_id"),
    ("order_products__prior", "order_id", "orders", "order_id"),
    ("order_products__prior", "product_id", "products", "product_id"),
    ("order_products__train", "order_id", "orders", "order_id"),
    ("order_products__train", "product_id", "products", "product_id"),
]
