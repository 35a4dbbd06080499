"""Explicit schemas of the raw nested documents (never inferred).

Inference would read every file twice and turns the product-keyed cart map
into a struct with one field per product; these types fix both.
"""

from pyspark.sql import types as T

S, L, D, B, TS = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.TimestampType()


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


USERS = T.StructType([
    _f("user_id", S),
    _f("geo_data", T.StructType([_f("city", S), _f("state", S), _f("country", S)])),
    _f("registration_date", S),
    _f("last_active", S),
])

PRICE_POINT = T.StructType([_f("price", D), _f("date", S)])

PRODUCTS = T.StructType([
    _f("product_id", S), _f("name", S), _f("category_id", S), _f("subcategory_id", S),
    _f("base_price", D), _f("current_stock", L), _f("is_active", B),
    _f("price_history", T.ArrayType(PRICE_POINT)),
    _f("creation_date", S),
])

SUBCATEGORY = T.StructType([_f("subcategory_id", S), _f("name", S), _f("profit_margin", D)])

CATEGORIES = T.StructType([
    _f("category_id", S), _f("name", S), _f("subcategories", T.ArrayType(SUBCATEGORY)),
])

ITEM = T.StructType([_f("product_id", S), _f("quantity", L), _f("unit_price", D),
                     _f("subtotal", D)])

TRANSACTIONS = T.StructType([
    _f("transaction_id", S), _f("session_id", S), _f("user_id", S), _f("timestamp", S),
    _f("items", T.ArrayType(ITEM)),
    _f("subtotal", D), _f("discount", D), _f("total", D),
    _f("payment_method", S), _f("status", S),
])

PAGE_VIEW = T.StructType([_f("timestamp", S), _f("page_type", S), _f("product_id", S),
                          _f("category_id", S), _f("view_duration", L)])

SESSIONS = T.StructType([
    _f("session_id", S), _f("user_id", S), _f("start_time", S), _f("end_time", S),
    _f("duration_seconds", L),
    _f("geo_data", T.StructType([_f("city", S), _f("state", S), _f("country", S),
                                 _f("ip_address", S)])),
    _f("device_profile", T.StructType([_f("type", S), _f("os", S), _f("browser", S)])),
    _f("viewed_products", T.ArrayType(S)),
    _f("page_views", T.ArrayType(PAGE_VIEW)),
    _f("cart_contents", T.MapType(S, T.StructType([_f("quantity", L), _f("price", D)]))),
    _f("conversion_status", S),
    _f("referrer", S),
])

RAW = {"users": USERS, "products": PRODUCTS, "categories": CATEGORIES,
       "transactions": TRANSACTIONS, "sessions": SESSIONS}
