import datetime as dt

from pyspark.sql import types as T

from mercato.operators import clean
from mercato.sources.schemas import PRODUCTS, SESSIONS, TRANSACTIONS, USERS
from tests.conftest import rows


def geo(country="US"):
    return ("Springfield", "IL", country)


def test_clean_users_parses_dedupes_and_drops_null_ids(spark):
    df = spark.createDataFrame([
        ("u1", geo(), "2024-01-05T10:00:00", "2024-02-01T00:00:00"),
        ("u1", geo(), "2024-01-05T10:00:00", "2024-02-01T00:00:00"),
        ("u2", geo("FR"), "not a date", None),
        (None, geo(), "2024-01-01T00:00:00", None),
    ], USERS)
    out = clean.clean_users(df).orderBy("user_id")
    got = rows(out, "user_id", "registration_date", "last_active")
    assert got == [("u1", dt.datetime(2024, 1, 5, 10), dt.datetime(2024, 2, 1)),
                   ("u2", None, None)]
    assert isinstance(out.schema["registration_date"].dataType, T.TimestampType)


def test_dedupe_keeps_a_fixed_survivor(spark):
    df = spark.createDataFrame([
        ("u1", geo("ZZ"), "2024-01-05T10:00:00", None),
        ("u1", geo("AA"), "2024-01-05T10:00:00", None),
    ], USERS)
    assert rows(clean.clean_users(df), "geo_data.country") == [("AA",)]


def test_clean_products_defaults(spark):
    df = spark.createDataFrame([
        ("p1", "A", "c1", "s1", 10.0, None, None, [], "2024-01-01T00:00:00"),
        ("p2", "B", "c1", "s1", 12.0, 5, True, None, "bad"),
        (None, "C", "c1", "s1", 1.0, 1, True, None, None),
    ], PRODUCTS)
    got = rows(clean.clean_products(df).orderBy("product_id"),
               "product_id", "current_stock", "is_active", "creation_date")
    assert got == [("p1", 0, False, dt.datetime(2024, 1, 1)), ("p2", 5, True, None)]


def test_clean_transactions_filters_totals_and_keeps_one_null_id(spark):
    item = [("p1", 1, 5.0, 5.0)]
    df = spark.createDataFrame([
        ("t1", None, "u1", "2024-01-01T00:00:00", item, 5.0, None, 5.0, "paypal", "completed"),
        ("t1", None, "u1", "2024-01-01T00:00:00", item, 5.0, None, 5.0, "paypal", "completed"),
        ("t2", None, "u1", "2024-01-01T00:00:00", item, 5.0, 0.0, -1.0, "paypal", "completed"),
        ("t3", None, "u1", "2024-01-01T00:00:00", item, 5.0, 0.0, None, "paypal", "completed"),
        (None, None, "u1", "2024-01-01T00:00:00", [], 0.0, 0.0, 0.0, "paypal", "completed"),
        (None, None, "u2", "2024-01-02T00:00:00", [], 0.0, 0.0, 0.0, "paypal", "completed"),
    ], TRANSACTIONS)
    got = rows(clean.clean_transactions(df).orderBy("transaction_id"),
               "transaction_id", "discount", "user_id")
    assert got == [(None, 0.0, "u1"), ("t1", 0.0, "u1")]


def _session(sid, dur):
    return (sid, "u1", "2024-01-01T00:00:00", "2024-01-01T00:10:00", dur,
            ("c", "s", "US", "1.2.3.4"), ("mobile", "iOS", "Safari"), [], [],
            {"p1": (0, 1.0)}, "browsed", "direct")


def test_clean_sessions_drops_non_positive_durations(spark):
    df = spark.createDataFrame([_session("s1", 600), _session("s1", 600), _session("s2", 0),
                                _session("s3", -5), _session("s4", None)], SESSIONS)
    out = clean.clean_sessions(df)
    assert rows(out, "session_id") == [("s1",)]
    assert rows(out, "cart_contents")[0][0] == {"p1": T.Row(quantity=0, price=1.0)}


def test_table_counts(spark):
    a = spark.range(3)
    b = spark.range(0)
    got = sorted(rows(clean.table_counts({"a": a, "b": b})))
    assert got == [("a", 3), ("b", 0)]


def test_clean_transaction_ids_equal_clean_transactions(spark):
    from tests import fixtures as fx
    tx = fx.transactions(spark).union(fx.transactions(spark))
    a = sorted(rows(clean.clean_transactions(tx), "transaction_id"))
    b = sorted(rows(clean.clean_transaction_ids(tx)))
    assert a == b
