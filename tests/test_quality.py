import datetime as dt

from mercato.operators import enrich, quality
from mercato.sources.schemas import TRANSACTIONS
from tests import fixtures as fx
from tests.conftest import rows


def test_invoice_check_flags_each_rule(spark):
    tx = spark.createDataFrame([
        ("ok", None, "u1", "2024-01-01T00:00:00", [("p1", 3, 3.33, 9.99)], 9.99, 1.0, 8.99, "paypal", "completed"),
        ("line", None, "u1", "2024-01-01T00:00:00", [("p1", 2, 5.0, 11.0)], 11.0, 0.0, 11.0, "paypal", "completed"),
        ("sub", None, "u1", "2024-01-01T00:00:00", [("p1", 1, 5.0, 5.0)], 6.0, 0.0, 6.0, "paypal", "completed"),
        ("tot", None, "u1", "2024-01-01T00:00:00", [("p1", 1, 5.0, 5.0)], 5.0, 0.5, 4.0, "paypal", "completed"),
        ("empty", None, "u1", "2024-01-01T00:00:00", [], 0.0, 0.0, 0.0, "paypal", "completed"),
    ], TRANSACTIONS)
    out = quality.invoice_check(tx, enrich.flatten_items(tx)).orderBy("transaction_id")
    got = rows(out, "transaction_id", "bad_items", "subtotal_ok", "total_ok")
    assert got == [("line", 1, True, True), ("sub", 0, False, True), ("tot", 0, True, False)]


def test_stock_ledger(spark):
    tx, pr = fx.transactions(spark), fx.products(spark)
    got = rows(quality.stock_ledger(pr, enrich.flatten_items(tx)).orderBy("product_id"))
    assert got == [("p1", 5, 3, 8), ("p2", None, 4, None), ("p3", 1, 1, 2), ("p4", 100, 0, 100)]


def test_key_and_domain_check(spark):
    tx, pr, us, se = fx.transactions(spark), fx.products(spark), fx.users(spark), fx.sessions(spark)
    got = sorted(rows(quality.key_and_domain_check(tx, enrich.flatten_items(tx), us, pr, se)))
    assert got == [("bad_payment_method", "cash", 1), ("bad_referrer", "fax", 1),
                   ("bad_status", "lost", 1), ("orphan_product", "p9", 1)]


def test_rows_without_a_place_on_a_time_line_are_counted(spark):
    tx, pr, us, se = fx.transactions(spark), fx.products(spark), fx.users(spark), fx.sessions(spark)
    ev = spark.createDataFrame([(1, None), (None, None), (None, 5), (1, 5)], "user_id long, ts long")
    pts = spark.createDataFrame([("p1", None), ("p1", 1)], "product_id string, date long")
    got = sorted(rows(quality.key_and_domain_check(tx, enrich.flatten_items(tx), us, pr, se, ev, pts)))
    assert [r for r in got if r[0].startswith("unplaced")] == [
        ("unplaced_event", "ts", 2), ("unplaced_event", "user_id", 2), ("unplaced_price", "date", 1)]


def test_orphan_sessions(spark):
    tx, pr, us = fx.transactions(spark), fx.products(spark), fx.users(spark)
    gone = fx.sessions(spark).where("session_id <> 's3'")
    got = rows(quality.key_and_domain_check(tx, enrich.flatten_items(tx), us, pr, gone))
    assert ("orphan_session", "s3", 1) in got


def test_price_changes_and_check(spark):
    pr = fx.products(spark)
    pts = quality.price_points_from_products(pr).selectExpr(
        "product_id", "to_timestamp(date) AS date", "price")
    got = rows(quality.price_changes(pts).orderBy("product_id", "date"))
    assert got == [("p1", dt.datetime(2024, 1, 1), 9.0, None, None),
                   ("p1", dt.datetime(2024, 2, 1), 10.0, 9.0, 11.11),
                   ("p2", dt.datetime(2024, 1, 3), 20.0, None, None),
                   ("p3", dt.datetime(2024, 1, 2), 30.0, None, None),
                   ("p3", dt.datetime(2024, 1, 9), 33.0, 30.0, 10.0),
                   ("p3", dt.datetime(2024, 1, 20), 31.0, 33.0, -6.06)]
    chk = rows(quality.price_check(pr.selectExpr("product_id", "base_price",
                                                 "to_timestamp(creation_date) AS creation_date"), pts)
               .orderBy("product_id"), "product_id", "price_matches", "date_matches")
    assert chk == [("p1", True, True), ("p2", True, True), ("p3", False, True), ("p4", None, None)]
