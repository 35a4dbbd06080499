import datetime as dt

from mercato.operators import enrich
from tests import fixtures as fx
from tests.conftest import rows


def test_flatten_items_inner_unwind(spark):
    items = enrich.flatten_items(fx.transactions(spark))
    assert items.count() == 6          # t4 (empty) and t5 (null) vanish
    got = rows(items.where("transaction_id = 't2'").orderBy("line_number"),
               "line_number", "product_id", "quantity", "subtotal")
    assert got == [(1, "p3", 1, 30.0), (2, "p1", 1, 10.0)]


def test_enrich_products_left_lookups(spark):
    out = enrich.enrich_products(fx.products(spark), fx.categories(spark)).orderBy("product_id")
    got = rows(out, "product_id", "category_name", "subcategory_name")
    # sub_x exists under both categories: the greatest category id (cat_b) wins
    assert got == [("p1", "Alpha", "Chairs"), ("p2", "Alpha", "Shared-B"),
                   ("p3", "Beta", "Desks"), ("p4", None, None)]
    ph = rows(out.where("product_id = 'p1'"), "price_history")[0][0]
    assert ph[0]["date"] == dt.datetime(2024, 1, 1)
    assert rows(out.where("product_id = 'p1'"), "creation_date")[0][0] == dt.datetime(2024, 1, 1)


def test_purchase_summary_and_favourite(spark):
    tx, pr = fx.transactions(spark), fx.products(spark)
    s = enrich.purchase_summary(tx, enrich.flatten_items(tx), pr).orderBy("user_id")
    got = {r.user_id: r for r in s.collect()}
    assert got["u1"].total_orders == 2 and got["u1"].total_spent == 76.0
    # u1 bought cat_a: 2+1+1 = 4, cat_b: 1
    assert got["u1"].favorite_category == "cat_a"
    # u2: p2 (cat_a, 3) and p9 (unknown, skipped)
    assert got["u2"].favorite_category == "cat_a"
    # u4: only empty / null baskets -> counted orders, no favourite
    assert got["u4"].total_orders == 2 and got["u4"].favorite_category is None
    assert got["u4"].last_purchase_date == dt.datetime(2024, 3, 2)


def test_favourite_tie_goes_to_smallest_category(spark):
    from mercato.sources.schemas import TRANSACTIONS
    tx = spark.createDataFrame([
        ("t1", None, "u1", "2024-01-10T12:00:00", [("p3", 2, 1.0, 2.0), ("p1", 2, 1.0, 2.0)],
         4.0, 0.0, 4.0, "paypal", "completed")], TRANSACTIONS)
    s = enrich.purchase_summary(tx, enrich.flatten_items(tx), fx.products(spark))
    assert rows(s, "favorite_category") == [("cat_a",)]


def test_enrich_users_zero_orders_and_rounding(spark):
    tx, pr = fx.transactions(spark), fx.products(spark)
    s = enrich.purchase_summary(tx, enrich.flatten_items(tx), pr)
    u = enrich.flatten_user_profile(enrich.enrich_users(fx.users(spark), s)).orderBy("user_id")
    got = {r.user_id: r for r in u.collect()}
    assert (got["u3"].total_orders, got["u3"].total_spent, got["u3"].avg_order_value,
            got["u3"].last_purchase_date, got["u3"].favorite_category) == (0, 0.0, 0.0, None, None)
    assert got["u1"].avg_order_value == 38.0
    assert got["u4"].avg_order_value == 0.0 and got["u4"].total_orders == 2


def test_enrich_transactions_keeps_empty_baskets(spark):
    tx, pr = fx.transactions(spark), fx.products(spark)
    out = enrich.enrich_transactions(tx, enrich.flatten_items(tx), pr)
    assert out.count() == 8            # 6 items + t4 + t5 with NULL item fields
    t3 = rows(out.where("transaction_id = 't3'").orderBy("line_number"),
              "product_id", "product_name", "category_id")
    assert t3 == [("p2", "Lamp", "cat_a"), ("p9", None, None)]
    assert rows(out.where("transaction_id = 't4'"), "product_id") == [(None,)]
