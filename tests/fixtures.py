"""Hand-made nested rows in the raw document shapes (edge cases the driver
tables lack)."""

from mercato.sources.schemas import CATEGORIES, PRODUCTS, SESSIONS, TRANSACTIONS, USERS


def users(spark):
    return spark.createDataFrame([
        ("u1", ("c1", "CA", "US"), "2024-01-05T10:00:00", "2024-03-01T00:00:00"),
        ("u2", ("c2", "IL", "US"), "2024-02-10T00:00:00", "2024-03-01T00:00:00"),
        ("u3", ("c3", "BY", "DE"), "2024-02-11T00:00:00", None),   # no orders
        ("u4", ("c4", "ON", "CA"), "2024-01-20T00:00:00", None),   # orders, no session
    ], USERS)


def products(spark):
    return spark.createDataFrame([
        ("p1", "Ergonomic Steel Chair With A Very Long Name", "cat_a", "sub_a1", 10.0, 5, True,
         [(9.0, "2024-01-01T00:00:00"), (10.0, "2024-02-01T00:00:00")], "2024-01-01T00:00:00"),
        ("p2", "Lamp", "cat_a", "sub_x", 20.0, None, None,
         [(20.0, "2024-01-03T00:00:00")], "2024-01-03T00:00:00"),
        ("p3", "Desk", "cat_b", "sub_b1", 30.0, 1, False,
         [(30.0, "2024-01-02T00:00:00"), (33.0, "2024-01-09T00:00:00"),
          (31.0, "2024-01-20T00:00:00")], "2024-01-02T00:00:00"),
        ("p4", "Pen", "cat_zz", None, 1.0, 100, True, [], None),      # unknown category
    ], PRODUCTS)


def categories(spark):
    return spark.createDataFrame([
        ("cat_a", "Alpha", [("sub_a1", "Chairs", 0.1), ("sub_x", "Shared-A", 0.2)]),
        ("cat_b", "Beta", [("sub_b1", "Desks", 0.3), ("sub_x", "Shared-B", 0.2)]),
    ], CATEGORIES)


def transactions(spark):
    return spark.createDataFrame([
        ("t1", "s1", "u1", "2024-01-10T12:00:00",
         [("p1", 2, 10.0, 20.0), ("p2", 1, 20.0, 20.0)], 40.0, 0.0, 40.0, "paypal", "completed"),
        ("t2", None, "u1", "2024-02-03T09:00:00",
         [("p3", 1, 30.0, 30.0), ("p1", 1, 10.0, 10.0)], 40.0, 4.0, 36.0, "crypto", "shipped"),
        ("t3", "s3", "u2", "2024-02-15T08:00:00",
         [("p2", 3, 20.0, 60.0), ("p9", 5, 1.0, 5.0)], 65.0, None, 65.0, "credit_card", "completed"),
        ("t4", None, "u4", "2024-03-01T00:00:00", [], 0.0, 0.0, 0.0, "gift_card", "completed"),
        ("t5", None, "u4", "2024-03-02T00:00:00", None, 0.0, 0.0, 0.0, "cash", "lost"),
    ], TRANSACTIONS)


def _pv(ts, page, pid=None):
    return (ts, page, pid, None, 10)


def sessions(spark):
    return spark.createDataFrame([
        ("s1", "u1", "2024-01-10T11:50:00", "2024-01-10T12:00:00", 600,
         ("c1", "CA", "US", "1.1.1.1"), ("mobile", "iOS", "Safari"), ["p1"],
         [_pv("2024-01-10T11:50:00", "home"), _pv("2024-01-10T11:52:00", "product_detail", "p1"),
          _pv("2024-01-10T11:55:00", "cart"), _pv("2024-01-10T11:58:00", "checkout")],
         {"p1": (2, 10.0)}, "converted", "email"),
        ("s2", "u1", "2024-01-01T08:00:00", "2024-01-01T08:05:00", 300,
         ("c1", "CA", "US", "1.1.1.1"), ("desktop", "Windows", "Edge"), [],
         [_pv("2024-01-01T08:00:00", "home"), _pv("2024-01-01T08:01:00", "search")],
         {}, "browsed", "direct"),
        ("s3", "u2", "2024-02-15T07:59:00", "2024-02-15T08:00:00", 60,
         ("c2", "IL", "US", "2.2.2.2"), ("tablet", "Android", "Chrome"), ["p2"],
         [_pv("2024-02-15T07:59:00", "product_detail", "p2")], {"p2": (0, 20.0)},
         "abandoned", "social"),
        ("s4", "u2", "2024-02-16T07:59:00", "2024-02-16T08:00:00", 0,
         ("c2", "IL", "US", "2.2.2.2"), ("tablet", "Android", "Chrome"), [], [],
         {}, "browsed", "fax"),
    ], SESSIONS)
