import random

import pytest

from mercato.operators import baskets, enrich
from tests import fixtures as fx

TX = "transaction_id long, user_id string, timestamp timestamp, total double"
IT = "transaction_id long, line_number int, product_id string, quantity long, unit_price double, subtotal double"
PR = "product_id string, name string, category_id string"


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_unwinding_gives_the_flat_table_back(spark, size):
    r = random.Random(1)
    lines = [(r.randint(0, 9), r.choice([None, *range(1, 12)]), f"p{r.randint(0, 5)}", r.randint(1, 3), 1.0, 2.0) for _ in range(150)]
    lines += [(50, i, "p1", 1, 1.0, 1.0) for i in range(1, 300)] + [(51, 1, "p1", 1, 1.0, 1.0)] * 20  # long, and of one number
    tx = spark.createDataFrame([(i, "u", None, 1.0) for i in [*range(10), 50, 51, 77]], TX)
    products = spark.createDataFrame([("p0", "zero", "c0"), ("p1", "one", "c1")], PR)
    items = spark.createDataFrame(lines, IT)
    nested = baskets.nest_transactions(tx, items, products, size)
    rows = nested.collect()
    by = {}
    for x in sorted(rows, key=lambda x: (x.transaction_id, x.part)):
        assert len(x["items"]) <= size
        by.setdefault(x.transaction_id, []).append(x)
    assert all([p.part for p in ps] == list(range(1, len(ps) + 1)) and {p.n_parts for p in ps} == {len(ps)} for ps in by.values())
    assert by[77][0]["items"] == [] and len(by[50]) == -(-299 // size)
    assert [i.line_number for p in by[50] for i in p["items"]] == list(range(1, 300))
    flat = baskets.unnest_transactions(nested).select(*IT.replace(" long", "").replace(" int", "").replace(" string", "").replace(" double", "").split(", "))
    assert sorted(map(str, flat.collect())) == sorted(map(str, items.collect()))
    order = [(i.line_number is None, i.line_number or 0) for i in [i for p in by[3] for i in p["items"]] if i.line_number is not None]
    assert order == sorted(order)


def test_nested_documents_keep_header_and_empty_baskets(spark):
    t, p = fx.transactions(spark), fx.products(spark)
    nested = baskets.nest_transactions(t, enrich.flatten_items(t), p).collect()
    source = {r.transaction_id: r["items"] for r in t.collect()}
    assert {r.transaction_id for r in nested} == set(source)
    for r in nested:
        assert [(i.product_id, i.quantity) for i in r["items"]] == [(i.product_id, i.quantity) for i in source[r.transaction_id] or []]
    assert baskets.nest_transactions(t.limit(0), enrich.flatten_items(t), p).count() == 0
