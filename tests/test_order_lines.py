"""Order lines move once on their way to their numbers."""

from decimal import Decimal

from starloom.operators.ordering import number_rows
from starloom.sources import orderdata
from starloom.workspace import Workspace

LINES = "l_orderkey long, l_partkey long, l_quantity double, l_discount double, l_suppkey long"
PRODUCTS = "product_id long, product_key long, cost decimal(10,2), unit_price decimal(10,2)"


def test_lines_are_grouped_and_numbered_where_their_range_lies(spark, tmp_path):
    raw = [(o, p, float(o % 5 + 1), p / 100, s) for o in range(200) for p in (3, 1, o % 7, 99) for s in (2, 1)]
    raw += [(None, 3, 1.0, 0.1, 4), (None, 3, 2.0, 0.2, 5), (4, None, 1.0, 0.1, 4), (5, 3, None, None, None)]
    # Product 3 is there twice, with keys of their own; 99 is not there.
    products = [(p, p + 10, Decimal("1.50"), Decimal("10.00")) for p in range(7)] + [(3, 50, Decimal("2.50"), Decimal("20.00"))]
    kept = spark.createDataFrame(products, PRODUCTS)
    lines = orderdata.order_lines(spark.createDataFrame(raw, LINES).repartition(5), kept)
    # One move by range: no other exchange of lines, neither here nor for the numbers.
    moved = lines._jdf.queryExecution().executedPlan().toString()
    assert moved.count("rangepartitioning") == 1 and "Exchange hashpartitioning(order_id" not in moved

    want = {}
    for o, p, quantity, rate, supplier in raw:
        for product_id, key, _, price in products:
            if product_id == p:
                group = want.setdefault((o, p, key), [0, Decimal(0), []])
                group[0] += int(quantity or 0)
                group[1] = max(group[1], Decimal(f"{rate or 0:.2f}"))
                group[2] += [supplier] if supplier is not None else []
    scratch = Workspace(spark, f"file://{tmp_path}")
    rows = number_rows(lines, "n", orderdata.LINE_ORDER, scratch=scratch, ranged=True).orderBy("n").collect()
    assert [r.n for r in rows] == list(range(1, len(want) + 1))
    order = [(r.order_id is not None, r.order_id or 0, r.product_id) for r in rows]
    assert order == sorted(order)
    assert {(r.order_id, r.product_id, r.product_key): (r.quantity, r.supplier) for r in rows} == {
        k: (g[0], min(g[2])) for k, g in want.items()
    }
    assert all(r.unit_price is None or r.discount <= r.unit_price for r in rows)
