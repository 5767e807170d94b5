"""The 54 checks pass on the built star, and each one fails on a star broken for it."""

import re
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from starloom.operators import checks
from starloom.operators.checks import constraint_report, constraint_samples
from starloom.plans import validation
from starloom.plans.warehouse import open_warehouse
from starloom.sources.contracts import SOURCE_TABLES, WAREHOUSE_TABLES, Column, ForeignKey, TableContract

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def built(spark):
    w = open_warehouse(spark, FOLDER)
    star = {**w.star(), "scratch": w.scratch}
    source = {t: w.scratch.save(df, f"src-{t}") for t, df in w.source().items()}
    return star, source, w.calendar


def failures(star, source, calendar, check=None):
    s = SimpleNamespace(**star)
    report = {
        "dim_date": lambda: validation.check_dim_date(s, source, *calendar),
        "dims": lambda: validation.check_dims(s, source),
        "history": lambda: validation.check_history(s, source),
        "fact": lambda: validation.check_fact(s, source),
    }
    df = report[check]() if check else validation.validate(s, source, *calendar)
    return {r.ord for r in df.collect() if r.expected != r.actual}


def test_everything_passes(built):
    star, source, calendar = built
    report = validation.validate(SimpleNamespace(**star), source, *calendar).collect()
    assert [r.ord for r in report] == sorted(validation.CHECKS)
    assert {r.result for r in report} == {"PASS"}


def changed(df, where, **columns):
    return df.withColumns(
        {c: F.when(F.expr(where), F.expr(e)).otherwise(F.col(c)) for c, e in columns.items()}
    )


BREAKAGES = [
    # check group, star table, change, checks that must fail
    ("dim_date", "dim_date", lambda d: d.filter("date_key <> 19990228"), {1, 2}),
    ("dim_date", "dim_date", lambda d: changed(d, "day = 1", date_key="date_key + 1", month_name="month_name || ' '"), {3, 4}),
    ("dim_date", "dim_date", lambda d: changed(d, "day = 5", day_of_week="8"), {5, 6}),
    ("dim_date", "dim_date", lambda d: changed(d, "year = 1999", is_leap_year="true"), {7}),
    ("dim_date", "dim_date", lambda d: changed(d, "month = 7", fiscal_year="1990", fiscal_quarter="3"), {8, 9}),
    ("dim_date", "dim_date", lambda d: d.filter("year < 2001"), {1, 10}),
    ("dims", "dim_store", lambda d: d.union(d.filter("store_id = 1")), {20, 22}),
    ("dims", "dim_store", lambda d: changed(d, "store_id = 1", city="null"), {21}),
    ("dims", "dim_employee", lambda d: d.filter("employee_key > 1"), {30, 31, 32}),
    ("dims", "dim_employee", lambda d: changed(d, "employee_id = 3", manager_name="'x'", store_name="null"), {33, 34}),
    ("dims", "dim_product", lambda d: d.filter("product_id <> 3"), {40, 41}),
    ("dims", "dim_product", lambda d: changed(d, "product_id = 3", category_name="null"), {42, 43}),
    ("dims", "dim_product", lambda d: changed(d, "product_id = 3", parent_category_name="'x'"), {44, 45}),
    ("dims", "dim_product", lambda d: changed(d, "product_id = 3", category_path="'x'"), {45, 46}),
    ("history", "dim_customer", lambda d: d.filter("customer_id <> 7"), {50, 52}),
    ("history", "dim_customer", lambda d: changed(d, "not is_current", is_current="true"), {51, 53}),
    ("history", "dim_customer", lambda d: changed(d, "not is_current", valid_to="null"), {54, 56}),
    ("history", "dim_customer", lambda d: changed(d, "not is_current", valid_to="valid_from - 1"), {55, 56}),
    ("history", "dim_customer", lambda d: changed(d, "is_current", city="'x'"), {57}),
    ("history", "dim_customer", lambda d: changed(d, "customer_id = 7", valid_from="date '2001-12-01'"), {58, 59}),
    ("fact", "fact_sales", lambda d: d.filter("order_id <> 5"), {70, 71, 72, 87, 88}),
    ("fact", "fact_sales", lambda d: changed(d, "order_id = 5", net_amount="net_amount + 1"), {71, 73, 74, 87, 88}),
    ("fact", "fact_sales", lambda d: changed(d, "order_id = 5", gross_amount="gross_amount + 1"), {72, 73, 75}),
    ("fact", "fact_sales", lambda d: changed(d, "order_id = 5", cost_amount="cost_amount + 1"), {74, 76}),
    ("fact", "fact_sales", lambda d: changed(d, "order_id = 5", date_key="19950101", store_key="1"), {77, 78, 87, 88}),
    ("fact", "fact_sales", lambda d: changed(d, "order_id = 5", product_key="1"), {76, 79}),
    ("fact", "fact_sales", lambda d: changed(d, "order_id = 5", customer_key="1"), {80}),
    ("fact", "fact_sales", lambda d: changed(d, "channel = 'in-store'", employee_key="-1"), {81}),
    ("fact", "fact_sales", lambda d: changed(d, "channel = 'online'", employee_key="1"), {82, 83}),
    ("fact", "fact_sales", lambda d: d.union(d.filter("order_id = 5")), {70, 84}),
    ("fact", "fact_sales", lambda d: changed(d, "order_id = 5", order_status="'x'"), {85}),
    ("fact", "fact_sales", lambda d: changed(d, "order_id = 5", quantity="0"), {75, 76, 86}),
]


@pytest.mark.parametrize("check, table, change, expected", BREAKAGES)
def test_checks_notice_damage(built, check, table, change, expected):
    star, source, calendar = built
    broken = {**star, table: change(star[table])}
    assert expected <= failures(broken, source, calendar, check)


def test_constraint_report_notices_damage(built):
    _, source, _ = built
    broken = dict(source)
    broken["orders"] = changed(
        source["orders"], "order_id = 5", status="'confirmed'", customer_id="-5", total_amount="0"
    )
    broken["customers"] = changed(source["customers"], "customer_id < 2", email="'same'", sex="null")
    broken["categories"] = changed(
        source["categories"], "category_id = 1", name="repeat('x', 101)", parent_category_id="77"
    )
    report = constraint_report(broken, SOURCE_TABLES).filter("violations > 0").collect()
    assert {(r.table_name, r.rule, r.violations) for r in report} == {
        ("orders", "check status IN ('pending', 'completed', 'cancelled', 'shipped', 'delivered')", 1),
        ("orders", "check total_amount > 0", 1),
        ("orders", "customer_id in customers", 1),
        ("customers", "unique email", 1),
        ("customers", "not null sex", 2),
        ("categories", "length name <= 100", 1),
        ("categories", "parent_category_id in categories", 1),
    }


def test_values_meet_in_one_exchange_and_samples_repeat(spark):
    import hashlib

    box = TableContract("box", (Column("id", "bigint", required=True), Column("label", "string", length=3)), "id", unique=(("label", "id"), ("label",)))
    ball = TableContract(
        "ball", (Column("id", "bigint"), Column("box_id", "bigint", required=True)), "id",
        foreign=(ForeignKey("box_id", "box", "id"),), checks=("id > 0",),
    )
    boxes = [(i, f"l{i % 90}") for i in range(100)] + [(None, None), (5, "long"), (None, "x")]
    # A third of the balls share a box that is not there.
    balls = [(i, i % 120) for i in range(-3, 297)] + [(1000 + i, 777) for i in range(150)] + [(9, None)]
    tables = {
        "box": spark.createDataFrame(boxes, "id long, label string").repartition(3),
        "ball": spark.createDataFrame(balls, "id long, box_id long").repartition(5),
    }
    contracts = {"box": box, "ball": ball}
    report = constraint_report(tables, contracts)
    got = {(r.table_name, r.rule): r.violations for r in report.collect()}
    missing = [b for _, b in balls if b is not None and b not in range(100)]
    assert got == {
        ("box", "not null id"): 2, ("box", "length label <= 3"): 1, ("box", "unique id"): 1,
        ("box", "unique label, id"): 0, ("box", "unique label"): 10,
        ("ball", "not null box_id"): 1, ("ball", "check id > 0"): 4, ("ball", "unique id"): 1,
        ("ball", "box_id in box"): len(missing),
    }
    plan = report._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert len(re.findall(r"Exchange hashpartitioning\(domain#\d+, value#", plan)) == 1

    samples = constraint_samples(tables, contracts, 3).collect()
    value = lambda x: hashlib.md5(x.encode()).hexdigest()
    want = sorted({str(b) for b in missing}, key=value)[:3]
    assert [r.value for r in sorted(samples, key=lambda r: r.place) if r.rule == "box_id in box"] == want
    assert {r.value: r.rows for r in samples if r.rule == "not null id"} == {"(null)": 2}
    tables = {t: df.repartition(7) for t, df in tables.items()}
    assert sorted(constraint_samples(tables, contracts, 3).collect()) == sorted(samples)
    assert constraint_samples({t: df.limit(0) for t, df in tables.items()}, contracts).count() == 0


def test_warehouse_satisfies_its_own_contracts(built):
    star, _, _ = built
    tables = {t: star[t] for t in WAREHOUSE_TABLES}
    report = constraint_report(tables, WAREHOUSE_TABLES)
    assert report.filter("violations > 0").collect() == []


# What breaks each business rule: the table, and the damage to it.
RULES = [
    ("order total differs from its lines", "orders", {"total_amount": "total_amount + 1"}),
    ("order in a paid status without payment", "payments", None),
    ("payment of an order in an unpaid status", "orders", {"status": "'pending'"}),
    ("payments differ from the order total", "payments", {"amount": "amount + 1"}),
    ("online with employee, or in store without", "orders", {"channel": "if(channel = 'online', 'in-store', 'online')"}),
    ("order before its store opened", "stores", {"opened_date": "date '2030-01-01'"}),
    ("order before the customer signed up", "customers", {"signup_date": "date '2030-01-01'"}),
]


@pytest.mark.parametrize("rule, table, damage", RULES)
def test_each_business_rule_sees_its_damage(built, rule, table, damage):
    _, source, _ = built
    sound = {r.rule: r.violations for r in validation.business_rules(source).collect()}
    rows = source[table].limit(0) if damage is None else source[table].withColumns(
        {c: F.expr(x).cast(source[table].schema[c].dataType) for c, x in damage.items()}
    )
    broken = validation.business_rules({**source, table: rows}).collect()
    assert {r.rule: r.violations for r in broken}[rule] > sound[rule]


def test_whole_number_keys_meet_without_text(spark):
    """Every line sends its keys through the exchange; text only where a key or a reference to it is text."""
    parents = TableContract("parents", (Column("p", "bigint"), Column("code", "string")), "p", unique=(("code",),))
    lines = TableContract(
        "lines",
        (Column("k", "bigint"), Column("a", "int"), Column("p", "int"), Column("c", "string")),
        "k",
        unique=(("a", "p"), ("a", "c")),
        foreign=(ForeignKey("p", "parents", "p"),),
    )
    tables = {
        "parents": spark.createDataFrame([(1, "x"), (2, "x"), (None, None)], parents.schema),
        "lines": spark.createDataFrame(
            [(1, 5, 1, "u"), (2, 5, 1, "u"), (2, 5, None, None), (None, 6, 9, "u"), (3, None, 9, "w")], lines.schema
        ),
    }
    contracts = {"parents": parents, "lines": lines}
    tagged, _ = checks._tagged_values(tables, contracts)
    texts = {r.text for r in tagged.collect()}
    assert texts == {None, "x", '["5","u"]', '["6","u"]'}
    found = {(r.rule, r.value): r.rows for r in checks.constraint_samples(tables, contracts).collect()}
    assert found == {
        ("unique code", "x"): 1,
        ("unique k", "2"): 1,
        ("unique a, p", '["5","1"]'): 1,
        ("unique a, c", '["5","u"]'): 1,
        ("p in parents", "9"): 2,
    }
    # A reference of another type than its key makes the domain one of texts.
    mixed = {**tables, "lines": tables["lines"].withColumn("p", F.col("p").cast("string"))}
    again = {(r.rule, r.value): r.rows for r in checks.constraint_samples(mixed, contracts).collect()}
    assert again == found
