from datetime import date

import pytest
from pyspark.errors import PySparkException

from starloom.operators import dimensions as dims, history

STORE = "store_key long, store_id long, name string, city string"
INCOMING = "store_id long, name string, city string"


def upsert(current, incoming, scratch):
    return dims.upsert_type1(
        current, incoming, natural="store_id", surrogate="store_key", scratch=scratch
    )


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_type1_upsert_keeps_keys_and_counts_real_changes(spark, scratch):
    current = spark.createDataFrame(
        [(1, 10, "a", "x"), (2, 20, "b", None), (3, 30, "c", "z")], STORE
    )
    incoming = spark.createDataFrame(
        [(10, "a", "x"), (20, "b", "now known"), (50, "new", "y"), (40, "new", "y")], INCOMING
    )
    got = upsert(current, incoming, scratch)
    assert rows(got) == [
        (1, 10, "a", "x", "kept"),
        (2, 20, "b", "now known", "updated"),
        (3, 30, "c", "z", "kept"),
        (4, 40, "new", "y", "inserted"),
        (5, 50, "new", "y", "inserted"),
    ]
    again = upsert(scratch.save(got.drop("change"), "dim"), incoming, scratch)
    assert {r.change for r in again.collect()} == {"kept"}


def test_unknown_member_is_added_once(spark):
    dim = dims.empty_table(spark, "dim_employee")
    once = dims.with_unknown_member(dim, "employee_key", dims.UNKNOWN_EMPLOYEE)
    twice = dims.with_unknown_member(once, "employee_key", dims.UNKNOWN_EMPLOYEE)
    assert [r.employee_key for r in twice.collect()] == [-1]
    assert twice.schema == dim.schema
    assert dims.highest_key(twice, "employee_key") == 0


def test_hierarchy_of_any_depth(spark, scratch):
    nodes = spark.createDataFrame(
        [
            (1, None, "A"), (2, 1, "B"), (3, 2, "C"), (4, 3, "D"), (5, None, "E"),
            (6, 99, "orphan"), (7, 8, "cycle"), (8, 7, "cycle too"),
        ],
        "id long, parent long, name string",
    )
    got = dims.flatten_hierarchy(nodes, node="id", parent="parent", name="name", scratch=scratch)
    assert rows(got.fillna("-")) == [
        (1, "A", "-", "A", 1),
        (2, "B", "A", "A > B", 2),
        (3, "C", "B", "A > B > C", 3),
        (4, "D", "C", "A > B > C > D", 4),
        (5, "E", "-", "E", 1),
    ]


def test_nodes_of_a_cycle_are_found_as_unreached(spark, scratch):
    nodes = spark.createDataFrame(
        [(1, None, "A"), (2, 1, "B"), (3, 4, "C"), (4, 3, "D"), (5, 99, "E")], "id long, parent long, name string"
    )
    tree = dims.flatten_hierarchy(nodes, node="id", parent="parent", name="name", scratch=scratch)
    assert sorted(r.id for r in tree.collect()) == [1, 2]
    assert sorted(r.id for r in dims.unreached(nodes, tree, "id").collect()) == [3, 4, 5]


def test_employee_names_propagate_null(spark):
    employees = spark.createDataFrame(
        [(1, "Ann", "Bo", "a@x", date(2020, 1, 1), None, 7), (2, "Cy", "Di", "c@x", date(2020, 1, 1), 1, 8)],
        "employee_id long, first_name string, last_name string, email string, hire_date date,"
        "manager_id long, store_id long",
    )
    stores = spark.createDataFrame([(7, "Main")], "store_id long, name string")
    got = dims.employee_attributes(employees, stores).orderBy("employee_id").collect()
    assert [(r.full_name, r.manager_name, r.store_name) for r in got] == [
        ("Ann Bo", None, "Main"),
        ("Cy Di", "Ann Bo", None),
    ]


DIM = (
    "customer_key long, customer_id long, full_name string, email string, city string,"
    "signup_date date, valid_from date, valid_to date, is_current boolean"
)
SRC = "customer_id long, full_name string, email string, city string, signup_date date"
D0, D1, D2 = date(2020, 1, 1), date(2021, 1, 1), date(2022, 1, 1)


def merge(dim, src, as_of, scratch, refreshed=()):
    return history.scd2_merge(
        dim, src, natural="customer_id", surrogate="customer_key", first_valid="signup_date",
        tracked=["email", "city"], as_of=as_of, scratch=scratch, refreshed=refreshed,
    )


def step(dim, src_rows, as_of, spark, scratch, refreshed=()):
    src = spark.createDataFrame(src_rows, SRC)
    return scratch.save(merge(dim, src, as_of, scratch, refreshed), "merged")


def counts(merged):
    return tuple(history.change_counts(merged).first())


def test_scd2_life_of_a_dimension(spark, scratch):
    empty = spark.createDataFrame([], DIM)
    first = step(empty, [(1, "A", "a@x", "P", D0), (2, "B", None, "P", D0)], D1, spark, scratch)
    assert counts(first) == (0, 2)
    assert {(r.customer_key, r.valid_from, r.is_current) for r in first.collect()} == {
        (1, D0, True), (2, D0, True),
    }

    # 1 moves, 2 gets an e-mail in place of NULL, 3 is new, and a name alone is no change.
    changed = [(1, "A", "a@x", "Q", D0), (2, "B", "b@x", "P", D0), (3, "C", "c@x", "R", D1)]
    second = step(first.drop("change"), changed, D1, spark, scratch)
    assert counts(second) == (2, 3)
    versions = history.versions_of(second, "customer_id", [1]).collect()
    assert [(v.city, v.valid_from, v.valid_to, v.is_current) for v in versions] == [
        ("P", D0, D1, False), ("Q", D1, None, True),
    ]
    assert second.filter("customer_id = 3").first().valid_from == D1
    assert second.select("customer_key").distinct().count() == second.count() == 5

    again = step(second.drop("change"), changed, D2, spark, scratch)
    assert counts(again) == (0, 0)

    # Changing back opens a third version; a missing key stays current.
    back = step(again.drop("change"), [(1, "A2", "a@x", "P", D0)], D2, spark, scratch)
    assert counts(back) == (1, 1)
    assert [v.city for v in history.versions_of(back, "customer_id", [1]).collect()] == ["P", "Q", "P"]
    assert back.filter("is_current").count() == 3

    # A second change on the same day leaves a version of length zero behind.
    same_day = step(back.drop("change"), [(1, "A2", "a@x", "S", D0)], D2, spark, scratch)
    lengths = history.versions_of(same_day, "customer_id", [1]).collect()
    assert {(v.valid_from, v.valid_to) for v in lengths if v.valid_from == D2} == {
        (D2, D2), (D2, None),
    }


def test_scd2_refreshes_untracked_columns_on_request(spark, scratch):
    empty = spark.createDataFrame([], DIM)
    first = step(empty, [(1, "A", "a@x", "P", D0)], D1, spark, scratch).drop("change")
    renamed = [(1, "New", "a@x", "P", D0)]
    assert step(first, renamed, D1, spark, scratch).first().full_name == "A"
    refreshed = step(first, renamed, D1, spark, scratch, refreshed=["full_name"])
    assert (refreshed.first().full_name, counts(refreshed)) == ("New", (0, 0))


def test_scd2_refuses_to_end_a_row_before_its_start(spark, scratch):
    empty = spark.createDataFrame([], DIM)
    first = step(empty, [(1, "A", "a@x", "P", D2)], D1, spark, scratch).drop("change")
    with pytest.raises(PySparkException, match="starts after the change date"):
        step(first, [(1, "A", "a@x", "Q", D2)], D1, spark, scratch)


def test_a_long_chain_takes_few_joins(spark, scratch, monkeypatch):
    n = 5_000
    nodes = [(i, i - 1 if i else None, "x") for i in range(n)] + [(9_000, 9_001, "a"), (9_001, 9_000, "b"), (9_002, 9_001, "c"), (9_003, -5, "d"), (9_004, 9_003, "e")]
    saved = []
    real = scratch.save
    monkeypatch.setattr(scratch, "save", lambda df, name, **k: (saved.append(name), real(df, name, **k))[1])
    frame = spark.createDataFrame(nodes, "id long, parent long, name string").repartition(4)
    walked = dims.walk_hierarchy(frame, node="id", parent="parent", name="name", scratch=scratch, separator="/")
    got = {r.id: r for r in walked.selectExpr("id", "depth", "length(path) AS n", "parent_name", "state").collect()}
    assert len(saved) - 1 <= 15
    assert all(got[i].depth == i + 1 and got[i].n == 2 * i + 1 and got[i].state == dims.PLACED for i in range(n))
    assert [got[i].state for i in range(9_000, 9_005)] == [dims.CYCLE] * 3 + [dims.ORPHAN] * 2
    assert {got[i].depth for i in range(9_000, 9_005)} == {None}
