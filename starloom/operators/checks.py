"""Data-quality operators: row rules, uniqueness, references, reconciliation, report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from starloom.functions import labels


def stack_rows(dfs: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def count_where(condition: Column) -> Column:
    """Rows for which the condition is true, as one aggregate among others."""
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("long")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once, with their count."""
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.filter(complete).groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def missing_parents(
    child: DataFrame, column: str, parent: DataFrame, target: str
) -> DataFrame:
    """Child key values without a parent, with the number of rows that hold each.

    Values are counted before the join, so a value held by many rows is one row in it.
    """
    held = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_key")).count()
    return held.join(parent.select(F.col(target).alias("_key")), "_key", "left_anti")


@dataclass(frozen=True)
class _Rule:
    """A declared rule and where its violations turn up: a domain of values, and the role in it."""

    table: str
    text: str
    domain: int
    role: int


def _as_text(columns: Sequence[Column]) -> Column:
    """The key of a row as text; null if any part is."""
    parts = [c.cast("string") for c in columns]
    if len(parts) == 1:
        return parts[0]
    complete = reduce(lambda a, b: a & b, [c.isNotNull() for c in columns])
    return F.when(complete, F.to_json(F.array(*parts)))


def _tagged_values(tables: dict[str, DataFrame], contracts) -> tuple[DataFrame, list[_Rule]]:
    """domain, value, second, text, role rows of all tables, and the rules in the order of the tables.

    A domain is a key of a table, with role 0 for the rows that hold it and one further role for each column
    that refers to it. Every row-local rule is a domain of its own, numbered downwards from -1, with a value only for the rows
    that break it: their key. Each table is read once. One or two whole numbers are kept as they are, in ``value`` and
    ``second``, as every row sends its keys and references through the exchange; anything else is ``text``.
    """
    domains: dict[tuple[str, tuple[str, ...]], int] = {}
    roles: dict[int, int] = {}
    rules: list[_Rule] = []
    entries: dict[str, list[tuple[int, tuple[str, ...], int]]] = {name: [] for name in tables}
    broken_rows: dict[str, list[tuple[int, Column]]] = {name: [] for name in tables}

    def domain_of(table: str, columns: tuple[str, ...]) -> int:
        if (table, columns) not in domains:
            domains[table, columns] = len(domains)
            entries[table].append((domains[table, columns], columns, 0))
        return domains[table, columns]

    locals_ = 0
    for name in tables:
        contract = contracts[name]
        broken = {f"not null {c}": F.col(c).isNull() for c in contract.required}
        broken |= {f"length {c} <= {n}": F.length(c) > n for c, n in contract.lengths.items()}
        broken |= {f"check {c}": ~F.expr(c) for c in contract.checks}
        held = F.coalesce(F.col(contract.key).cast("string"), F.lit("(null)"))
        for text, condition in broken.items():
            locals_ += 1
            rules.append(_Rule(name, text, -locals_, 1))
            broken_rows[name].append((-locals_, F.when(condition, held)))
        for keys in [(contract.key,), *contract.unique]:
            rules.append(_Rule(name, f"unique {', '.join(keys)}", domain_of(name, tuple(keys)), 0))
        for ref in contract.foreign:
            if ref.table in tables:
                domain = domain_of(ref.table, (ref.target,))
                roles[domain] = roles.get(domain, 0) + 1
                rules.append(_Rule(name, f"{ref.column} in {ref.table}", domain, roles[domain]))
                entries[name].append((domain, (ref.column,), roles[domain]))

    # Values of a domain are alike only if all that hold them are whole numbers.
    as_text = {
        domain
        for name, held in entries.items()
        for domain, columns, _ in held
        if len(columns) > 2 or not all(isinstance(tables[name].schema[c].dataType, T.IntegralType) for c in columns)
    }
    nothing = F.lit(None).cast("bigint")

    def tag(domain: int, role: int, value: Column, first: Column = nothing, second: Column = nothing) -> Column:
        return F.struct(
            F.lit(domain).alias("domain"),
            first.cast("bigint").alias("value"),
            second.cast("bigint").alias("second"),
            value.cast("string").alias("text"),
            F.lit(role).alias("role"),
        )

    def entry(domain: int, columns: tuple[str, ...], role: int) -> Column:
        parts = [F.col(c) for c in columns]
        if domain in as_text:
            text = _as_text(parts)
            return F.when(text.isNotNull(), tag(domain, role, text))
        complete = reduce(lambda a, b: a & b, [c.isNotNull() for c in parts])
        return F.when(complete, tag(domain, role, F.lit(None), *parts))

    def exploded(name: str) -> DataFrame:
        # Rows that break no rule of their own, all but a few, make an array of their keys and references only.
        tagged = F.array(*[entry(*e) for e in entries[name]])
        if broken_rows[name]:
            sound = reduce(lambda a, b: a & b, [value.isNull() for _, value in broken_rows[name]])
            broken = F.array(*[F.when(value.isNotNull(), tag(domain, 1, value)) for domain, value in broken_rows[name]])
            tagged = F.when(sound, tagged).otherwise(F.concat(tagged, broken))
        return tables[name].select(F.explode(tagged).alias("v")).where("v IS NOT NULL").select("v.*")

    return stack_rows([exploded(name) for name in tables]), rules


def violating_values(tables: dict[str, DataFrame], contracts) -> tuple[DataFrame, list[_Rule]]:
    """domain, role, value, rows: each value that breaks a rule, with the rows it stands for.

    All keys and references of all tables meet in one exchange by domain and value, counted on the map side, so a
    value held by a third of the rows is one row for each task. A repeated key counts once.
    """
    tagged, rules = _tagged_values(tables, contracts)
    most = max(r.role for r in rules)
    met = tagged.groupBy("domain", "value", "second", "text").agg(
        *[F.count_if(F.col("role") == i).alias(f"n{i}") for i in range(most + 1)]
    )
    # What breaks no rule goes before anything is made of it.
    unheld = reduce(lambda a, b: a | b, [F.col(f"n{i}") > 0 for i in range(1, most + 1)], F.lit(False))
    met = met.where((F.col("n0") > 1) | ((F.col("n0") == 0) & unheld))
    repeated = F.when(F.col("n0") > 1, F.lit(1).cast("long")).otherwise(0)
    found = [(0, repeated), *[(i, F.when(F.col("n0") == 0, F.col(f"n{i}")).otherwise(0)) for i in range(1, most + 1)]]
    slots = F.array(*[F.struct(F.lit(i).alias("role"), n.alias("rows")) for i, n in found])
    pair = F.when(F.col("second").isNotNull(), _as_text([F.col("value"), F.col("second")]))
    value = F.coalesce("text", pair, F.col("value").cast("string")).alias("value")
    bad = met.select("domain", value, F.filter(slots, lambda x: x["rows"] > 0).alias("b")).filter("size(b) > 0")
    bad = bad.select("domain", "value", F.explode("b").alias("b"))
    return bad.select("domain", F.col("b.role").alias("role"), "value", F.col("b.rows").alias("rows")), rules


def _rule_rows(spark, rules: Sequence[_Rule]) -> DataFrame:
    rows = [(r.table, r.text, r.domain, r.role) for r in rules]
    return spark.createDataFrame(rows, "table_name string, rule string, domain int, role int")


def constraint_report(tables: dict[str, DataFrame], contracts) -> DataFrame:
    """Violations of every declared rule: NOT NULL, length, check, uniqueness, reference.

    Rows count for a row rule and for a reference without its target, repeated values for uniqueness.
    """
    bad, rules = violating_values(tables, contracts)
    counted = bad.groupBy("domain", "role").agg(F.sum("rows").alias("violations"))
    return _rule_rows(bad.sparkSession, rules).join(counted, ["domain", "role"], "left").select(
        "table_name", "rule", F.coalesce("violations", F.lit(0)).cast("long").alias("violations")
    )


def constraint_samples(tables: dict[str, DataFrame], contracts, k: int = 10) -> DataFrame:
    """Up to ``k`` offending values of every broken rule, the same in every run: those of the least MD5 digests.

    For a row rule the value is the row's key, else the repeated or missing value. The least of a rule merge from
    the least of each task, so a rule that every row breaks sends ``k`` rows from each task.
    """
    bad, rules = violating_values(tables, contracts)
    order = Window.partitionBy("domain", "role").orderBy("_digest", "value")
    least = bad.withColumn("_digest", F.md5("value")).withColumn("place", F.row_number().over(order))
    kept = least.filter(F.col("place") <= k)
    return _rule_rows(bad.sparkSession, rules).join(kept, ["domain", "role"]).select(
        "table_name", "rule", "place", "value", "rows"
    )


def reconcile(
    left: DataFrame, right: DataFrame, keys: Sequence[str], measure: str, names: tuple[str, str]
) -> DataFrame:
    """Full outer comparison of two aggregates; ``differs`` is null-safe."""
    a = left.groupBy(*keys).agg(F.sum(measure).alias(names[0]))
    b = right.groupBy(*keys).agg(F.sum(measure).alias(names[1]))
    return a.join(b, list(keys), "full").withColumn(
        "differs", ~F.col(names[0]).eqNullSafe(F.col(names[1]))
    )


def report_rows(
    probe: DataFrame, checks: Sequence[tuple[int, str, str, Column, Column]]
) -> DataFrame:
    """Turn a one-row probe into rows of ord, dimension, check_name, expected, actual."""
    rows = F.array(
        *[
            F.struct(
                F.lit(number).alias("ord"),
                F.lit(dimension).alias("dimension"),
                F.lit(name).alias("check_name"),
                expected.cast("string").alias("expected"),
                actual.cast("string").alias("actual"),
            )
            for number, dimension, name, expected, actual in checks
        ]
    )
    return probe.select(F.explode(rows).alias("c")).select("c.*")


def with_verdict(report: DataFrame) -> DataFrame:
    same = F.col("expected") == F.col("actual")
    return report.withColumn("result", F.when(same, labels.PASS).otherwise(labels.FAIL))
