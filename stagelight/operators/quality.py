"""Declared constraints, checked as a job: how many rows break each of them."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagelight.schemas import CONSTRAINTS, Rules


class _Check(NamedTuple):
    """One constraint. Its rows lie in ``domain``: a key's own values (slot 0), references to it (slots from 1)."""

    table: str
    column: str
    rule: str
    domain: int
    slot: int = 0


class _Plan:
    """Domains and checks of all tables, and what each table sends to them."""

    def __init__(self, tables: Mapping[str, DataFrame], constraints: Mapping[str, Rules]):
        self.checks: list[_Check] = []
        self.sent: dict[str, list[Column]] = {}
        self.domains: dict[tuple[str, str], int] = {}
        self.slots = 1
        used: dict[int, int] = {}
        present = {name: rules for name, rules in constraints.items() if name in tables}
        for name, rules in present.items():
            self._send(name, rules.key, "primary_key", self._domain(name, rules.key))
        for name, rules in present.items():
            for column in rules.required:
                self._send_broken(name, column, "not_null", F.col(column).isNull())
            for column in rules.unique:
                self._send(name, column, "unique", self._domain(name, f"unique {column}"))
            for column in rules.flags:
                self._send_broken(name, column, "in_0_1", ~F.col(column).isin(0, 1))
            for column, (parent, key) in rules.foreign.items():
                if parent not in present:
                    continue
                domain = self._domain(parent, key)
                used[domain] = used.get(domain, 0) + 1
                self.slots = max(self.slots, used[domain] + 1)
                self._send(name, column, "foreign_key", domain, used[domain], F.col(column).isNotNull())

    def _domain(self, table: str, name: str) -> int:
        return self.domains.setdefault((table, name), len(self.domains))

    def _send(self, table: str, column: str, rule: str, domain: int, slot: int = 0, where: Column | None = None) -> None:
        self.checks.append(_Check(table, column, rule, domain, slot))
        row = F.struct(
            F.lit(domain).alias("domain"), F.lit(slot).alias("slot"), F.col(column).cast("string").alias("value")
        )
        self.sent.setdefault(table, []).append(row if where is None else F.when(where, row))

    def _send_broken(self, table: str, column: str, rule: str, broken: Column) -> None:
        domain = self._domain(table, f"{rule} {column}")
        self.checks.append(_Check(table, column, rule, domain))
        row = F.struct(
            F.lit(domain).alias("domain"), F.lit(0).alias("slot"), F.lit(None).cast("string").alias("value")
        )
        self.sent.setdefault(table, []).append(F.when(broken, row))


def constraint_violations(
    tables: Mapping[str, DataFrame], constraints: Mapping[str, Rules] = CONSTRAINTS
) -> DataFrame:
    """One row per constraint of the given tables: rows checked and rows that break it.

    A key or unique value held by n rows counts n - 1 violations; a NULL key counts as one. A table needs a primary key
    among its rules, which counts its rows; references to tables that are not given are not checked.

    Every table is read once. Its keys, references and broken rows go to domains, one per key, and are combined
    map-side per value, so a value held by very many rows is one row in the only shuffle of values. There a reference
    meets the key it refers to.
    """
    plan = _Plan(tables, constraints)
    sent = [
        tables[name].select(F.inline(F.filter(F.array(*rows), lambda row: row.isNotNull())))
        for name, rows in plan.sent.items()
    ]
    counts = [F.count_if(F.col("slot") == k).alias(f"n_{k}") for k in range(plan.slots)]
    values = reduce(DataFrame.unionByName, sent).groupBy("domain", "value").agg(*counts)
    own, has_value = F.col("n_0"), F.col("value").isNotNull()
    sums = [
        F.sum(own).alias("rows"),
        F.sum(F.when(has_value, own)).alias("values"),
        F.count_if(has_value & (own > 0)).alias("distinct"),
    ]
    for k in range(1, plan.slots):
        sums += [F.sum(f"n_{k}").alias(f"used_{k}"), F.sum(F.when(own == 0, F.col(f"n_{k}"))).alias(f"lost_{k}")]
    domains = values.groupBy("domain").agg(*sums)  # a few dozen rows
    keys = {check.table: check.domain for check in plan.checks if check.rule == "primary_key"}

    def of(domain: int, column: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("domain") == domain, F.col(column))), F.lit(0))

    results = []
    for check in plan.checks:
        domain = check.domain
        if check.rule == "primary_key":
            checked, broken = of(domain, "rows"), of(domain, "rows") - of(domain, "distinct")
        elif check.rule == "unique":
            checked, broken = of(domain, "values"), of(domain, "values") - of(domain, "distinct")
        elif check.rule == "foreign_key":
            checked, broken = of(domain, f"used_{check.slot}"), of(domain, f"lost_{check.slot}")
        else:
            checked, broken = of(keys[check.table], "rows"), of(domain, "rows")
        results.append(
            F.struct(
                F.lit(check.table).alias("table_name"),
                F.lit(check.column).alias("column_name"),
                F.lit(check.rule).alias("rule"),
                checked.alias("rows_checked"),
                broken.alias("violations"),
            )
        )
    return domains.agg(F.array(*results).alias("results")).select(F.inline("results"))
