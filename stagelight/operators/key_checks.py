"""Declared constraints checked on sets of keys as bits: the result of ``quality.constraint_violations``, with a shuffle of
bits in place of keys. For tables whose keys are whole numbers or dates that lie close together."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagelight.plans.bitmaps import BITS, as_long, bits_of, chunk_of, count_bits, is_integral, unfolded
from stagelight.schemas import CONSTRAINTS, Rules

RESULT = "table_name string, column_name string, rule string, rows_checked long, violations long"


class _Check(NamedTuple):
    """One constraint. A key and the references to it share a ``domain``: the key is slot 0, references have slots from
    1. Counts of rows and of broken rows need no domain."""

    table: str
    column: str
    rule: str
    domain: int = -1
    slot: int = 0


class _Plan:
    """Checks of all tables, and what each table sends to domains and counts by itself."""

    def __init__(self, tables: Mapping[str, DataFrame], constraints: Mapping[str, Rules]):
        self.checks: list[_Check] = []
        self.sent: dict[str, list[Column]] = {}
        self.counted: dict[str, dict[str, Column]] = {}
        self.domains: dict[tuple[str, str], int] = {}
        self.kinds = {name: dict(tables[name].dtypes) for name in constraints if name in tables}
        self.slots = 1
        used: dict[int, int] = {}
        present = {name: rules for name, rules in constraints.items() if name in tables}
        for name, rules in present.items():
            self.counted[name] = {"rows": F.count(F.lit(1))}
            self._send(name, rules.key, "primary_key", self._domain(name, rules.key))
        for name, rules in present.items():
            for column in rules.required:
                self._count(name, column, "not_null", F.col(column).isNull())
            for column in rules.unique:
                self._send(name, column, "unique", self._domain(name, f"unique {column}"))
            for column in rules.flags:
                self._count(name, column, "in_0_1", ~F.col(column).isin(0, 1))
            for column, (parent, key) in rules.foreign.items():
                if parent not in present:
                    continue
                domain = self._domain(parent, key)
                used[domain] = used.get(domain, 0) + 1
                self.slots = max(self.slots, used[domain] + 1)
                self._send(name, column, "foreign_key", domain, used[domain])

    def _domain(self, table: str, name: str) -> int:
        return self.domains.setdefault((table, name), len(self.domains))

    def _send(self, table: str, column: str, rule: str, domain: int, slot: int = 0) -> None:
        self.checks.append(_Check(table, column, rule, domain, slot))
        self.sent.setdefault(table, []).append(self.key_row(self.checks[-1]))

    def key_row(self, check: _Check) -> Column:
        return _key_row(check.domain, check.slot, F.col(check.column), self.kinds[check.table][check.column])

    def _count(self, table: str, column: str, rule: str, broken: Column) -> None:
        self.checks.append(_Check(table, column, rule))
        self.counted[table][f"{rule} {column}"] = F.count_if(broken)


def _key_row(domain: int, slot: int, key: Column, kind: str) -> Column:
    """A key of a slot, or NULL: an integral key as a number, any other as text."""
    number = as_long(key, kind) if is_integral(kind) else F.lit(None).cast("long")
    text = F.lit(None).cast("string") if is_integral(kind) else key.cast("string")
    row = F.struct(F.lit(domain).alias("domain"), F.lit(slot).alias("slot"), number.alias("number"), text.alias("text"))
    return F.when(key.isNotNull(), row)


def _sent(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[Column]]) -> DataFrame:
    """The keys that tables send to domains, one row each."""
    rows = [
        tables[name].select(F.inline(F.filter(F.array(*own), lambda row: row.isNotNull())))
        for name, own in keys.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def _chunks(sent: DataFrame, slots: Iterable[int]) -> DataFrame:
    """Per domain and chunk of keys, or text, the rows and the key bits of every slot."""
    aggregates = []
    for k in slots:
        own = F.col("slot") == k
        aggregates += [F.count_if(own).alias(f"n_{k}"), *bits_of(F.col("number"), own, f"s{k}_")]
    return sent.groupBy("domain", chunk_of(F.col("number")).alias("chunk"), "text").agg(*aggregates)


def violations_by_bits(
    tables: Mapping[str, DataFrame], constraints: Mapping[str, Rules] = CONSTRAINTS
) -> DataFrame:
    """One row per constraint of the given tables: rows checked and rows that break it, as ``constraint_violations``
    counts them. The work is done when this is called.

    Every table is read twice: once for counts, which need no shuffle to speak of, and once for its keys. Integral keys
    and dates become bits in the task: 256 keys that follow each other are one row in the only shuffle of keys, where the
    bits of references meet those of the key. There, keys are counted against rows, and references without a key found
    by and-not. Text keys go as text. A value held by very many rows is one row, too. Only if a chunk holds both
    references with a key and others without are the rows of that column counted again, against such chunks alone. The
    driver receives a row per table and domain.
    """
    plan = _Plan(tables, constraints)
    spark = next(iter(tables.values())).sparkSession
    counted = [
        tables[name].agg(*[c.alias(n) for n, c in own.items()]).select(F.lit(name).alias("table"), F.to_json(F.struct("*")).alias("own"))
        for name, own in plan.counted.items()
    ]
    found = {row["table"]: json.loads(row["own"]) for row in reduce(DataFrame.unionByName, counted).collect()}
    chunks = _chunks(_sent(tables, plan.sent), range(plan.slots))
    own = [F.col(f"s0_{b}") for b in BITS]
    sums = [
        F.sum("n_0").alias("values"),
        F.sum(F.when(F.col("text").isNull(), count_bits(own)).otherwise(F.when(F.col("n_0") > 0, 1))).alias("distinct"),
    ]
    for k in range(1, plan.slots):
        lost, kept = _lost(k)
        sums += [
            F.sum(f"n_{k}").alias(f"used_{k}"),
            F.sum(F.when(lost & ~kept, F.col(f"n_{k}")).otherwise(0)).alias(f"lost_{k}"),
            F.count_if(lost & kept).alias(f"mixed_{k}"),
        ]
    domains = {row["domain"]: row.asDict() for row in chunks.groupBy("domain").agg(*sums).collect()}
    results = []
    for check in plan.checks:
        rows, own_domain = found[check.table]["rows"], domains.get(check.domain, {})
        values, distinct = own_domain.get("values") or 0, own_domain.get("distinct") or 0
        if check.rule == "primary_key":
            checked, broken = rows, rows - distinct
        elif check.rule == "unique":
            checked, broken = values, values - distinct
        elif check.rule == "foreign_key":
            checked, broken = (own_domain.get(f"{n}_{check.slot}") or 0 for n in ("used", "lost"))
            if own_domain.get(f"mixed_{check.slot}"):
                broken += _lost_in_mixed(plan, tables, check)
        else:
            checked, broken = rows, found[check.table][f"{check.rule} {check.column}"]
        results.append((check.table, check.column, check.rule, checked, broken))
    return spark.createDataFrame(results, RESULT).coalesce(1)


def _lost(slot: int) -> tuple[Column, Column]:
    """Whether a chunk has references without a key, and whether it has some with one."""
    pairs = [(F.col(f"s{slot}_{b}"), F.col(f"s0_{b}")) for b in BITS]
    lost = reduce(Column.__or__, [used.bitwiseAND(F.bitwise_not(own)) != 0 for used, own in pairs])
    kept = reduce(Column.__or__, [used.bitwiseAND(own) != 0 for used, own in pairs])
    is_text, used = F.col("text").isNotNull(), F.col(f"n_{slot}") > 0
    return F.when(is_text, used & (F.col("n_0") == 0)).otherwise(lost), F.when(is_text, False).otherwise(kept)


def _lost_in_mixed(plan: _Plan, tables: Mapping[str, DataFrame], check: _Check) -> int:
    """Rows whose reference has no key, in chunks of keys that have both such references and others."""
    sides = [c for c in plan.checks if c.domain == check.domain and c.slot in (0, check.slot)]
    keys: dict[str, list[Column]] = {}
    for side in sides:
        keys.setdefault(side.table, []).append(plan.key_row(side))
    sent = _sent(tables, keys)
    lost, kept = _lost(check.slot)
    missing = [F.col(f"s{check.slot}_{b}").bitwiseAND(F.bitwise_not(F.col(f"s0_{b}"))).alias(b) for b in BITS]
    mixed = _chunks(sent, (0, check.slot)).where(lost & kept).select("chunk", *missing)
    return sent.where(F.col("slot") == check.slot).join(unfolded(mixed, "number"), "number").count()
