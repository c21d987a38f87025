"""Table contracts as rules that each yield a number of violations."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class ContractViolation(AssertionError):
    """Raised under the fail-fast policy; the message lists the broken rules, ``counts`` all rules that were observed."""

    def __init__(self, message: str, counts: Mapping[str, int] | None = None):
        super().__init__(message)
        self.counts = dict(counts or {})


@dataclass(frozen=True)
class RowRule:
    """Rows that satisfy ``bad`` violate the rule; NULL is not a violation."""

    name: str
    bad: Column


@dataclass(frozen=True)
class NotEmptyRule:
    name: str = "dq_not_empty"


@dataclass(frozen=True)
class UniqueRule:
    """Rows beyond the first of each key."""

    name: str
    keys: tuple[str, ...]


@dataclass(frozen=True)
class GroupRule:
    """Groups whose row count ``n`` satisfies the SQL condition ``bad``."""

    name: str
    keys: tuple[str, ...]
    bad: str


@dataclass(frozen=True)
class FrameDensityRule:
    """Groups whose index does not run 1 … n."""

    name: str
    keys: tuple[str, ...]
    index: str


@dataclass(frozen=True)
class DistinctPerGroupRule:
    """Groups whose number of distinct values ``n`` satisfies the SQL condition ``bad``."""

    name: str
    keys: tuple[str, ...]
    value: str
    bad: str


@dataclass(frozen=True)
class ForeignKeyRule:
    """Distinct keys without a parent row."""

    name: str
    keys: tuple[str, ...]
    parent: DataFrame


@dataclass(frozen=True)
class ConflictRule:
    """Rows that contradict a joined row of another table."""

    name: str
    keys: tuple[str, ...]
    other: DataFrame
    bad: Column


Rule = (
    RowRule | NotEmptyRule | UniqueRule | GroupRule | FrameDensityRule
    | DistinctPerGroupRule | ForeignKeyRule | ConflictRule
)


def pk_not_null(keys: Sequence[str], name: str = "dq_pk_not_null") -> RowRule:
    return RowRule(name, reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys]))


def outside(column: str, low, high) -> Column:
    return (F.col(column) < F.lit(low)) | (F.col(column) > F.lit(high))


def not_in(column: str, values: Sequence) -> Column:
    """Negated membership; NULL counts as neither in nor out."""
    return ~F.col(column).isin(*values)


def _unpivot(df: DataFrame, counts: Sequence[tuple[str, Column]]) -> DataFrame:
    """One row (rule, violations) per aggregate; those over no rows at all are 0."""
    wide = df.agg(*[F.coalesce(count, F.lit(0)).alias(f"r{i}") for i, (_, count) in enumerate(counts)])
    entries = [
        F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").cast("bigint").alias("violations"))
        for i, (name, _) in enumerate(counts)
    ]
    return wide.select(F.inline(F.array(*entries)))


KeyRule = UniqueRule | GroupRule | FrameDensityRule | DistinctPerGroupRule | ForeignKeyRule


def _levels(rules: Sequence[KeyRule]) -> list[list[tuple[str, ...]]]:
    """The key sets the rules look at, as chains in which each is part of the one before it."""
    wanted = {tuple(rule.keys) for rule in rules}
    wanted |= {(*rule.keys, rule.value) for rule in rules if isinstance(rule, DistinctPerGroupRule)}
    chains: list[list[tuple[str, ...]]] = []
    for keys in sorted(wanted, key=lambda k: (-len(k), k)):
        if any(set(keys) == set(level) for chain in chains for level in chain):
            continue
        for chain in chains:
            if set(keys) < set(chain[-1]):
                chain.append(keys)
                break
        else:
            chains.append([keys])
    return chains


def _roll_up(df: DataFrame, chain: Sequence[tuple[str, ...]], rules: Sequence[KeyRule]) -> DataFrame:
    """All rules on the key sets of a chain, from one scan of the keys.

    The rows are counted by the finest key set. Each coarser one is an aggregate of the groups before it, and sums what those
    violated; so does the last step, which has one row.
    """
    indexes = sorted({rule.index for rule in rules if isinstance(rule, FrameDensityRule)})

    def distinct(keys: tuple[str, ...], finer: tuple[str, ...] = ()) -> list[Column]:
        asked = {r.value for r in rules if isinstance(r, DistinctPerGroupRule) and set(r.keys) == set(keys)}
        return [
            (F.count(v) if set(finer) == {*keys, v} else F.count_distinct(v)).alias(f"_values_{v}") for v in sorted(asked)
        ]

    grouped = df.groupBy(*chain[0]).agg(
        F.count("*").alias("_n"), *distinct(chain[0]),
        *[f(i).alias(f"_{f.__name__}_{i}") for i in indexes for f in (F.min, F.max)],
    )
    done: list[str] = []
    for depth, keys in enumerate(chain):
        if depth:
            grouped = grouped.groupBy(*keys).agg(
                F.sum("_n").alias("_n"), *distinct(keys, chain[depth - 1]),
                *[f(f"_{f.__name__}_{i}").alias(f"_{f.__name__}_{i}") for i in indexes for f in (F.min, F.max)],
                *[F.sum(f"_{name}").alias(f"_{name}") for name in done],
            )
        for rule in rules:
            if set(rule.keys) != set(keys):
                continue
            grouped = grouped.withColumn(f"_{rule.name}", _group_violations(rule))
            if isinstance(rule, ForeignKeyRule):
                parent = rule.parent.select(*rule.keys).distinct().withColumn("_parent", F.lit(True))
                grouped = grouped.join(parent, list(rule.keys), "left").withColumn(
                    f"_{rule.name}", F.col("_parent").isNull().cast("bigint")
                ).drop("_parent")
            done.append(rule.name)
    return _unpivot(grouped, [(name, F.sum(f"_{name}")) for name in done])


def _group_violations(rule: KeyRule) -> Column:
    """Violations of one group, from its number of rows ``_n`` and what was gathered besides."""
    if isinstance(rule, UniqueRule):
        return F.col("_n") - 1
    if isinstance(rule, GroupRule):
        bad = F.expr(re.sub(r"\bn\b", "_n", rule.bad))
    elif isinstance(rule, DistinctPerGroupRule):
        bad = F.expr(re.sub(r"\bn\b", f"_values_{rule.value}", rule.bad))
    elif isinstance(rule, FrameDensityRule):
        bad = (F.col(f"_min_{rule.index}") != 1) | (F.col(f"_max_{rule.index}") != F.col("_n"))
    else:
        bad = F.lit(False)
    return F.when(bad, 1).otherwise(0).cast("bigint")


def _conflicting(df: DataFrame, rules: Sequence[ConflictRule]) -> DataFrame:
    """All conflicts with one other table over the same keys, from one join."""
    joined = df.join(rules[0].other, list(rules[0].keys))
    return _unpivot(joined, [(rule.name, F.count_if(rule.bad)) for rule in rules])


def check(table: str, df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Report ``(table_name, rule, violations)``.

    All row-level rules of the table share one scan. Rules on keys share one more, from which each set of keys is rolled up
    (see ``_roll_up``), and one for each further set that is no part of the first. Conflicts with another table share one join.
    """
    fused: list[tuple[str, Column]] = []
    keyed: list[KeyRule] = []
    conflicting: dict[tuple, list[ConflictRule]] = {}
    for rule in rules:
        if isinstance(rule, RowRule):
            fused.append((rule.name, F.count_if(rule.bad)))
        elif isinstance(rule, NotEmptyRule):
            fused.append((rule.name, F.when(F.count("*") == 0, 1).otherwise(0)))
        elif isinstance(rule, ConflictRule):
            conflicting.setdefault((rule.keys, id(rule.other)), []).append(rule)
        elif isinstance(rule, KeyRule):
            keyed.append(rule)
        else:
            raise TypeError(f"unknown rule {rule!r}")
    parts = [_unpivot(df, fused)] if fused else []
    for chain in _levels(keyed):
        own = [rule for rule in keyed if any(set(rule.keys) == set(level) for level in chain)]
        parts.append(_roll_up(df, chain, own))
    parts += [_conflicting(df, same) for same in conflicting.values()]
    return reduce(DataFrame.unionByName, parts).select(F.lit(table).alias("table_name"), "rule", "violations")


def observe_counts(df: DataFrame, counters: Mapping[str, Column]) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """Count the rows that satisfy each condition while ``df`` is written, without a scan of its own.

    Returns the DataFrame to write in place of ``df``, and a function that gives the counts once it is written.
    """
    if not counters:
        return df, dict
    observation = Observation()
    counts = [F.count_if(condition).alias(f"c{i}") for i, condition in enumerate(counters.values())]

    def read() -> dict[str, int]:
        found = observation.get
        return {name: int(found[f"c{i}"]) for i, name in enumerate(counters)}

    return df.observe(observation, *counts), read


def observed(df: DataFrame, rules: Sequence[RowRule]) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """Count the violations of row-level rules while ``df`` is written (see ``observe_counts``)."""
    return observe_counts(df, {rule.name: rule.bad for rule in rules})


def settle_counts(table: str, counts: Callable[[], dict[str, int]], on_violation: str = "raise") -> dict[str, int]:
    """The observed violations; under ``raise`` any of them stops the run."""
    _known(on_violation)
    found = counts()
    broken = [f"{table}.{rule}: {n}" for rule, n in sorted(found.items()) if n]
    if on_violation == "raise" and broken:
        raise ContractViolation("; ".join(broken), found)
    return found


def _known(on_violation: str) -> None:
    if on_violation not in ("raise", "report"):
        raise ValueError("on_violation must be 'raise' or 'report'")


def combine(reports: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def settle(
    report: DataFrame,
    on_violation: str = "report",
    tolerated: Sequence[str] = (),
    log: Callable[[str], None] | None = None,
) -> DataFrame:
    """Apply the policy: ``raise`` fails on the first report with violations, ``report`` goes on.

    The report has one row per rule, so looking at it costs the driver little.
    """
    _known(on_violation)
    if on_violation == "report" and log is None:
        return report
    broken = [
        f"{r.table_name}.{r.rule}: {r.violations}"
        for r in report.filter(F.col("violations") > 0).collect()
    ]
    for line in broken:
        if log:
            log(line)
    fatal = [line for line in broken if line.split(".")[1].split(":")[0] not in tolerated]
    if on_violation == "raise" and fatal:
        raise ContractViolation("; ".join(sorted(fatal)))
    return report
