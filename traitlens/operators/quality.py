"""Data-quality rules that keep their failing rows (DQ-1..11).

Row rules (not_null, accepted_values, accepted_range, expression_is_true)
are Column predicates: all row rules of one table are counted in ONE scan
(``summarize``), and failing rows are produced only for the rule asked.
Key rules shuffle: ``unique`` is a partial+final count per key;
``relationships`` first reduces the child to (key, rows) with a partial
aggregate, so a hot key ships one row per task, then anti-joins the parent
keys. NULL passes every rule except not_null, as in the source model.
"""

from __future__ import annotations

import datetime as _dt
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from traitlens.operators.joins import anti_join

ROW_KINDS = ("not_null", "accepted_values", "accepted_range", "expression_is_true")


class QualityError(RuntimeError):
    """Raised when a rule of severity 'error' has failures."""


@dataclass(frozen=True)
class Rule:
    table: str
    kind: str
    column: str | None = None
    values: tuple = ()
    low: float | None = None
    high: float | None = None
    expression: str | None = None
    parent: str | None = None
    parent_column: str | None = None
    severity: str = "error"

    @property
    def name(self) -> str:
        return f"{self.kind}__{self.table}__{self.column}"

    @property
    def columns(self) -> tuple[str, ...]:
        """Names the rule reads: its column, or every word of its expression."""
        if self.kind == "expression_is_true":
            return tuple(dict.fromkeys(re.findall(r"[A-Za-z_]\w*", self.expression)))
        return (self.column,)

    def violation(self) -> Column:
        """True for a failing row (row rules only). Never NULL."""
        c = F.col(self.column) if self.column else None
        if self.kind == "not_null":
            bad = c.isNull()
        elif self.kind == "accepted_values":
            bad = c.isNotNull() & ~c.isin(*self.values)
        elif self.kind == "accepted_range":
            bad = c.isNotNull() & ~c.between(F.lit(self.low), F.lit(self.high))
        elif self.kind == "expression_is_true":
            bad = ~F.expr(self.expression)
        else:
            raise ValueError(f"{self.kind} is not a row rule")
        return F.coalesce(bad, F.lit(False))


# --------------------------------------------------------------- rule constructors
def not_null(table: str, column: str, severity: str = "error") -> Rule:
    return Rule(table, "not_null", column, severity=severity)


def unique(table: str, column: str, severity: str = "error") -> Rule:
    return Rule(table, "unique", column, severity=severity)


def accepted_values(table: str, column: str, values, severity: str = "error") -> Rule:
    return Rule(table, "accepted_values", column, values=tuple(values), severity=severity)


def accepted_range(table: str, column: str, low: float, high: float, severity: str = "error") -> Rule:
    return Rule(table, "accepted_range", column, low=low, high=high, severity=severity)


def expression_is_true(table: str, label: str, expression: str, severity: str = "error") -> Rule:
    """``label`` names the rule (used as its column slot)."""
    return Rule(table, "expression_is_true", label, expression=expression, severity=severity)


def relationships(table: str, column: str, parent: str, parent_column: str,
                  severity: str = "error") -> Rule:
    return Rule(table, "relationships", column, parent=parent, parent_column=parent_column,
                severity=severity)


# --------------------------------------------------------------- evaluation
def failing_rows(df: DataFrame, rule: Rule, key: str) -> DataFrame:
    """Rows failing a row rule: (test_name, key, value as text)."""
    value = F.col(rule.column).cast("string") if rule.kind != "expression_is_true" else F.lit(None).cast("string")
    return (df.where(rule.violation())
            .select(F.lit(rule.name).alias("test_name"), F.col(key).cast("bigint").alias("row_key"),
                    value.alias("value")))


def failing_rows_all(df: DataFrame, rules: list[Rule], key: str) -> DataFrame:
    """Rows failing any of several row rules of one table, in ONE scan.

    Rows that fail no rule are dropped first; a failing row then carries the
    (test_name, value) of every rule it fails, which are exploded.
    """
    hits = []
    for r in rules:
        value = (F.col(r.column).cast("string") if r.kind != "expression_is_true"
                 else F.lit(None).cast("string"))
        hits.append(F.when(r.violation(), F.struct(F.lit(r.name).alias("test_name"), value.alias("value"))))
    failing = df.where(reduce(lambda a, b: a | b, [r.violation() for r in rules]))
    return (failing.select(F.col(key).cast("bigint").alias("row_key"),
                           F.explode(F.array_compact(F.array(*hits))).alias("f"))
            .select(F.col("f.test_name").alias("test_name"), "row_key", F.col("f.value").alias("value")))


def duplicate_keys(df: DataFrame, rule: Rule) -> DataFrame:
    """Keys occurring more than once (NULL keys ignored): (test_name, value, n_rows)."""
    c = F.col(rule.column)
    return (df.where(c.isNotNull()).groupBy(c.alias("value"))
            .agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)
            .select(F.lit(rule.name).alias("test_name"), F.col("value").cast("string").alias("value"), "n_rows"))


def duplicate_keys_all(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """``duplicate_keys`` for several unique rules, one aggregate per distinct key column.

    Keys keep their own type in the shuffle; only those that repeat become
    text. Rules of one frame on one column share its aggregate.
    """
    parts = []
    for column in dict.fromkeys(r.column for r in rules):
        names = [r.name for r in rules if r.column == column]
        parts.append(duplicate_keys(df, unique("", column)).select(
            F.explode(F.array(*map(F.lit, names))).alias("test_name"), "value", "n_rows"))
    return reduce(DataFrame.unionByName, parts)


def orphan_keys(child: DataFrame, parent: DataFrame, rule: Rule) -> DataFrame:
    """Non-NULL child keys absent from the parent: (test_name, child_key, n_rows)."""
    c = F.col(rule.column)
    keys = (child.where(c.isNotNull()).groupBy(c.alias("child_key"))
            .agg(F.count(F.lit(1)).alias("n_rows")))
    parents = parent.select(F.col(rule.parent_column).alias("child_key"))
    return (anti_join(keys, parents, "child_key")
            .select(F.lit(rule.name).alias("test_name"), F.col("child_key").cast("bigint"), "n_rows"))


def by_frame(tables: dict[str, DataFrame], rules: list[Rule]) -> list[tuple[DataFrame, list[Rule]]]:
    """Rules grouped by the DataFrame they run on (tables may share one frame)."""
    groups: dict[int, tuple[DataFrame, list[Rule]]] = {}
    for r in rules:
        df = tables[r.table]
        groups.setdefault(id(df), (df, []))[1].append(r)
    return list(groups.values())


def summarize(tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """Failure count per rule: (table_name, test_name, kind, severity, failures, status).

    Row rules over one DataFrame are counted in one aggregate (one scan, even
    when several table names map to that frame); unique rules over one frame
    share one (rule, key) aggregate; relationships add one anti-join each.
    """
    parts: list[DataFrame] = []

    def entries(counts: DataFrame, rs: list[Rule]) -> DataFrame:
        structs = [F.struct(F.lit(r.table).alias("table_name"), F.lit(r.name).alias("test_name"),
                            F.lit(r.kind).alias("kind"), F.lit(r.severity).alias("severity"),
                            F.coalesce(F.col(f"c{i}"), F.lit(0)).cast("bigint").alias("failures"))
                   for i, r in enumerate(rs)]
        return counts.select(F.inline(F.array(*structs)))

    for df, rs in by_frame(tables, rules):
        row_rules = [r for r in rs if r.kind in ROW_KINDS]
        if row_rules:
            counts = df.agg(*[F.count_if(r.violation()).alias(f"c{i}") for i, r in enumerate(row_rules)])
            parts.append(entries(counts, row_rules))
        uniques = [r for r in rs if r.kind == "unique"]
        if uniques:
            dups = duplicate_keys_all(df, uniques)
            counts = dups.agg(*[F.sum(F.when(F.col("test_name") == r.name, F.col("n_rows"))).alias(f"c{i}")
                                for i, r in enumerate(uniques)])
            parts.append(entries(counts, uniques))
        for r in rs:
            if r.kind != "relationships":
                continue
            failed = orphan_keys(df, tables[r.parent], r).agg(F.sum("n_rows").alias("c0"))
            parts.append(entries(failed, [r]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return with_status(out)


def with_status(counts: DataFrame) -> DataFrame:
    """``status`` of rules by their failures and severity (DQ-9)."""
    return counts.withColumn("status", F.when(F.col("failures") == 0, "pass")
                             .when(F.col("severity") == "error", "fail").otherwise("warn"))


def enforce(summary: DataFrame) -> DataFrame:
    """Raise ``QualityError`` if an error-severity rule failed (DQ-9).

    Collects only the failing summary rows (at most one per rule).
    """
    failed = summary.where(F.col("status") == "fail").select("test_name", "failures").collect()
    if failed:
        raise QualityError("; ".join(f"{r.test_name}: {r.failures}" for r in failed))
    return summary


_UNITS = {"day": 0, "hour": 1, "minute": 2}


def recency(df: DataFrame, column: str, now: _dt.datetime, interval: int, name: str,
            unit: str = "day") -> DataFrame:
    """Newest value of ``column`` within ``interval`` ``unit``s of ``now`` (DQ-7): one status row."""
    now_lit = F.lit(now).cast("timestamp_ntz")
    parts = [F.lit(0), F.lit(0), F.lit(0)]
    parts[_UNITS[unit]] = F.lit(interval)
    threshold = now_lit - F.make_dt_interval(*parts)
    newest = df.agg(F.max(F.col(column).cast("timestamp_ntz")).alias("newest"))
    return newest.select(F.lit(name).alias("test_name"), "newest", threshold.alias("threshold"),
                         F.coalesce(F.col("newest") >= threshold, F.lit(False)).alias("passed"))


def star_consistency(dim: DataFrame, others: dict[str, DataFrame], key: str, label: str) -> DataFrame:
    """Keys missing from, and records orphaned in, each other table (DQ-8, JN-4, SET-1).

    Output: (issue_type, <key>, <label>, issue_description), one row per
    orphaned record. Every table is read once: its (key, label) rows are
    counted under the table's bit, and a key's bits tell which tables have it.
    A null key is in no other table. Rows of a key that repeats travel as one
    counted row per label and become rows again only where they are reported.
    """
    frames = {None: dim, **others}
    kinds = {c: dict(dim.dtypes)[c] for c in (key, label)}
    tagged = reduce(DataFrame.unionByName, [
        df.select(F.col(key).cast(kinds[key]).alias("k"),
                  (F.col(label) if label in df.columns else F.lit(None)).cast(kinds[label]).alias("v"),
                  F.lit(1 << i).cast("long").alias("bit"))
        for i, df in enumerate(frames.values())])
    rows = tagged.groupBy("k", "v", "bit").agg(F.count(F.lit(1)).alias("n"))
    # null keys have nothing to meet, so they are dealt by label
    of_key = Window.partitionBy("k", F.when(F.col("k").isNull(), F.hash("v")))
    bits = F.when(F.col("k").isNull(), F.col("bit")).otherwise(F.bit_or("bit").over(of_key))
    issue = lambda name, text: F.struct(F.lit(name).alias("issue_type"), F.lit(text).alias("issue_description"))
    issues = []
    for i, name in enumerate(others, 1):
        issues += [F.when((F.col("bit") == 1) & (F.col("bits").bitwiseAND(1 << i) == 0), issue(name, "missing_breed")),
                   F.when((F.col("bit") == 1 << i) & (F.col("bits").bitwiseAND(1) == 0), issue(name, "orphaned_record"))]
    found = rows.withColumn("bits", bits).select("k", "v", "n", F.explode(F.array_compact(F.array(*issues))).alias("issue"))
    # n rows again, a thousand at a time
    found = found.select("k", "v", "issue", "n", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / 1000))).alias("block"))
    found = found.select("k", "v", "issue", F.explode(F.array_repeat(
        F.lit(0), F.least(F.lit(1000), F.col("n") - 1000 * F.col("block")).cast("int"))))
    return found.select("issue.issue_type", F.col("k").alias(key), F.col("v").alias(label), "issue.issue_description")


def row_counts(tables: dict[str, DataFrame], alias: str = "row_count") -> DataFrame:
    """One (table_name, count) row per table (DQ-11)."""
    out = None
    for name, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias(alias)).select(F.lit(name).alias("table_name"), alias)
        out = part if out is None else out.unionByName(part)
    return out


def store_failures(df: DataFrame, schema: str, name: str) -> str:
    """Write failing rows to ``<schema>_tests.<name>`` (DQ-10, SNK-5); returns the table name."""
    spark = df.sparkSession
    target = f"{schema}_tests"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{target}`")
    full = f"`{target}`.`{name}`"
    df.write.mode("overwrite").saveAsTable(full)
    return full
