"""Audit of the warehouse constraints: unique keys, value sets, required values, references."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import RUN_STATES, SERVICE_STATES
from ..session import scratch_scope


@dataclass(frozen=True)
class Unique:
    table: str
    columns: Sequence[str]
    where: str = "true"


@dataclass(frozen=True)
class OneOf:
    table: str
    column: str
    values: Sequence[str]


@dataclass(frozen=True)
class Required:
    table: str
    column: str


@dataclass(frozen=True)
class Reference:
    table: str
    column: str
    target: str
    target_column: str


Rule = Unique | OneOf | Required | Reference

WAREHOUSE_RULES: tuple[Rule, ...] = (
    Unique("files", ["checksum"]),
    Unique("provider", ["provider_norm"]),
    Unique("territory", ["province_norm", "canton_norm"]),
    Unique("program", ["program_norm", "field_norm", "level_norm", "modality_norm"]),
    Unique("offer", ["natural_key"], "is_current"),
    OneOf("files", "status", RUN_STATES),
    OneOf("health", "status", SERVICE_STATES),
    Required("files", "file_name"),
    Required("files", "checksum"),
    Required("health", "service_name"),
    Required("step", "step_name"),
    Reference("staging", "file_id", "files", "file_id"),
    Reference("offer", "provider_id", "provider", "provider_id"),
    Reference("offer", "territory_id", "territory", "territory_id"),
    Reference("offer", "program_id", "program", "program_id"),
    Reference("offer", "last_file_id", "files", "file_id"),
    Reference("run", "file_id", "files", "file_id"),
    Reference("issue", "run_id", "run", "run_id"),
    Reference("step", "file_id", "files", "file_id"),
)


#: Values that one task groups.
TASK_ENTRIES = 1 << 20


def _name(rule: Rule) -> str:
    if isinstance(rule, Unique):
        return f"unique({','.join(rule.columns)})"
    if isinstance(rule, OneOf):
        return f"domain({rule.column})"
    if isinstance(rule, Required):
        return f"not_null({rule.column})"
    return f"reference({rule.column}->{rule.target}.{rule.target_column})"


def _finding(number: int, rule: Rule, df: DataFrame) -> Column:
    """What a row of the rule's table says to it: a value to be counted, or NULL for nothing."""
    value = None
    if isinstance(rule, Unique):
        columns = [F.col(c) for c in rule.columns]
        # As in SQL, a key with a NULL part never collides.
        known = reduce(and_, [c.isNotNull() for c in columns])
        value = F.when(F.expr(rule.where) & known, F.to_json(F.struct(*columns)))
    elif isinstance(rule, OneOf):
        value = F.when(~F.col(rule.column).isin(list(rule.values)), F.lit(""))
    elif isinstance(rule, Required):
        value = F.when(F.col(rule.column).isNull(), F.lit(""))
    else:
        value = F.col(rule.column).cast("string")
    return _entry(number, value, False)


def _entry(number: int, value: Column, target: bool) -> Column:
    return F.when(
        value.isNotNull(),
        F.struct(
            F.lit(number).alias("rule"), value.alias("value"), F.lit(target).alias("target")
        ),
    )


def audit(tables: Mapping[str, DataFrame], rules: Sequence[Rule] = WAREHOUSE_RULES) -> DataFrame:
    """Violations per rule: colliding keys, or rows with a wrong, missing or orphaned value.

    Every table is scanned once, whatever the number of rules on it. A row gives one entry per
    rule that it has a say in, and one per rule that refers to it; entries are counted per rule
    and value on the map side, so a hot value is one row a task. Referring values meet the
    values they refer to in the same grouping. Values of references compare as text. The entries
    are dealt out to as many tasks as their number asks for: hash tables of single values take
    far more room than the compressed rows by which Spark would put partitions together.
    """
    checked = [r for r in rules if r.table in tables]
    used = list(dict.fromkeys([r.table for r in checked] + [
        r.target for r in checked if isinstance(r, Reference)
    ]))
    counted, most = [], 0
    for name in used:
        df = tables[name]
        entries = [_finding(i, r, df) for i, r in enumerate(checked) if r.table == name]
        # Several rules may refer to one column: its values are read once, and dealt out to all.
        wanted: dict[str, list[int]] = {}
        for i, rule in enumerate(checked):
            if isinstance(rule, Reference) and rule.target == name:
                wanted.setdefault(rule.target_column, []).append(i)
        for column, numbers in wanted.items():
            entries.append(_entry(-1 - numbers[0], F.col(column).cast("string"), True))
        most += len(entries) * df.count()
        found = df.select(F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("e"))
        values = found.groupBy("e.rule", "e.value", "e.target").agg(F.count("*").alias("n"))
        for column, numbers in wanted.items():
            if len(numbers) > 1:
                shared = F.array(*[F.lit(i) for i in numbers])
                one = F.array(F.col("rule"))
                dealt = F.when(F.col("rule") == -1 - numbers[0], shared).otherwise(one)
                values = values.withColumn("rule", F.explode(dealt))
            else:
                back = F.when(F.col("rule") == -1 - numbers[0], F.lit(numbers[0]))
                values = values.withColumn("rule", F.coalesce(back, "rule"))
        counted.append(values)
    together = reduce(DataFrame.unionByName, counted).groupBy("rule", "value").agg(
        F.coalesce(F.sum(F.when(~F.col("target"), F.col("n"))), F.lit(0)).alias("n"),
        F.max("target").alias("known"),
    )
    unique = [i for i, r in enumerate(checked) if isinstance(r, Unique)]
    wrong = (
        F.when(F.col("rule").isin(unique), (F.col("n") > 1).cast("bigint"))
        .when(~F.col("known"), F.col("n"))
        .otherwise(0)
    )
    sums = together.groupBy("rule").agg(F.sum(wrong).alias("found"))
    if most <= TASK_ENTRIES:
        named = df.sparkSession.createDataFrame(
            [(i, r.table, _name(r)) for i, r in enumerate(checked)],
            "rule int, table_name string, rule_name string",
        )
        return named.join(F.broadcast(sums), "rule", "left").select(
            "table_name", F.col("rule_name").alias("rule"),
            F.coalesce("found", F.lit(0)).alias("violations"),
        )
    with scratch_scope(df.sparkSession), _tasks_for(df.sparkSession, most):
        # One row per rule. A frame made in the scope, so that its shuffles go with it.
        violations = {r["rule"]: r["found"] for r in sums.select("rule", "found").collect()}
    return df.sparkSession.createDataFrame(
        [(r.table, _name(r), violations.get(i) or 0) for i, r in enumerate(checked)],
        "table_name string, rule string, violations bigint",
    )


@contextmanager
def _tasks_for(spark: SparkSession, entries: int):
    """Shuffles with no more than about ``TASK_ENTRIES`` of the entries in a task."""
    if entries <= TASK_ENTRIES:
        yield
        return
    parts = max(spark.sparkContext.defaultParallelism, -(-entries // TASK_ENTRIES))
    wanted = {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
