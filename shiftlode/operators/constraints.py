"""Declared constraints at load: what breaks one is kept apart with its reason."""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftlode.operators.quality import duplicate_flags, missing_condition


@dataclass(frozen=True)
class Constraints:
    """``references`` names the column and the table whose rows it has to exist in."""

    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    references: dict[str, DataFrame] = field(default_factory=dict)

    def reasons(self) -> list[str]:
        names = ["unreadable", *[f"null_{name}" for name in self.not_null], *[f"orphan_{name}" for name in self.references]]
        return [*names, f"duplicate_{'_'.join(self.unique)}"] if self.unique else names


def with_reason(df: DataFrame, rules: Constraints) -> DataFrame:
    """``_reason``: the first constraint that a row breaks, NULL for good rows.

    ``_reject``, if there, holds the text of a record that could not be read. Parents are
    marked by a left join: broadcast if small, else with hot keys split. Of rows with equal unique
    columns the first in the order of all columns is good.
    """
    columns = [name for name in df.columns if name != "_reject"]
    checked, tests = df, []
    if "_reject" in df.columns:
        tests.append((F.col("_reject").isNotNull(), "unreadable"))
    tests += [(F.expr(missing_condition(df, name)), f"null_{name}") for name in rules.not_null]
    for number, (name, parent) in enumerate(rules.references.items()):
        known = parent.select(F.col(name).alias(f"_parent_{number}")).distinct()
        checked = checked.join(known, checked[name] == known[f"_parent_{number}"], "left")
        tests.append((F.col(name).isNotNull() & F.col(f"_parent_{number}").isNull(), f"orphan_{name}"))
    checked = checked.withColumn("_reason", first_of(tests))
    kept = [*df.columns, "_reason"]
    if not rules.unique:
        return checked.select(*kept)
    order = ["_reason", *[name for name in columns if name not in rules.unique]]
    marked = duplicate_flags(checked.select(*kept), list(rules.unique), order)
    again = F.when(F.col("is_duplicate"), F.lit(f"duplicate_{'_'.join(rules.unique)}"))
    return marked.withColumn("_reason", F.coalesce("_reason", again)).select(*kept)


def first_of(tests: list[tuple[Column, str]]) -> Column:
    return F.coalesce(*[F.when(test, F.lit(reason)) for test, reason in tests], F.lit(None).cast("string"))


def good_rows(marked: DataFrame) -> DataFrame:
    return marked.where("_reason IS NULL").drop("_reason", "_reject")


def rejected_rows(marked: DataFrame, table: str) -> DataFrame:
    """table_name, reason and the record as text."""
    columns = [name for name in marked.columns if name not in ("_reason", "_reject")]
    record = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    if "_reject" in marked.columns:
        record = F.coalesce("_reject", record)
    return marked.where("_reason IS NOT NULL").select(
        F.lit(table).alias("table_name"), F.col("_reason").alias("reason"), record.alias("record")
    )


def reason_counts(rules: Constraints) -> list[Column]:
    """One count per possible reason, as aggregates over marked rows."""
    return [F.count_if(F.col("_reason").eqNullSafe(reason)).alias(reason) for reason in rules.reasons()]
