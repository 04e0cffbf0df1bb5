"""Data-quality building blocks. A check returns violations; no rows means it holds."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlane.functions import mismatch
from marketlane.settings import Settings

# --- Generic rules: one function per kind, returning the violating rows ------


def not_null(frame: DataFrame, column: str) -> DataFrame:
    return frame.filter(F.col(column).isNull())


def unique(frame: DataFrame, columns: Sequence[str], where: str | None = None) -> DataFrame:
    """Keys that occur more than once.

    A single column ignores NULLs. The count is reduced on the map side, so a
    heavily repeated key does not concentrate rows in one task.
    """
    if where:
        frame = frame.filter(where)
    if len(columns) == 1:
        frame = frame.filter(F.col(columns[0]).isNotNull())
    return frame.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def relationship(child: DataFrame, column: str, parent: DataFrame, field_: str) -> DataFrame:
    """Child rows whose value the parent lacks; NULL passes.

    Values are counted first, so a value shared by many rows joins as one row.
    """
    values = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return values.join(parent.select(F.col(field_).alias("value")), "value", "left_anti")


def outside_values(column: str, allowed: Iterable) -> Column:
    return ~F.col(column).isin(list(allowed))


def outside_range(
    column: str, low: float | None = None, high: float | None = None, inclusive: bool = True
) -> Column:
    value, bad = F.col(column), F.lit(False)
    if low is not None:
        bad = bad | (value < low if inclusive else value <= low)
    if high is not None:
        bad = bad | (value > high if inclusive else value >= high)
    return bad


def accepted_values(frame: DataFrame, column: str, allowed: Iterable) -> DataFrame:
    return frame.filter(outside_values(column, allowed))


def accepted_range(
    frame: DataFrame,
    column: str,
    low: float | None = None,
    high: float | None = None,
    inclusive: bool = True,
) -> DataFrame:
    return frame.filter(outside_range(column, low, high, inclusive))


# --- Declared rules of a relation -------------------------------------------


@dataclass(frozen=True)
class Range:
    columns: str
    low: float | None = 0
    high: float | None = None
    inclusive: bool = True


@dataclass(frozen=True)
class Rules:
    """What a relation promises. Key columns are required without saying so."""

    key: tuple[str, ...] = ()
    key_where: str | None = None
    required: str = ""
    more_keys: tuple[tuple[str, ...], ...] = ()
    references: tuple[tuple[str, str, str], ...] = ()
    allowed: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    ranges: tuple[Range, ...] = ()

    @property
    def required_columns(self) -> list[str]:
        return list(dict.fromkeys([*self.key, *self.required.split()]))


def has_rules(rules: Rules, kind: str) -> bool:
    """Whether a relation has a rule of a kind, as ``rule_counts`` counts them."""
    keys = [key for key in (rules.key, *rules.more_keys) if key]
    single = [len(key) == 1 and not rules.key_where for key in keys]
    return {
        "not_null": bool(rules.required_columns),
        "unique": any(single),
        "unique_combination": not all(single),
        "relationships": bool(rules.references),
        "accepted_values": bool(rules.allowed),
        "accepted_range": any(r.columns.split() for r in rules.ranges),
    }[kind]


ROW_RULES = ("not_null", "accepted_values", "accepted_range")
COUNTS = "relation string, rule string, columns string, violations bigint"


def row_tests(rules: Rules, kinds: Iterable[str] = ROW_RULES) -> list[tuple[str, str, Column]]:
    """Row-level rules of a relation: kind, column, and what is true of a violating row."""
    tests: list[tuple[str, str, Column]] = []
    if "not_null" in kinds:
        tests += [("not_null", c, F.col(c).isNull()) for c in rules.required_columns]
    if "accepted_values" in kinds:
        tests += [("accepted_values", c, outside_values(c, v)) for c, v in rules.allowed.items()]
    if "accepted_range" in kinds:
        tests += [
            ("accepted_range", c, outside_range(c, r.low, r.high, r.inclusive))
            for r in rules.ranges
            for c in r.columns.split()
        ]
    return tests


def row_measures(rules: Rules, kinds: Iterable[str] = ROW_RULES) -> dict[str, Column]:
    """The row-level rules as aggregates, to be counted while the relation is written; a rule
    has the same name whatever other kinds are counted."""
    return {
        f"t{n}": F.count_if(test) for n, (kind, _, test) in enumerate(row_tests(rules)) if kind in kinds
    }


def measured_counts(
    spark: SparkSession, relation: str, rules: Rules, measured: Mapping[str, int], kinds: Iterable[str]
) -> DataFrame:
    """What ``row_rule_counts`` gives, from counts taken when the relation was written."""
    rows = [
        (relation, kind, column, int(measured[f"t{n}"]))
        for n, (kind, column, _) in enumerate(row_tests(rules))
        if kind in kinds
    ]
    return spark.createDataFrame(rows, COUNTS)


def row_rule_counts(frame: DataFrame, relation: str, rules: Rules, kinds: set[str]) -> DataFrame | None:
    """All row-level rules of a relation in a single pass over it."""
    tests = row_tests(rules, kinds)
    if not tests:
        return None
    counts = frame.agg(*[F.count_if(test).alias(f"t{n}") for n, (_, _, test) in enumerate(tests)])
    rows = F.array(
        *[
            F.struct(
                F.lit(relation).alias("relation"),
                F.lit(kind).alias("rule"),
                F.lit(column).alias("columns"),
                F.col(f"t{n}").alias("violations"),
            )
            for n, (kind, column, _) in enumerate(tests)
        ]
    )
    return counts.select(F.inline(rows))


def _counted(rows: DataFrame, relation: str, rule: str, columns: str, value: Column) -> DataFrame:
    return rows.agg(value.cast("bigint").alias("violations")).select(
        F.lit(relation).alias("relation"),
        F.lit(rule).alias("rule"),
        F.lit(columns).alias("columns"),
        "violations",
    )


def rule_counts(
    tables: Mapping[str, DataFrame],
    rules: Mapping[str, Rules],
    kinds: set[str] | None = None,
    measured: Mapping[str, Mapping[str, int]] | None = None,
) -> DataFrame:
    """Violations of each declared rule: (relation, rule, columns, violations).

    Row-level rules of a relation in ``measured`` were counted when it was written, see
    ``row_measures``; those of others take one scan of the relation. Keys and references
    are always looked up in the relations.
    """
    measured = measured or {}
    kinds = kinds or {
        "not_null",
        "unique",
        "unique_combination",
        "relationships",
        "accepted_values",
        "accepted_range",
    }
    found = []
    for relation, declared in rules.items():
        row_kinds = kinds & {kind for kind, _, _ in row_tests(declared)}
        if row_kinds and relation in measured:
            spark = SparkSession.active()
            found.append(measured_counts(spark, relation, declared, measured[relation], row_kinds))
        elif row_kinds:
            found.append(row_rule_counts(tables[relation], relation, declared, row_kinds))
        for key in (declared.key, *declared.more_keys):
            rule = "unique" if len(key) == 1 and not declared.key_where else "unique_combination"
            if key and rule in kinds:
                where = declared.key_where if key == declared.key else None
                bad = unique(tables[relation], key, where)
                found.append(_counted(bad, relation, rule, ",".join(key), F.count(F.lit(1))))
        if "relationships" in kinds:
            for column, parent, target in declared.references:
                bad = relationship(tables[relation], column, tables[parent], target)
                rows = F.coalesce(F.sum("rows"), F.lit(0))
                found.append(_counted(bad, relation, "relationships", column, rows))
    return reduce(DataFrame.unionByName, found)


# --- Reconciliation ----------------------------------------------------------


def reconcile(
    expected: DataFrame,
    actual: DataFrame,
    keys: Sequence[str],
    settings: Settings,
    exact: Sequence[str] = (),
    nullable_exact: Sequence[str] = (),
    amounts: Sequence[str] = (),
    nullable_amounts: Sequence[str] = (),
    rates: Sequence[str] = (),
    nullable_rates: Sequence[str] = (),
    show: Sequence[str] = (),
    null_safe_keys: bool = True,
    sql_null_logic: bool = False,
) -> DataFrame:
    """Rows on which a recomputation and the published relation disagree.

    Keys missing on a side count. NULL keys match each other by default; plain
    equality would report them on both sides although nothing differs.
    """
    used = list(
        dict.fromkeys(
            [*exact, *nullable_exact, *amounts, *nullable_amounts, *rates, *nullable_rates, *show]
        )
    )

    def side(frame: DataFrame, name: str) -> DataFrame:
        values = F.struct(F.lit(True).alias("present"), *[F.col(c) for c in used])
        return frame.select(*[F.col(k).alias(f"{name}_{k}") for k in keys], values.alias(name))

    def same_key(key: str) -> Column:
        left, right = F.col(f"expected_{key}"), F.col(f"actual_{key}")
        return left.eqNullSafe(right) if null_safe_keys else left == right

    joined = side(expected, "expected").join(
        side(actual, "actual"), reduce(Column.__and__, map(same_key, keys)), "full_outer"
    )

    def pair(column: str) -> tuple[Column, Column]:
        return F.col(f"expected.{column}"), F.col(f"actual.{column}")

    wrong = F.col("expected").isNull() | F.col("actual").isNull()
    for column in exact:
        wrong = wrong | mismatch.exact(*pair(column))
    for column in nullable_exact:
        wrong = wrong | mismatch.nullable_exact(*pair(column), sql_null_logic)
    for columns, tolerance in (
        (amounts, settings.amount_tolerance),
        (rates, settings.rate_tolerance),
    ):
        for column in columns:
            wrong = wrong | mismatch.within(*pair(column), tolerance)
    for columns, tolerance in (
        (nullable_amounts, settings.amount_tolerance),
        (nullable_rates, settings.rate_tolerance),
    ):
        for column in columns:
            wrong = wrong | mismatch.nullable_within(*pair(column), tolerance, sql_null_logic)
    return joined.filter(wrong).select(
        *[F.coalesce(f"expected_{k}", f"actual_{k}").alias(k) for k in keys],
        *[F.col(f"{s}.{c}").alias(f"{s}_{c}") for c in show for s in ("expected", "actual")],
    )


# --- Freshness ---------------------------------------------------------------


def source_freshness(
    raw: Mapping[str, DataFrame], settings: Settings, static: bool = False
) -> DataFrame:
    """Age of the newest ingested row per source, against its limits.

    A static data set does not age: nothing is reported for it.
    """
    rows = []
    for name, limit in settings.freshness.items():
        newest = F.max(F.col("ingested_at_utc").cast("timestamp"))
        rows.append(
            raw[name]
            .agg(newest.alias("newest_at_utc"))
            .select(
                F.lit(name).alias("source_name"),
                "newest_at_utc",
                F.lit(limit.warn_hours).cast("bigint").alias("warn_hours"),
                F.lit(limit.error_hours).cast("bigint").alias("error_hours"),
            )
        )
    age = (
        F.unix_timestamp(settings.now_column()) - F.unix_timestamp("newest_at_utc")
    ).cast("double") / 3600
    status = (
        F.when(F.col("age_hours").isNull() | (F.col("age_hours") > F.col("error_hours")), "error")
        .when(F.col("age_hours") > F.col("warn_hours"), "warn")
        .otherwise("pass")
    )
    measured = reduce(DataFrame.unionByName, rows)
    if static:
        measured = measured.limit(0)
    return measured.withColumn("age_hours", age).withColumn("status", status)
