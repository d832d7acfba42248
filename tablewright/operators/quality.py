"""Declarative quality rules: five families, one fused aggregate, and quarantine of violating rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from decimal import Decimal

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nulls import as_list, col, is_orderable, legacy_type, nan_to_null, refuse_taken, require_frame
from ..functions.predicates import lenient, violates, why_invalid
from .profile import Facts, duplicates, percent, printed, rounded

FAMILIES = ("completeness", "uniqueness", "validity", "consistency", "accuracy")


@dataclass
class Rule:
    """One test. ``row`` is true on a violating row; ``passes`` judges (violations, rows)."""

    family: str
    name: str
    target: str
    row: Column | None = None
    count: Column | None = None
    passes: Callable[[Column, Column], Column] = field(default=lambda v, n: v == 0)
    error: str | None = None
    distinct: list[str] | None = None


def _over(limit: float) -> Callable[[Column, Column], Column]:
    return lambda v, n: ~F.coalesce(percent(v, n) > limit, F.lit(False))


def _over_exact(limit: float, cells: int = 1) -> Callable[[Column, Column], Column]:
    return lambda v, n: ~F.coalesce(F.try_divide(v * F.lit(100.0), n * cells) > limit, F.lit(False))


def build_rules(df: DataFrame, rules: dict | None, facts: Facts | None = None) -> list[Rule]:
    """Every test that ``rules`` asks of ``df``; conditions that do not resolve carry an error.

    Duplicates already counted in ``facts`` are not counted again.
    """
    rules = rules or {}
    built: list[Rule] = []
    for family in FAMILIES:
        options = rules.get(family) or {}
        if options.get("enabled", True):
            built += _BUILDERS[family](df, options)
    if facts is not None and facts.duplicates is not None:
        known = F.lit(facts.duplicates["duplicate_rows"]).cast("long")
        built = [replace(r, count=known, distinct=None) if r.name == "duplicate_rows" else r for r in built]
    return built


def _completeness(df: DataFrame, options: dict) -> list[Rule]:
    limit = options.get("max_null_percentage", 5.0)
    total = F.lit(0)
    for c in df.columns:
        total = total + F.count_if(col(c).isNull())
    built = [
        Rule("completeness", "overall_nulls", "*", count=total, passes=_over_exact(limit, max(len(df.columns), 1)))
    ]
    for c in options.get("required_columns") or []:
        if c in df.columns:
            built.append(Rule("completeness", "required", c, row=col(c).isNull(), passes=_over(0)))
    for c in df.columns:
        built.append(Rule("completeness", "column_nulls", c, count=F.count_if(col(c).isNull()), passes=_over(limit)))
    return built


def _uniqueness(df: DataFrame, options: dict) -> list[Rule]:
    limit = options.get("max_duplicate_percentage", 1.0)
    built = [Rule("uniqueness", "duplicate_rows", "*", distinct=df.columns, passes=_over_exact(limit))]
    for c in options.get("unique_columns") or []:
        if c in df.columns:
            built.append(Rule("uniqueness", "unique_column", c, distinct=[c]))
    return built


def _validity(df: DataFrame, options: dict) -> list[Rule]:
    built = []
    for c, rule in (options.get("column_rules") or {}).items():
        if c not in df.columns:
            continue
        data_type = df.schema[c].dataType
        if rule.get("type"):
            right = legacy_type(data_type).startswith(rule["type"])
            # A type error is about the column, it marks no row.
            built.append(
                Rule("validity", "type", c, count=F.lit(0).cast("long"), passes=lambda v, n, r=right: F.lit(r))
            )
        number = col(c).cast("double") if isinstance(data_type, T.NumericType) else col(c).try_cast("double")
        if isinstance(data_type, T.StringType):
            number = F.when(~F.isnan(number), number)
        if rule.get("min_value") is not None:
            built.append(Rule("validity", "min_value", c, row=F.coalesce(number < rule["min_value"], F.lit(False))))
        if rule.get("max_value") is not None:
            built.append(Rule("validity", "max_value", c, row=F.coalesce(number > rule["max_value"], F.lit(False))))
        if rule.get("allowed_values"):
            known = [v for v in rule["allowed_values"] if v is not None and _of_kind(v, data_type)]
            bad = ~F.coalesce(col(c).isin(known), F.lit(False))
            if None in rule["allowed_values"]:
                bad = bad & col(c).isNotNull()
            built.append(Rule("validity", "allowed_values", c, row=bad))
    return built


def _of_kind(value, data_type: T.DataType) -> bool:
    """Can a cell of this type equal the value? Numbers equal numbers only, text equals text only."""
    number = isinstance(value, (int, float, Decimal)) and not isinstance(value, bool)
    if isinstance(data_type, T.NumericType):
        return number
    if isinstance(data_type, T.BooleanType):
        return isinstance(value, bool)
    if isinstance(data_type, T.StringType):
        return isinstance(value, str)
    return not number and not isinstance(value, bool)


def _conditions(family: str, key: str, least_columns: int) -> Callable[[DataFrame, dict], list[Rule]]:
    def build(df: DataFrame, options: dict) -> list[Rule]:
        built = []
        for rule in options.get(key) or []:
            cond = rule.get("condition")
            if cond is None or cond == "" or len(as_list(rule.get("columns"))) < least_columns:
                continue
            name = rule.get("name", "Unnamed rule")
            error = why_invalid(df, cond)
            built.append(Rule(family, "condition", name, row=None if error else violates(cond), error=error))
        return built

    return build


_BUILDERS = {
    "completeness": _completeness,
    "uniqueness": _uniqueness,
    "validity": _validity,
    "consistency": _conditions("consistency", "cross_column_rules", 2),
    "accuracy": _conditions("accuracy", "business_rules", 0),
}


def quality_table(df: DataFrame, rules: dict | None = None, duplicate_method: str = "exact") -> DataFrame:
    """family, rule, target, violations, rows, percentage, passed, error: one row per test.

    All counting tests share one aggregate, all tests for unique columns share one distinct count, and
    duplicate rows take another.
    """
    require_frame(df, "quality_table")
    df = nan_to_null(df)
    return _evaluate(df, build_rules(df, rules), duplicate_method).drop("position")


def _evaluate(df: DataFrame, built: list[Rule], duplicate_method: str) -> DataFrame:
    counted = [(p, r) for p, r in enumerate(built) if r.distinct is None]
    parts = []
    if counted:
        counts = [
            (F.count_if(r.row) if r.row is not None else r.count if r.count is not None else F.lit(None).cast("long"))
            for _, r in counted
        ]
        with lenient(df.sparkSession):  # a condition without a result on a row is violated there
            wide = df.agg(F.count(F.lit(1)).alias("n"), *[c.alias(f"v{i}") for i, c in enumerate(counts)])
        rows = [_result(p, r, F.col(f"v{i}"), F.col("n")) for i, (p, r) in enumerate(counted)]
        parts.append(wide.select(F.inline(F.array(*rows))))
    single = [(p, r) for p, r in enumerate(built) if r.distinct is not None and _prints(df, r.distinct)]
    if single:
        parts.append(_unique_columns(df, single))
    for p, r in enumerate(built):
        if r.distinct is not None and not _prints(df, r.distinct):
            copies = duplicates(df, r.distinct, duplicate_method)
            parts.append(copies.select(F.inline(F.array(_result(p, r, F.col("duplicate_rows"), F.col("rows"))))))
    if not parts:
        raise ValueError("every rule family is disabled")
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table


def _prints(df: DataFrame, names: list[str]) -> bool:
    """One column whose values are equal where their text is."""
    kind = df.schema[names[0]].dataType if len(names) == 1 else None
    return isinstance(kind, T.AtomicType) and is_orderable(kind)


def _unique_columns(df: DataFrame, rules: list[tuple[int, Rule]]) -> DataFrame:
    """All tests for unique columns in one scan: cells are told apart by rule and combined before the shuffle."""
    cells = [
        F.struct(F.lit(i).alias("i"), printed(col(r.distinct[0]), df.schema[r.distinct[0]].dataType).cast("string").alias("cell"))
        for i, (_, r) in enumerate(rules)
    ]
    counted = df.select(F.inline(F.array(*cells))).groupBy("i", "cell").agg(F.count(F.lit(1)).alias("n"))
    totals = []
    for i in range(len(rules)):
        mine = F.col("i") == i
        totals += [F.coalesce(F.sum(F.when(mine, F.col("n"))), F.lit(0)).alias(f"n{i}"), F.count_if(mine).alias(f"u{i}")]
    rows = [_result(p, r, F.col(f"n{i}") - F.col(f"u{i}"), F.col(f"n{i}")) for i, (p, r) in enumerate(rules)]
    return counted.agg(*totals).select(F.inline(F.array(*rows)))


def _result(position: int, rule: Rule, violations: Column, rows: Column) -> Column:
    passed = F.lit(False) if rule.error else rule.passes(violations, rows)
    cells = rows if rule.name != "overall_nulls" else None
    share = percent(violations, cells) if cells is not None else F.lit(None).cast("double")
    return F.struct(
        F.lit(position).alias("position"),
        F.lit(rule.family).alias("family"),
        F.lit(rule.name).alias("rule"),
        F.lit(rule.target).alias("target"),
        violations.cast("long").alias("violations"),
        rows.cast("long").alias("rows"),
        share.alias("percentage"),
        passed.alias("passed"),
        F.lit(rule.error).cast("string").alias("error"),
    )


def check_quality(
    df: DataFrame, rules: dict | None = None, duplicate_method: str = "exact", facts: Facts | None = None
) -> dict:
    """Run all families and roll them up into scores and issues."""
    require_frame(df, "check_quality")
    rules = rules or {}
    df = nan_to_null(df)
    built = build_rules(df, rules, facts)
    try:
        results = _collect(df, built, duplicate_method)
    except PySparkException:
        # A condition failed on some row. Find which ones, so that only they become issues.
        built = [replace(r, **_runtime_error(df, r)) for r in built]
        results = _collect(df, built, duplicate_method)
    return roll_up(results, rules, len(df.columns))


def roll_up(results: list[dict], rules: dict, columns: int) -> dict:
    """Scores and issues of all families from the results of their rules, over a table of so many columns."""
    details, issues, failed = {}, [], []
    for family in FAMILIES:
        if not (rules.get(family) or {}).get("enabled", True):
            continue
        own = [r for r in results if r["family"] == family]
        bad = [r for r in own if not r["passed"]]
        texts = [_issue(r, rules) for r in bad]
        issues += texts
        failed += bad
        details[family] = {"passed": not bad, "issues": texts, **_score(family, own, columns)}
    passed = sum(d["passed"] for d in details.values())
    return {
        "overall_score": round(passed / len(details) * 100, 2) if details else 0.0,
        "checks_passed": passed,
        "checks_failed": len(details) - passed,
        "issues": issues,
        "failed_rules": failed,
        "detailed_results": details,
    }


def partial_counts(df: DataFrame, rules: dict | None = None) -> DataFrame:
    """What a part of a table adds to its results: ``position`` of the rule, ``cell``, ``n`` and ``rows``.

    Rules that count rows give one row each, without ``cell``; rules about distinct values one row for each digest of a
    value or row, with the number of its copies. Parts are put together by adding up, see ``results_of``.
    """
    df = nan_to_null(df)
    built = list(enumerate(build_rules(df, rules)))
    schema = "position int, cell string, n bigint, rows bigint"
    parts = [df.sparkSession.createDataFrame([], schema)]
    counted = [(p, r) for p, r in built if r.distinct is None]
    if counted:
        counts = [(F.count_if(r.row) if r.row is not None else r.count if r.count is not None else F.lit(None)).cast("long") for _, r in counted]
        with lenient(df.sparkSession):
            wide = df.agg(F.count(F.lit(1)).alias("rows"), *[c.alias(f"v{i}") for i, c in enumerate(counts)])
        rows = [F.struct(F.lit(p).alias("position"), F.lit(None).cast("string").alias("cell"), F.col(f"v{i}").alias("n"), F.col("rows")) for i, (p, _) in enumerate(counted)]
        parts.append(wide.select(F.inline(F.array(*rows))))
    cells = []
    for p, r in built:
        if r.distinct is not None:
            exact = [printed(col(c), df.schema[c].dataType).alias(f"c{i}") for i, c in enumerate(r.distinct)]
            text = F.to_json(F.struct(*exact), {"ignoreNullFields": "false"})
            cells.append(F.struct(F.lit(p).alias("position"), F.sha2(text, 256).alias("cell")))
    if cells:
        copies = df.select(F.inline(F.array(*cells))).groupBy("position", "cell").agg(F.count(F.lit(1)).alias("n"))
        parts.append(copies.withColumn("rows", F.lit(None).cast("bigint")))
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table


def results_of(parts: DataFrame, built: list[Rule]) -> list[dict]:
    """The results of the rules over all parts, as ``quality_table`` has them."""
    sums = parts.filter("cell IS NULL").groupBy("position").agg(F.sum("n").alias("v"), F.sum("rows").alias("n"))
    cells = parts.filter("cell IS NOT NULL").groupBy("position", "cell").agg(F.sum("n").alias("copies"))
    copies = cells.groupBy("position").agg((F.sum("copies") - F.count(F.lit(1))).alias("v"), F.sum("copies").alias("n"))
    found = {r["position"]: (r["v"], r["n"]) for r in sums.unionByName(copies).collect()}  # one row for each rule
    rows = []
    for p, rule in enumerate(built):
        v, n = found.get(p, (0, 0))
        rows.append(_result(p, rule, F.lit(v).cast("long"), F.lit(n or 0).cast("long")))
    if not rows:
        return []
    table = parts.sparkSession.range(1).select(F.inline(F.array(*rows)))
    return sorted((r.asDict() for r in table.collect()), key=lambda r: r.pop("position"))


def _collect(df: DataFrame, built: list[Rule], duplicate_method: str) -> list[dict]:
    if not built:
        return []
    rows = [r.asDict() for r in _evaluate(df, built, duplicate_method).collect()]
    return sorted(rows, key=lambda r: r.pop("position"))


def _runtime_error(df: DataFrame, rule: Rule) -> dict:
    if rule.name != "condition" or rule.error:
        return {}
    try:
        df.agg(F.count_if(rule.row)).first()
        return {}
    except PySparkException as error:
        return {"row": None, "error": str(error).split("\n")[0]}


def _score(family: str, results: list[dict], columns: int) -> dict:
    rows = max((r["rows"] for r in results), default=0)
    if family == "completeness":
        cells = rows * columns
        nulls = next((r["violations"] for r in results if r["rule"] == "overall_nulls"), 0)
        return {
            "score": max(0.0, 100 - nulls * 100.0 / cells) if cells else None,
            "null_percentages": {r["target"]: r["percentage"] for r in results if r["rule"] == "column_nulls"},
        }
    if family == "uniqueness":
        copies = next((r["violations"] for r in results if r["rule"] == "duplicate_rows"), 0)
        return {
            "score": max(0.0, 100 - copies * 100.0 / rows) if rows else None,
            "duplicate_count": copies,
            "duplicate_percentage": rounded(copies, rows),
        }
    if family == "validity":
        invalid = sum(r["violations"] for r in results)
        share = invalid * 100.0 / (rows * columns) if rows * columns else 0.0
        return {"score": max(0.0, 100 - share), "invalid_count": invalid, "invalid_percentage": round(share, 2)}
    return {"score": 100 if all(r["passed"] for r in results) else 50}


def _issue(result: dict, rules: dict) -> str:
    target, count, share = result["target"], result["violations"], result["percentage"]
    if result["error"]:
        return f"{result['family'].capitalize()} rule '{target}' could not be evaluated: {result['error']}"
    limits = rules.get(result["family"]) or {}
    column_rule = (limits.get("column_rules") or {}).get(target, {})
    return {
        "overall_nulls": f"Table holds {count} null cells, above {limits.get('max_null_percentage', 5.0)}% of all cells",
        "required": f"Required column '{target}' is null in {count} rows ({share}%)",
        "column_nulls": f"Column '{target}' is null in {share}% of rows, above {limits.get('max_null_percentage', 5.0)}%",
        "duplicate_rows": f"Table holds {count} duplicate rows ({share}%), above {limits.get('max_duplicate_percentage', 1.0)}%",
        "unique_column": f"Column '{target}' must be unique but holds {count} duplicate values ({share}%)",
        "type": f"Column '{target}' is not of type {column_rule.get('type')}",
        "min_value": f"Column '{target}' is below {column_rule.get('min_value')} in {count} rows",
        "max_value": f"Column '{target}' is above {column_rule.get('max_value')} in {count} rows",
        "allowed_values": f"Column '{target}' holds {count} values that are not allowed",
        "condition": f"{result['family'].capitalize()} rule '{target}' fails in {count} rows",
    }[result["rule"]]


def tag_violations(df: DataFrame, rules: dict | None = None, out: str = "violated_rules") -> DataFrame:
    """``df`` plus the names of the row rules each row violates; a projection, also on streams.

    ``out`` must not be a column of ``df``.
    """
    require_frame(df, "tag_violations")
    refuse_taken(df.columns, out)
    clean = nan_to_null(df)
    marks = [
        F.when(r.row, F.lit(r.target if r.name == "condition" else f"{r.target}:{r.name}"))
        for r in build_rules(clean, rules)
        if r.row is not None
    ]
    names = F.array_compact(F.array(*marks)) if marks else F.array().cast("array<string>")
    with lenient(df.sparkSession):
        return clean.withColumn(out, names)


def split_violations(df: DataFrame, rules: dict | None = None, out: str = "violated_rules") -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with the names of the violated rules in ``out``)."""
    tagged = tag_violations(df, rules, out)
    good = tagged.filter(F.size(col(out)) == 0).drop(out)
    return good, tagged.filter(F.size(col(out)) > 0)
