"""Reports: overview, recommendations, executive summary."""

from __future__ import annotations

import json
from collections import Counter
from datetime import datetime, timezone
from itertools import batched

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nulls import col, legacy_type, nan_to_null, numeric_columns, require_frame
from ..sources.files import file_address, object_settings
from .clean import COUNTED_AT_ONCE, value_counts
from .profile import Facts, gather

# Lowest score of each status band, best first.
STATUS_BANDS = [(90, "Excellent"), (80, "Good"), (70, "Fair"), (60, "Poor")]
LOWEST_STATUS = "Critical"
LARGE_MB = 100
LOW_CARDINALITY = 0.5
LOW_SCORE = 80
REPORT_VERSION = "1.0"
SKETCH_ERROR = 0.02  # relative standard deviation of the first distinct-count estimate


def quality_status(score: Column) -> Column:
    """The status band of a score column."""
    chain = None
    for least, name in STATUS_BANDS:
        chain = F.when(score >= least, name) if chain is None else chain.when(score >= least, name)
    return chain.otherwise(LOWEST_STATUS)


def status_of(score: float) -> str:
    return next((name for least, name in STATUS_BANDS if score >= least), LOWEST_STATUS)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def low_cardinality(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """column, distinct_values, ratio for string columns with few distinct values.

    One sketch pass sets aside the columns that are far above the limit; the others are counted exactly, all in
    one scan, which is cheap because they hold few values.
    """
    cols = string_columns(df) if cols is None else cols
    schema = "column string, distinct_values bigint, ratio double"
    if not cols:
        return df.sparkSession.createDataFrame([], schema)
    row = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.approx_count_distinct(col(c), SKETCH_ERROR).alias(f"d{i}") for i, c in enumerate(cols)],
    ).first()
    n = row["n"]
    likely = [c for i, c in enumerate(cols) if n and row[f"d{i}"] * (1 - 6 * SKETCH_ERROR) < LOW_CARDINALITY * n]
    found = []
    for some in batched(likely, COUNTED_AT_ONCE):
        counts, own = value_counts(df, list(some))
        row = counts.agg(*[F.count_if(mine & F.col(f"v{i}").isNotNull()).alias(f"d{i}") for i, mine in enumerate(own)]).first()
        found += [(c, row[f"d{i}"], row[f"d{i}"] / n) for i, c in enumerate(some)]
    return df.sparkSession.createDataFrame([f for f in found if f[2] < LOW_CARDINALITY], schema)


def overview(df: DataFrame, facts: Facts) -> dict:
    types = {f.name: legacy_type(f.dataType) for f in df.schema.fields}
    return {
        "total_rows": facts.rows,
        "total_columns": len(df.columns),
        "memory_usage_mb": round(facts.bytes / 1024 / 1024, 2),
        "column_types": dict(Counter(types.values())),
        "numeric_columns": numeric_columns(df),
        "categorical_columns": [c for c, t in types.items() if t == "object"],
        "datetime_columns": [c for c, t in types.items() if t.startswith("datetime64")],
    }


def recommendations(df: DataFrame, facts: Facts, quality: dict | None = None) -> list[dict[str, str]]:
    found = []

    def advise(category: str, priority: str, text: str) -> None:
        found.append({"category": category, "priority": priority, "recommendation": text})

    size = facts.bytes / 1024 / 1024
    if size > LARGE_MB:
        advise("Performance", "Medium", f"The table holds {size:.1f} MB; partition it by a column that queries filter on.")
    ratios = {r["column"]: r["ratio"] for r in low_cardinality(df).collect()}
    for c in [c for c in df.columns if c in ratios]:
        advise("Optimization", "Low", f"Column '{c}' has few distinct values ({ratios[c]:.2%}); a lookup code would be smaller.")
    if quality:
        score = quality.get("overall_score", 100)
        if score < LOW_SCORE:
            advise("Quality", "High", f"The quality score is low ({score:.1f}%); settle the issues before using the data.")
        for kind, text in _issue_kinds(quality):
            if kind == "null":
                advise("Completeness", "Medium", f"Fill or remove missing values: {text}")
            elif kind == "duplicate":
                advise("Uniqueness", "Medium", f"Look into the duplicates: {text}")
    with_nulls = [c for c, n in facts.nulls.items() if n > 0]
    if with_nulls:
        advise("Completeness", "Medium", f"Columns with null values: {', '.join(with_nulls)}.")
    return found


def _issue_kinds(quality: dict) -> list[tuple[str | None, str]]:
    """Each issue with its kind, from the failed rules when there are any, else from the text."""
    texts = quality.get("issues", [])
    kinds = {"completeness": "null", "uniqueness": "duplicate"}
    if quality.get("failed_rules") and len(quality["failed_rules"]) == len(texts):
        return [(kinds.get(r["family"]), t) for r, t in zip(quality["failed_rules"], texts)]
    return [("null" if "null" in t.lower() else "duplicate" if "duplicate" in t.lower() else None, t) for t in texts]


def _critical(quality: dict) -> int:
    texts = quality.get("issues", [])
    failed = quality.get("failed_rules") or []
    if failed and len(failed) == len(texts):
        named = ("required", "critical", "violation")
        return sum(r["rule"] == "required" or any(w in r["target"].lower() for w in named) for r in failed)
    return sum(any(w in t.lower() for w in ("required", "critical", "violation")) for t in texts)


def build_report(
    df: DataFrame,
    inspection: dict | None = None,
    quality: dict | None = None,
    config: dict | None = None,
    facts: Facts | None = None,
) -> dict:
    """Assemble the report; pass ``facts`` from an earlier profile to avoid another pass."""
    require_frame(df, "build_report")
    df = nan_to_null(df)
    facts = facts or gather(df, [])
    report = {
        "metadata": {
            "report_timestamp": datetime.now(timezone.utc).isoformat(),
            "dataset_name": (config or {}).get("dataset_name", "Unknown"),
            "report_version": REPORT_VERSION,
        },
        "dataset_overview": overview(df, facts),
    }
    if inspection:
        report["data_inspection"] = inspection
    if quality:
        report["quality_assessment"] = quality
    report["recommendations"] = recommendations(df, facts, quality)
    report["executive_summary"] = _summary(report)
    return report


def _summary(report: dict) -> dict:
    size, quality = report["dataset_overview"], report.get("quality_assessment")
    summary = {
        "dataset_size": f"{size['total_rows']:,} rows × {size['total_columns']} columns",
        "memory_footprint": f"{size['memory_usage_mb']:.1f} MB",
    }
    if quality:
        score = quality.get("overall_score", 0)
        summary["quality_score"] = f"{score:.1f}%"
        summary["quality_status"] = status_of(score)
        summary["critical_issues"] = _critical(quality)
    summary["high_priority_recommendations"] = sum(r["priority"] == "High" for r in report["recommendations"])
    return summary


def save_report(spark, report: dict, uri: str, storage: dict[str, str] | None = None) -> str:
    """Write the report as JSON text to any file system; ``storage`` holds access settings."""
    text = json.dumps(report, default=str, ensure_ascii=False)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").options(**(storage or {})).text(uri)
    return uri


def analyze(df: DataFrame, config: dict | None = None) -> dict | None:
    """Profile, quality check and report on one table, sharing one pass for the basic facts."""
    config = config or {}
    if not config.get("enabled", True):
        return None
    from .profile import inspect
    from .quality import check_quality

    clean = nan_to_null(df)
    inspection_config = config.get("inspection") or {}
    facts = gather(
        clean,
        numeric_columns(clean, inspection_config.get("numeric", "strict")),
        inspection_config.get("include_correlations", False),
    )
    inspection = inspect(clean, inspection_config, facts)
    quality = check_quality(clean, (config.get("quality") or {}).get("quality_rules"), facts=facts)
    reporting = config.get("reporting") or {}
    report = build_report(clean, inspection, quality, reporting, facts)
    if config.get("save_report", True) and reporting.get("output_path"):
        save_report(df.sparkSession, report, file_address(reporting["output_path"]), object_settings(reporting | {"uri": reporting["output_path"]}))
    return {"inspection": inspection, "quality": quality, "report": report}
