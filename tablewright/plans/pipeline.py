"""A plain dictionary becomes one plan: source, transform, analysis, sink."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.aggregate import aggregate
from ..operators.buckets import BUCKETS, create_buckets, latest, read_buckets, upsert_buckets
from ..operators.clean import clean
from ..operators.graph import match_edges, match_nodes, upsert_edges, upsert_nodes
from ..operators.report import analyze
from ..operators.sqlops import sql_transform
from ..session import drop_stages, freeze, stage_count
from ..sources.files import from_rows, load_intermediate, object_settings, object_uri, read_csv, read_object
from ..sources.sinks import materialize, write_batches, write_csv, write_object
from . import ledger as runs


def _need(config: dict, names: list[str], what: str) -> None:
    for name in names:
        if not config.get(name):
            raise ValueError(f"{what} requires '{name}' in configuration")


# --- sources -----------------------------------------------------------------------------


def _csv_source(spark: SparkSession, config: dict) -> DataFrame:
    _need(config, ["path"], "CSV source")
    return read_csv(
        spark,
        config["path"],
        sep=config.get("separator", ","),
        encoding=config.get("encoding", "utf-8"),
        header=config.get("header", 0),
        schema=config.get("schema"),
        dtype=config.get("dtype"),
        parse_dates=config.get("parse_dates"),
        multi_line=config.get("multi_line", True),
        bad_rows=config.get("bad_rows", "fail"),
    )


def _object_source(spark: SparkSession, config: dict) -> DataFrame:
    uri = object_uri(config)
    options = {"storage": object_settings(config)}
    for ours, theirs in (("sep", "separator"), ("encoding", "encoding"), ("header", "header"), ("schema", "schema")):
        if config.get(theirs) is not None:
            options[ours] = config[theirs]
    if uri.endswith(".csv"):
        options["multi_line"] = config.get("multi_line", True)
        options["bad_rows"] = config.get("bad_rows", "fail")
    return read_object(spark, uri, json_lines=config.get("json_lines", True), **options)


def _graph_source(spark: SparkSession, config: dict) -> DataFrame:
    _need(config, ["nodes"], "graph source")
    def stored(spark: SparkSession, uri: str) -> DataFrame:
        return read_buckets(spark, uri) if config.get("bucketed") else load_intermediate(spark, uri, storage=_settings(config, uri))

    nodes = stored(spark, config["nodes"])
    if not config.get("edges"):
        return match_nodes(nodes, config.get("label"), config.get("where"))
    return match_edges(
        nodes,
        stored(spark, config["edges"]),
        config.get("relationship_type"),
        config.get("from_label"),
        config.get("to_label"),
        **_given(config, "id_field", "from_field", "to_field"),
    )


def _settings(config: dict, uri: str) -> dict[str, str]:
    """Access settings of a section for one of its addresses."""
    return object_settings(config | {"uri": uri})


def _given(config: dict, *names: str) -> dict:
    return {n: config[n] for n in names if config.get(n) is not None}


# --- transforms --------------------------------------------------------------------------


def _aggregate(df: DataFrame, config: dict) -> DataFrame:
    _need(config, ["group_by", "aggregations"], "aggregator")
    options = _given(
        config, "sort_by", "sort_ascending", "post_filter", "limit", "naming", "dropna", "sorted_groups", "order_by",
        "label", "method",
    )
    return aggregate(df, config["group_by"], config["aggregations"], **options)


def _sql(df: DataFrame, config: dict) -> DataFrame:
    return sql_transform(df, config.get("sql_query"), config.get("table_name", "source_data"), config.get("sql_file"))


# --- sinks -------------------------------------------------------------------------------


def _csv_sink(df: DataFrame, config: dict) -> None:
    _need(config, ["path"], "CSV sink")
    mode = "overwrite" if config.get("overwrite") else "append" if config.get("append") else "error"
    write_csv(
        df,
        config["path"],
        mode,
        sep=config.get("separator", ","),
        header=config.get("include_header", True),
        encoding=config.get("encoding", "utf-8"),
        single_file=config.get("single_file", False),
    )


def _object_sink(df: DataFrame, config: dict) -> None:
    write_object(df, object_uri(config), config.get("overwrite", False), object_settings(config))


def _graph_sink(df: DataFrame, config: dict) -> None:
    """Node or edge tables: read the current version, write the next one to ``target``.

    With ``bucketed`` the target is a table in buckets, made where there is none, and only touched buckets are written.
    """
    kind = config.get("load_type", "nodes")
    spark = df.sparkSession
    if kind == "custom":
        _need(config, ["batch_function"], "custom load")
        write_batches(df, config["batch_function"], config.get("batch_size", 1000))
        return
    if kind not in ("nodes", "relationships"):
        raise ValueError(f"unknown load_type: {kind}. Available: nodes, relationships, custom")
    _need(config, ["target"], "graph sink")
    if config.get("bucketed"):
        _bucketed_sink(df, config, kind)
        return
    if kind == "nodes":
        mode = "replace" if config.get("overwrite") else "merge"
        id_field = config.get("id_field", "id")
        label = config.get("node_label")
        if config.get("nodes"):
            existing = load_intermediate(spark, config["nodes"], storage=_settings(config, config["nodes"]))
        else:
            existing = (df.withColumn("label", F.lit(label)) if label else df).limit(0)
        result = upsert_nodes(existing, df, id_field, mode, config.get("order_by"), label)
    else:
        _need(config, ["nodes"], "relationship load")
        nodes = load_intermediate(spark, config["nodes"], storage=_settings(config, config["nodes"]))
        rel_type = config.get("relationship_type", "RELATED_TO")
        if config.get("edges"):
            edges = load_intermediate(spark, config["edges"], storage=_settings(config, config["edges"]))
        else:
            edges = df.withColumn("type", F.lit(rel_type)).limit(0)
        options = _given(config, "id_field", "from_field", "to_field", "from_label", "to_label", "order_by")
        result = upsert_edges(nodes, edges, df, rel_type=rel_type, **options)
    write_object(result, config["target"], config.get("replace_target", False), _settings(config, config["target"]))


def _bucketed_sink(df: DataFrame, config: dict, kind: str) -> None:
    spark, target = df.sparkSession, config["target"]
    if kind == "nodes":
        label, id_field = config.get("node_label"), config.get("id_field", "id")
        df = df.withColumn("label", F.lit(label)) if label else df
        keys = ["label", id_field] if label else [id_field]
        mode = "replace" if config.get("overwrite") else "merge"

        def merge(existing: DataFrame, incoming: DataFrame) -> DataFrame:
            return upsert_nodes(existing, incoming, id_field, mode, config.get("order_by"), label)
    else:
        _need(config, ["nodes"], "relationship load")
        rel_type = config.get("relationship_type", "RELATED_TO")
        df = df.withColumn("type", F.lit(rel_type))
        keys = [config.get("from_field", "from_id"), config.get("to_field", "to_id"), "type"]
        nodes = read_buckets(spark, config["nodes"])

        def merge(existing: DataFrame, incoming: DataFrame) -> DataFrame:
            options = _given(config, "id_field", "from_field", "to_field", "from_label", "to_label", "order_by")
            return upsert_edges(nodes, existing, incoming, rel_type=rel_type, **options)

    try:
        latest(spark, target)
    except FileNotFoundError:
        create_buckets(df.limit(0), target, keys, config.get("buckets", BUCKETS))
    upsert_buckets(spark, target, df, merge)


SOURCES: dict[str, Callable[[SparkSession, dict], DataFrame]] = {
    "csv": _csv_source,
    "s3": _object_source,
    "graph": _graph_source,
}
TRANSFORMS: dict[str, Callable[[DataFrame, dict], DataFrame]] = {
    "cleaner": clean,
    "aggregator": _aggregate,
    "sql": _sql,
}
SINKS: dict[str, Callable[[DataFrame, dict], None]] = {
    "csv": _csv_sink,
    "s3": _object_sink,
    "graph": _graph_sink,
}


def pick(registry: dict, config: dict, what: str) -> Callable:
    """The function registered for ``config['type']``."""
    kind = config.get("type")
    if not kind:
        raise ValueError(f"{what} configuration must include 'type'")
    if kind not in registry:
        raise ValueError(f"Unknown {what} type: {kind}. Available: {', '.join(registry)}")
    return registry[kind]


def extract(spark: SparkSession, config: dict) -> DataFrame:
    return pick(SOURCES, config, "source")(spark, config)


def transform(df: DataFrame, config: dict) -> DataFrame:
    return pick(TRANSFORMS, config, "transform")(df, config)


def load(df: DataFrame | list[dict] | dict, config: dict) -> None:
    """Write a table, a list of records or one record."""
    sink = pick(SINKS, config, "sink")
    sink(df if isinstance(df, DataFrame) else from_rows(SparkSession.active(), df), config)


@dataclass
class Run:
    """What a run did; row counts are read off the run itself."""

    status: str
    data: DataFrame | None = None
    analysis: dict | None = None
    metrics: dict[str, dict] = field(default_factory=dict)


def run_pipeline(
    spark: SparkSession,
    config: dict,
    ledger: str | None = None,
    name: str = "default",
    metrics: bool = False,
    clean_up: bool = False,
) -> Run:
    """source → transform → analysis → sink, each after the first optional.

    ``ledger`` names a table of finished runs; a run with the same configuration over the
    same content is skipped, and a run is recorded only after it has succeeded.
    ``metrics`` counts the rows of each step while it runs. It is off by default because a
    counted step cannot have later filters pushed below it. ``clean_up`` deletes the stages that the run has
    left in the shared folder, whether it succeeds or not; the run then has no ``data``, which would read them.
    Access settings of a section (``storage``, keys and region) hold for all addresses in it.
    """
    if clean_up:
        before = stage_count(spark)
        try:
            run = run_pipeline(spark, config, ledger, name, metrics)
        finally:
            drop_stages(spark, before)
        run.data = None
        return run
    if not config.get("source"):
        raise ValueError("configuration must include 'source'")
    for section, registry in (("source", SOURCES), ("transform", TRANSFORMS), ("load", SINKS)):
        if config.get(section):
            pick(registry, config[section], section)  # refuse unknown types before any job

    content = _file_content(spark, ledger, config["source"]) if ledger else None
    if content and runs.unchanged(spark, ledger, name, config, content):
        return Run("skipped")
    source = extract(spark, config["source"])
    if ledger and content is None:
        content = runs.content_of(source)
        if runs.unchanged(spark, ledger, name, config, content):
            return Run("skipped")

    watched: dict[str, Observation] = {}
    data = _watch(source, "extract", watched) if metrics else source
    kept = config.get("intermediates") or {}
    if kept.get("extract"):
        data = materialize(data, kept["extract"], storage=_settings(kept, kept["extract"]))
    if config.get("transform"):
        data = transform(data, config["transform"])
        data = _watch(data, "transform", watched) if metrics else data
        if kept.get("transform"):
            data = materialize(data, kept["transform"], storage=_settings(kept, kept["transform"]))

    analytics = config.get("analytics")
    if analytics and (config.get("transform") or config.get("load")) and not kept.get("transform"):
        data = freeze(data, "analysed")  # read by every pass of the analysis and by the sink
    analysis = analyze(data, analytics) if analytics else None
    if config.get("load"):
        load(data, config["load"])
    if ledger:
        runs.record(spark, ledger, name, config, content)

    ran = bool(config.get("load") or analytics or kept.get("transform"))
    columns = {"extract": len(source.columns), "transform": len(data.columns)}
    counted = {s: {"rows": o.get["rows"], "columns": columns[s]} for s, o in watched.items()} if ran else {}
    return Run("completed", data, analysis, counted)


def _file_content(spark: SparkSession, ledger: str, source: dict) -> str | None:
    """The content of a source that is files, without opening those that the ledger knows; None for other sources."""
    if source["type"] == "csv" and source.get("path"):
        return _known_files(spark, ledger, source["path"], "csv", None)
    if source["type"] == "s3":
        uri = object_uri(source)
        return _known_files(spark, ledger, uri, "parquet" if uri.endswith(".parquet") else "lines", object_settings(source))
    return None


def _known_files(spark: SparkSession, ledger: str, path, fmt: str, storage: dict | None) -> str | None:
    try:
        return runs.content_of_files(spark, ledger, path, fmt, storage)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            return None  # the source itself says what is missing
        raise


def _watch(df: DataFrame, step: str, watched: dict[str, Observation]) -> DataFrame:
    watched[step] = Observation()
    return df.observe(watched[step], F.count(F.lit(1)).alias("rows"))
