"""File sources: CSV with type inference, object-store files by suffix, rows."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nulls import CAST_TARGETS, as_list, col, quoted
from .records import records_of

# Cell texts read as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)
TRUE_TOKENS = ("True", "TRUE", "true")
FALSE_TOKENS = ("False", "FALSE", "false")
# How whole and decimal numbers are written.
INT_PATTERN = r"^\s*[+-]?[0-9]+\s*$"
FLOAT_PATTERN = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|inf|Inf|INF|infinity|Infinity)\s*$"

BATCH_FORMATS = {".csv": "csv", ".parquet": "parquet", ".json": "json"}


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    sep: str = ",",
    encoding: str = "utf-8",
    header: bool | int | None = 0,
    schema: str | T.StructType | None = None,
    dtype: dict[str, str] | None = None,
    parse_dates: list[str] | None = None,
    infer: bool = True,
    multi_line: bool = False,
    bad_rows: str = "fail",
    storage: dict[str, str] | None = None,
) -> DataFrame:
    """Read CSV files. ``header`` is 0 or True for a first header line, None or False for none.

    Without ``schema`` every cell is read as text, missing-value words become null, and one
    aggregate over the files finds the narrowest type of each column. ``multi_line`` allows line
    breaks in quoted cells; large files are still split, at the price of one more pass, see ``records_of``.
    Only files in other encodings than UTF-8 are then read by one task each. A row with too many or too
    few cells, or one that does not fit ``schema``, ends the job; ``bad_rows="keep"`` cuts or fills it.
    """
    if not path:
        raise ValueError("CSV source requires 'path'")
    if not (header is None or isinstance(header, bool) or header == 0):
        raise ValueError("only the first line can be a header")
    if bad_rows not in ("fail", "keep"):
        raise ValueError("bad_rows must be 'fail' or 'keep'")
    has_header = header is not None and header is not False
    reader = (
        spark.read.option("header", has_header)
        .option("sep", sep)
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", "FAILFAST" if bad_rows == "fail" else "PERMISSIVE")
        .option("columnPruning", bad_rows == "keep")  # else only the cells that are asked for are looked at
        .options(**(storage or {}))
    )
    if multi_line and encoding.lower().replace("-", "") == "utf8":
        raw = _open(lambda: _split_csv(spark, reader, path, sep, has_header, schema, bad_rows, storage or {}), path)
    else:
        raw = _open(lambda: (reader if schema is None else reader.schema(schema)).csv(path), path)
    if schema is not None:
        return raw
    if not has_header:
        raw = raw.toDF(*[str(i) for i in range(len(raw.columns))])
    known = raw.select(*[F.when(~col(c).isin(*NA_TOKENS), col(c)).alias(c) for c in raw.columns])
    fixed = {c: CAST_TARGETS.get(t, t) for c, t in (dtype or {}).items() if c in raw.columns}
    dates = [c for c in as_list(parse_dates) if c in raw.columns]
    chosen = {c: col(c).cast(t) for c, t in fixed.items()}
    free = [c for c in raw.columns if c not in fixed and c not in dates]
    if infer and (free or dates):
        chosen |= _infer(known, free, dates)
    return known.select(*[chosen.get(c, col(c)).alias(c) for c in known.columns])


def _split_csv(spark, reader, path, sep: str, has_header: bool, schema, bad_rows: str, storage: dict[str, str]) -> DataFrame:
    """Records are found first, so that any of their cells may hold line breaks, and then taken apart one by one."""
    if schema is None:
        names = reader.csv(path).columns  # looks at the first record
        names[-1] = names[-1].removesuffix("\r")
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    elif isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    records = records_of(spark, path, sep, has_header, storage)
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true", "mode": "FAILFAST" if bad_rows == "fail" else "PERMISSIVE"}
    ddl = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    cells = records.select(F.from_csv("record", ddl, options).alias("cells"))
    return cells.select("cells.*")


def _open(read, path, hint: str = "") -> DataFrame:
    try:
        return read()
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"no such path: {path}") from error
        raise RuntimeError(f"cannot read {path}: {error}") from error
    except (PySparkException, Py4JJavaError) as error:  # files are looked at for their types here
        raise RuntimeError(f"cannot read {path}: {str(error).splitlines()[0]} {hint}".rstrip()) from error


def _ladder(c: Column) -> dict[str, Column]:
    """Each type with the value it would give, narrowest first."""
    flag = F.when(c.isin(*TRUE_TOKENS), True).when(c.isin(*FALSE_TOKENS), False)
    return {
        "bigint": F.when(c.rlike(INT_PATTERN), F.trim(c).try_cast("bigint")),
        "double": F.when(c.rlike(FLOAT_PATTERN), F.trim(c).try_cast("double")),
        "boolean": flag,
    }


def _infer(df: DataFrame, free: list[str], dates: list[str]) -> dict[str, Column]:
    attempts = {c: _ladder(col(c)) for c in free}
    attempts |= {c: {"timestamp": col(c).try_cast("timestamp_ntz")} for c in dates}
    names = {(c, t): f"f{i}_{t}" for i, c in enumerate(attempts) for t in attempts[c]}
    known = {c: f"k{i}" for i, c in enumerate(attempts)}
    row = df.agg(
        *[F.count(col(c)).alias(k) for c, k in known.items()],
        *[F.count_if(col(c).isNotNull() & attempts[c][t].isNull()).alias(n) for (c, t), n in names.items()],
    ).first()
    chosen = {}
    for c, ladder in attempts.items():
        if c in free and row[known[c]] == 0:
            chosen[c] = col(c).cast("double")  # a column without values is an empty number column
            continue
        fit = next((t for t in ladder if row[names[c, t]] == 0), None)
        if fit:
            chosen[c] = ladder[fit]
    return chosen


def read_object(
    spark: SparkSession, uri: str, json_lines: bool = True, storage: dict[str, str] | None = None, **options
) -> DataFrame:
    """Read any file-system URI, the format taken from the suffix; other suffixes are CSV.

    JSON has one record or one array of records per line; a file that is one array over several lines
    is refused unless ``json_lines=False``, which reads each file in one task. ``storage`` holds access
    settings for this read only, see ``object_settings``.
    """
    if not uri:
        raise ValueError("object source requires 'uri'")
    uri = file_address(uri)
    reader = spark.read.options(**(storage or {}))
    suffix = next((f for s, f in BATCH_FORMATS.items() if uri.endswith(s)), None)
    if suffix == "parquet":
        return _open(lambda: reader.parquet(uri), uri)
    if suffix == "json":
        lines = reader.option("multiLine", not json_lines).option("mode", "FAILFAST")
        return _open(lambda: lines.json(uri), uri, "is it one array over several lines? Then set json_lines=False")
    if suffix == "csv":
        return read_csv(spark, uri, storage=storage, **options)
    return read_csv(spark, uri, storage=storage)


def file_address(uri: str) -> str:
    """The address under which Spark's file systems know an object; ``s3://`` is served by ``s3a://``."""
    return "s3a://" + uri[len("s3://") :] if uri.startswith("s3://") else uri


def object_uri(config: dict) -> str:
    """``uri``, or an s3a address from ``bucket`` and ``key``."""
    if config.get("uri"):
        return file_address(config["uri"])
    for name in ("bucket", "key"):
        if not config.get(name):
            raise ValueError(f"object store requires '{name}' in configuration")
    return f"s3a://{config['bucket']}/{config['key']}"


def object_settings(config: dict) -> dict[str, str]:
    """Hadoop settings for one bucket, to pass as ``storage``; the default provider chain does the rest.

    The bucket is named by ``bucket`` or stands in an ``s3://`` or ``s3a://`` address. ``storage`` adds settings of any kind.
    """
    settings = dict(config.get("storage") or {})
    bucket = config.get("bucket")
    if not bucket and file_address(config.get("uri") or "").startswith("s3a://"):
        bucket = file_address(config["uri"])[len("s3a://") :].split("/")[0]
    if not bucket:
        return settings
    prefix = f"fs.s3a.bucket.{bucket}."
    if config.get("access_key") and config.get("secret_key"):
        settings[prefix + "access.key"] = config["access_key"]
        settings[prefix + "secret.key"] = config["secret_key"]
    if config.get("region"):
        settings[prefix + "endpoint.region"] = config["region"]
    if config.get("server_side_encryption"):
        settings[prefix + "encryption.algorithm"] = config["server_side_encryption"]
    return settings


def from_rows(spark: SparkSession, rows: list[dict] | dict, schema: str | T.StructType | None = None) -> DataFrame:
    """A table from one record or a list of records; absent fields are null."""
    if isinstance(rows, dict):
        rows = [rows]
    if not isinstance(rows, list):
        raise ValueError(f"unsupported data type: {type(rows).__name__}")
    if schema is not None:
        return spark.createDataFrame(rows, schema)
    names = list(dict.fromkeys(k for r in rows for k in r))
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], names)


def load_intermediate(spark: SparkSession, uri: str, fmt: str = "parquet", storage: dict[str, str] | None = None) -> DataFrame:
    uri, reader = file_address(uri), spark.read.options(**(storage or {}))
    if fmt == "parquet":
        return _open(lambda: reader.parquet(uri), uri)
    if fmt == "csv":
        return read_csv(spark, uri, storage=storage)
    if fmt == "json":
        return _open(lambda: reader.json(uri), uri)
    raise ValueError(f"unsupported format: {fmt}")
