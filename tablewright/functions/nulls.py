"""Null, type and ordering rules shared by every operator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Legacy type names that quality rules match by prefix.
LEGACY_TYPES = {
    T.LongType: "int64",
    T.IntegerType: "int32",
    T.ShortType: "int16",
    T.ByteType: "int8",
    T.DoubleType: "float64",
    T.FloatType: "float32",
    T.BooleanType: "bool",
    T.TimestampType: "datetime64[ns]",
    T.TimestampNTZType: "datetime64[ns]",
}

# Names accepted as conversion targets.
CAST_TARGETS = {
    "float64": "double",
    "float32": "float",
    "float": "double",
    "int64": "bigint",
    "int32": "int",
    "int": "bigint",
    "datetime64[ns]": "timestamp",
    "str": "string",
    "object": "string",
    "category": "string",
    "bool": "boolean",
}


def require_frame(df, operator: str) -> None:
    if not isinstance(df, DataFrame):
        raise ValueError(f"{operator} requires a Spark DataFrame, got {type(df).__name__}")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """A column by exact name, dots and spaces included."""
    return F.col(quoted(name))


def free_names(columns: list[str], *names: str) -> list[str]:
    """Names like ``names`` that are no column yet, whatever the case, for columns that an operator adds for itself."""
    taken = {c.lower() for c in columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def refuse_taken(columns: list[str], out: str) -> None:
    """A result column must not replace one of the table."""
    if out.lower() in {c.lower() for c in columns}:
        raise ValueError(f"column '{out}' exists already: choose another name for the result")


def legacy_type(data_type: T.DataType) -> str:
    return LEGACY_TYPES.get(type(data_type), "object")


def numeric_columns(df: DataFrame, numeric: str = "strict") -> list[str]:
    """``strict`` keeps bigint and double only; ``all`` keeps every numeric type."""
    if numeric not in ("strict", "all"):
        raise ValueError(f"numeric must be 'strict' or 'all', got {numeric!r}")
    wanted = (T.LongType, T.DoubleType) if numeric == "strict" else (T.NumericType,)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, wanted)]


def is_floating(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.DoubleType, T.FloatType))


def clean_nan(column: Column) -> Column:
    return F.when(~F.isnan(column), column)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN is a missing value: turn it into NULL in every floating column."""
    floating = [f.name for f in df.schema.fields if is_floating(f.dataType)]
    if not floating:
        return df
    return df.withColumns({c: clean_nan(col(c)) for c in floating})


def value_of(df: DataFrame, name: str) -> Column:
    """The column with NaN read as NULL, without touching the frame itself."""
    column = col(name)
    return clean_nan(column) if is_floating(df.schema[name].dataType) else column


def is_orderable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return is_orderable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(is_orderable(f.dataType) for f in data_type.fields)
    return not isinstance(data_type, (T.MapType, T.VariantType))


def nulls_last(names: list[str], ascending: bool | list[bool] = True) -> list[Column]:
    """Sort keys with missing values last in both directions."""
    flags = [ascending] * len(names) if isinstance(ascending, bool) else list(ascending)
    if len(flags) != len(names):
        raise ValueError("sort_ascending must have one flag per sort column")
    return [col(n).asc_nulls_last() if up else col(n).desc_nulls_last() for n, up in zip(names, flags)]


def total_order(df: DataFrame, first: list[str] | None = None, skip: list[str] = ()) -> list[str]:
    """``first`` then every other orderable column, so that ties are only exact copies."""
    head = list(first or [])
    rest = [
        f.name
        for f in df.schema.fields
        if f.name not in head and f.name not in skip and is_orderable(f.dataType)
    ]
    return head + rest


def as_list(value) -> list:
    if value is None:
        return []
    return [value] if isinstance(value, str) else list(value)


def require_columns(df: DataFrame, names: list[str], role: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{role} columns not found: {missing}")
