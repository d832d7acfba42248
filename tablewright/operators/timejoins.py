"""Joins by time: the last row before, and overlapping intervals.

Neither puts a key's rows into one task, and neither compares all rows with all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nulls import as_list, col, free_names, is_orderable, nan_to_null, quoted, require_columns
from .windows import ROW_LIMIT, _fits, _sliced, _window

DAY = 86_400_000_000
STEP = 4  # each level's bins are so many times as wide as those of the level below


def _right_names(left: DataFrame, names: list[str], suffix: str) -> dict[str, str]:
    """Names in the result for columns of the right side."""
    renamed = {c: c + suffix if c in left.columns else c for c in names}
    taken = [n for n in renamed.values() if n in left.columns or list(renamed.values()).count(n) > 1]
    if taken:
        raise ValueError(f"columns of both sides have the same name: {sorted(set(taken))}")
    return renamed


def asof_join(
    left: DataFrame,
    right: DataFrame,
    time: str,
    by: list[str] | str | None = None,
    right_time: str | None = None,
    tolerance: Column | None = None,
    exact: bool = True,
    suffix: str = "_right",
    row_limit: int = ROW_LIMIT,
) -> DataFrame:
    """Every row of ``left`` with the last row of ``right`` that is not later, among those with the same ``by``.

    ``exact=False`` takes only earlier rows, ``tolerance`` (an interval or a number, as a Column) none that are earlier by
    more. Of several rows at the last time the greatest by their other columns is taken. Without such a row, and where
    time or key is missing, the columns of ``right`` are null. Columns that ``left`` has too get ``suffix``.

    Both sides are put in one order. Where a key has more than ``row_limit`` rows the order is cut into slices, and a
    slice without an earlier row of its own gets the last one of the slices before it.
    """
    left, right = nan_to_null(left), nan_to_null(right)
    keys, right_time = as_list(by), right_time or time
    require_columns(left, [*keys, time], "as-of join")
    require_columns(right, [*keys, right_time], "as-of join")
    names = _right_names(left, [c for c in right.columns if c not in keys], suffix)
    if not keys:
        one = free_names([*left.columns, *right.columns], "_all")[0]
        joined = asof_join(left.withColumn(one, F.lit(0)), right.withColumn(one, F.lit(0)), time, one, right_time, tolerance, exact, suffix, row_limit)
        return joined.drop(one)
    at, side, row, found = free_names(keys, "_at", "_side", "_row", "_found")
    known = [left.filter(_all_known(keys + [time])), right.filter(_all_known(keys + [right_time]))]
    value = F.struct(*[col(c).alias(n) for c, n in names.items()])
    events = known[1].select(*[col(k) for k in keys], col(right_time).alias(at), F.lit(0 if exact else 1).alias(side), value.alias(found))
    asking = known[0].select(*[col(k) for k in keys], col(time).alias(at), F.lit(1 if exact else 0).alias(side), F.struct(*[col(c) for c in left.columns]).alias(row))
    both = asking.unionByName(events, allowMissingColumns=True)
    kinds = dict(zip(names.values(), (right.schema[c].dataType for c in names)))
    ties = [col(found)[n].asc_nulls_first() for n, kind in kinds.items() if is_orderable(kind)]
    order = [col(at).asc(), col(side).asc(), *ties]
    if _fits(both, keys, row_limit):
        upto = _window(keys, order).rowsBetween(Window.unboundedPreceding, 0)
        matched = both.withColumn(found, F.last(found, ignorenulls=True).over(upto))
    else:
        matched = _carried(both, keys, order, found, F.struct(col(at), *[col(found)[n] for n, kind in kinds.items() if is_orderable(kind)]), row_limit)
    matched = matched.filter(col(row).isNotNull())
    if tolerance is not None:
        near = col(at) <= col(found)[names[right_time]] + tolerance
        matched = matched.withColumn(found, F.when(near, col(found)))
    result = matched.select(f"{row}.*", *[col(found)[n].alias(n) for n in kinds])
    lost = left.filter(~_all_known(keys + [time]))
    return result.unionByName(lost.select("*", *[F.lit(None).cast(kind).alias(n) for n, kind in kinds.items()]))


def _all_known(names: list[str]) -> Column:
    known = F.lit(True)
    for n in names:
        known = known & col(n).isNotNull()
    return known


def _carried(both: DataFrame, keys: list[str], order: list[Column], found: str, place: Column, row_limit: int) -> DataFrame:
    """``found`` as the last one up to each row, over slices of the order."""
    sliced, piece = _sliced(both, keys, order, row_limit)
    last, before, of, *names = free_names(sliced.columns, "_last", "_before", "_of", *[f"_b{i}" for i in range(len(keys))])
    # One row for each key and slice: the last of a slice's own, then the last of all slices before.
    own = sliced.filter(col(found).isNotNull()).groupBy(*[col(k) for k in keys], piece).agg(F.max_by(col(found), place).alias(last))
    pieces = sliced.select(*[col(k) for k in keys], piece).distinct().join(own, [*keys, piece], "left")
    earlier = _window(keys, [F.col(piece)]).rowsBetween(Window.unboundedPreceding, -1)
    carried = pieces.withColumn(before, F.last(last, ignorenulls=True).over(earlier)).filter(col(before).isNotNull())
    carried = carried.drop(last).withColumnsRenamed(dict(zip(keys, names)) | {piece: of})
    match = sliced[piece] == carried[of]
    for k, name in zip(keys, names):
        match = match & (sliced[quoted(k)] == carried[name])
    upto = _window(keys, order, piece).rowsBetween(Window.unboundedPreceding, 0)
    inside = sliced.withColumn(found, F.last(found, ignorenulls=True).over(upto))
    joined = inside.join(carried, match, "left")
    return joined.withColumn(found, F.coalesce(col(found), col(before))).drop(piece, before, of, *names)


def interval_join(
    left: DataFrame,
    right: DataFrame,
    left_span: tuple[str, str] | str,
    right_span: tuple[str, str] | str,
    by: list[str] | str | None = None,
    suffix: str = "_right",
) -> DataFrame:
    """All pairs of rows whose spans have a point in common, among those with the same ``by``; ends belong to a span.

    A span is two columns (times, dates or numbers), or one for a point. Rows with a missing end or key, and spans that
    end before they begin, match nothing. Columns that ``left`` has too get ``suffix``.

    Spans are put into bins of the level that fits their length, each level ``STEP`` times as wide as the one below, so
    a span lies in at most two bins of a level. A pair meets at the wider of its two levels, in the first bin that both
    lie in; a row is copied only to levels at which the other side has spans, whatever their lengths. Equal bins are
    joined by an ordinary equi-join, which adaptive execution splits where a bin or key is crowded.
    """
    left, right = nan_to_null(left), nan_to_null(right)
    keys = as_list(by)
    spans = [(s, s) if isinstance(s, str) else tuple(s) for s in (left_span, right_span)]
    for frame, span in zip((left, right), spans):
        require_columns(frame, [*keys, *span], "interval join")
    names = _right_names(left, [c for c in right.columns if c not in keys], suffix)
    start, end, level, at, bin_, first = free_names([*left.columns, *names.values()], "_start", "_end", "_level", "_at", "_bin", "_first")

    def placed(frame: DataFrame, span: tuple[str, str]) -> DataFrame:
        rows = frame.filter(_all_known([*keys, *span]))
        rows = rows.withColumns({start: _position(col(span[0]), frame.schema[span[0]].dataType), end: _position(col(span[1]), frame.schema[span[1]].dataType)})
        return rows.filter(col(span[0]) <= col(span[1]))

    sides = [placed(f, s) for f, s in zip((left, right.withColumnsRenamed(names)), (spans[0], tuple(names[c] for c in spans[1])))]
    lengths = [s.agg(F.avg(col(end) - col(start)), F.max(F.abs(col(start)))).first() for s in sides]
    base = max(1e-9, *(v[0] or 0.0 for v in lengths)) / STEP
    if all(not v[0] for v in lengths):  # points on both sides: any width will do
        base = max(1.0, *((v[1] or 0.0) * 1e-9 for v in lengths))
    depth = F.greatest(F.lit(0), F.ceil(F.log(float(STEP), F.greatest((col(end) - col(start)) / F.lit(base), F.lit(1.0))) + 1e-9)).cast("int")
    sides = [s.withColumn(level, depth) for s in sides]
    present = [sorted(r[0] for r in s.select(level).distinct().collect()) for s in sides]  # lengths differ by a few dozen levels at most

    def binned(side: DataFrame, others: list[int]) -> DataFrame:
        wider = F.filter(F.array(*[F.lit(k) for k in others]).cast("array<int>"), lambda k: k > col(level))
        rows = side.withColumn(at, F.explode(F.array_union(F.array(col(level)), wider)))
        width = F.lit(base) * F.pow(F.lit(float(STEP)), col(at))
        rows = rows.withColumn(first, F.floor(col(start) / width))
        return rows.withColumn(bin_, F.explode(F.sequence(col(first), F.floor(col(end) / width))))

    bins = [binned(sides[0], present[1]), binned(sides[1], present[0])]
    helpers = [start, end, level, first]
    other = free_names([*bins[0].columns, *bins[1].columns], *[h + "_other" for h in helpers])
    second = bins[1].withColumnsRenamed(dict(zip(helpers, other)))
    level2, first2 = col(other[2]), col(other[3])
    (a, b), (c, d) = spans[0], (names[n] for n in spans[1])
    pairs = bins[0].join(second, [*keys, at, bin_])
    meet = (col(at) == F.greatest(col(level), level2)) & (col(bin_) == F.greatest(col(first), first2))
    pairs = pairs.filter(meet & (col(a) <= col(d)) & (col(c) <= col(b)))
    return pairs.select(*[col(c) for c in left.columns], *[col(n) for n in names.values()])


def _position(c: Column, kind: T.DataType) -> Column:
    """A number in the order of the values; times in microseconds."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(kind, T.TimestampNTZType):  # by its parts, so that no time zone comes in
        parts = F.hour(c) * 3600 + F.minute(c) * 60
        return (F.unix_date(c.cast("date")).cast("long") * DAY + parts.cast("long") * 1_000_000 + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("long")).cast("double")
    if isinstance(kind, T.DateType):
        return (F.unix_date(c).cast("long") * DAY).cast("double")
    if isinstance(kind, T.NumericType):
        return c.cast("double")
    raise ValueError(f"a span needs times, dates or numbers, not {kind.simpleString()}")
