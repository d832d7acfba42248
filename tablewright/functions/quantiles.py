"""Exact linear-interpolated quantiles that never gather a large group in one task.

Groups are counted first. Those of at most ``row_limit`` rows are ranked by one sort per group
and column, which spills to disk where memory is short; all columns share that pass. Larger groups are solved by narrowing: each pass sketches the
values still in question, counts exactly how many lie below each sketched value, and keeps
only the gap that contains the wanted rank. The sketch decides how fast the gap shrinks;
the counts alone decide the answer. Every pass is a partial aggregate over one pruned
scan, so nothing but a row of counters per group is shuffled.
"""

from __future__ import annotations

from functools import reduce
from itertools import product
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import freeze
from .nulls import as_list, col, value_of

ROW_LIMIT = 1_000_000  # largest group ranked inside one task
LIST_LIMIT = 100_000  # largest leftover gap sorted inside one task
BROADCAST_ROWS = 10_000  # largest per-group state sent to every executor
GRID = 1024  # sketched values per pass
WHOLE = "_whole"  # key of the only group when there are no keys
COLUMNS_AT_ONCE = 8  # columns whose sketches share one aggregate


def quantile_frame(
    df: DataFrame,
    cols: list[str],
    probs: list[float],
    keys: list[str] | str | None = None,
    row_limit: int = ROW_LIMIT,
    list_limit: int = LIST_LIMIT,
) -> DataFrame:
    """One row per group: the keys, and ``_q0.._qN`` (one array per column, in ``probs`` order).

    Null keys form their own group; callers that drop them filter first.
    """
    keys = as_list(keys)
    group = [f"_k{i}" for i in range(len(keys))] or [WHOLE]
    grouping = [col(k).alias(g) for k, g in zip(keys, group)] or [F.lit(0).alias(WHOLE)]
    base = df.select(*grouping)
    sizes = base.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    biggest = sizes.agg(F.max("_n")).first()[0] or 0
    hot = None
    if biggest > row_limit:
        hot = freeze(sizes.filter(F.col("_n") > row_limit).drop("_n"), "hot-groups")

    result = None
    step = len(cols) if hot is None else COLUMNS_AT_ONCE
    for first in range(0, len(cols), max(step, 1)):
        part = cols[first : first + step]
        values = [value_of(df, c).cast("double").alias(f"_v{i}") for i, c in enumerate(part)]
        solved = _solve(df.select(*grouping, *values), hot, group, len(part), probs, list_limit, bool(keys))
        solved = solved.withColumnsRenamed({f"_q{i}": f"_r{first + i}" for i in range(len(part))})
        result = solved if result is None else _join_state(result, solved, group)
    return result.select(
        *[F.col(g).alias(k) for k, g in zip(keys, group)],
        *[F.col(f"_r{i}").alias(f"_q{i}") for i in range(len(cols))],
    )


def _solve(
    source: DataFrame,
    hot: DataFrame | None,
    group: list[str],
    n_cols: int,
    probs: list[float],
    list_limit: int,
    grouped: bool,
) -> DataFrame:
    if hot is None:
        return _small(source, group, n_cols, probs, grouped)
    result = _narrow(source, hot, group, n_cols, probs, list_limit)
    if not grouped:
        return result
    known = hot.withColumnsRenamed({g: f"_h{g}" for g in group})
    match = F.lit(True)
    for g in group:
        match = match & source[g].eqNullSafe(known[f"_h{g}"])
    cold = source.join(_sized(known), match, "left_anti")
    return result.unionByName(_small(cold, group, n_cols, probs, grouped))


def quantile_values(
    df: DataFrame, cols: list[str], probs: list[float], row_limit: int = ROW_LIMIT, list_limit: int = LIST_LIMIT
) -> dict[str, list[float | None]]:
    """Whole-table quantiles as plain numbers, ready to be pushed into filters."""
    if not cols:
        return {}
    row = quantile_frame(df, cols, probs, row_limit=row_limit, list_limit=list_limit).first()
    missing = [None] * len(probs)
    return {c: list(row[f"_q{i}"] or missing) if row else missing for i, c in enumerate(cols)}


def approx_values(df: DataFrame, cols: list[str], probs: list[float]) -> dict[str, list[float | None]]:
    if not cols:
        return {}
    row = df.agg(
        *[
            F.percentile_approx(value_of(df, c).cast("double"), [float(p) for p in probs]).alias(f"_q{i}")
            for i, c in enumerate(cols)
        ]
    ).first()
    return {c: list(row[f"_q{i}"] or [None] * len(probs)) for i, c in enumerate(cols)}


def _small(source: DataFrame, group: list[str], n_cols: int, probs: list[float], grouped: bool) -> DataFrame:
    """Groups already counted to hold at most ``row_limit`` rows: rank the values of each column and pick.

    One shuffle of (group, column, value); the sort below the window spills, so no group's values are held.
    """
    keys = [*group, "_i"]
    long = source.select(*group, F.posexplode(F.array(*[F.col(f"_v{i}") for i in range(n_cols)])).alias("_i", "_v"))
    every = Window.partitionBy(*keys)
    ranked = long.withColumns(
        {
            "_r": F.row_number().over(every.orderBy(F.col("_v").asc_nulls_last())) - 1,
            "_n": F.count("_v").over(every.orderBy(F.col("_v").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
        }
    )
    places = [(F.col("_n") - 1) * F.lit(float(p)) for p in probs]
    wanted = [(F.floor(x), F.ceil(x)) for x in places]
    # The first row of a group stays in any case, so that a group without values is answered too.
    picked = ranked.filter(reduce(or_, (F.abs(F.col("_r") - x) < 1.0 for x in places), F.col("_r") == 0))
    ends = [F.max(F.when(F.col("_r") == end, F.col("_v"))).alias(f"_e{j}_{k}") for j, pair in enumerate(wanted) for k, end in enumerate(pair)]
    found = picked.groupBy(*keys).agg(F.max("_n").alias("_n"), *ends)
    values = F.array(*[_between(F.col(f"_e{j}_0"), F.col(f"_e{j}_1"), x) for j, x in enumerate(places)])
    answers = found.select(*keys, F.when(F.col("_n") > 0, values).alias("_q"))
    entries = F.map_from_entries(F.collect_list(F.struct("_i", "_q"))).alias("_all")  # one entry per column
    wide = answers.groupBy(*group).agg(entries) if grouped else answers.agg(entries).withColumn(WHOLE, F.lit(0))
    return wide.select(*group, *[F.try_element_at("_all", F.lit(i)).alias(f"_q{i}") for i in range(n_cols)])


def _between(low: Column, high: Column, place: Column) -> Column:
    """Linear interpolation at a fractional position between two neighbours."""
    share = place - F.floor(place)
    return F.when(low == high, low).otherwise((F.lit(1.0) - share) * low + share * high)


def _sized(state: DataFrame) -> DataFrame:
    """Broadcast per-group state only when it has been counted and is small."""
    return F.broadcast(state) if state.count() <= BROADCAST_ROWS else state


def _with_state(source: DataFrame, state: DataFrame, group: list[str]) -> DataFrame:
    """Rows of ``source`` in the groups of ``state``, each with its group's state."""
    if group == [WHOLE]:
        # One row of numbers: as literals they fold into the conditions and reach the scan.
        row = state.first()
        known = {f.name: (f.dataType, row[f.name]) for f in state.schema.fields if f.name != WHOLE}
        return source.withColumns({c: F.lit(v).cast(kind) for c, (kind, v) in known.items()}) if known else source
    renamed = state.withColumnsRenamed({g: f"_s{g}" for g in group})
    match = F.lit(True)
    for g in group:
        match = match & source[g].eqNullSafe(renamed[f"_s{g}"])
    return source.join(_sized(renamed), match).drop(*[f"_s{g}" for g in group])


def _narrow(
    source: DataFrame, hot: DataFrame, group: list[str], n_cols: int, probs: list[float], list_limit: int
) -> DataFrame:
    # A target is one (column, probability): its lower and upper neighbour ranks are adjacent,
    # so as long as both are unknown they lie in the same gap.
    targets = [(f"{i}_{j}", i, p) for i, (j, p) in product(range(n_cols), enumerate(probs))]
    grid = [k / GRID for k in range(GRID + 1)]

    # The first pass counts, and sketches each column once for all its targets.
    begun = _with_state(source, hot, group).groupBy(*group).agg(
        *[F.count(f"_v{i}").alias(f"_c{i}") for i in range(n_cols)],
        *[F.percentile_approx(f"_v{i}", grid).alias(f"_s{i}") for i in range(n_cols)],
    )
    start = {}
    for t, i, p in targets:
        place = (F.col(f"_c{i}") - 1) * F.lit(float(p))
        start[f"rl_{t}"] = F.floor(place).cast("long")
        start[f"ru_{t}"] = F.ceil(place).cast("long")
        start[f"left_{t}"] = F.col(f"_c{i}")
        start[f"sk_{t}"] = F.col(f"_s{i}")
        for name in ("lo", "hi", "al", "au"):
            start[f"{name}_{t}"] = F.lit(None).cast("double")
    state = _cut(source, begun.withColumns(start), group, targets)

    while True:
        sizes = [F.max(F.when(_is_open(t), F.col(f"left_{t}"))) for t, *_ in targets]
        worst = max((v or 0) for v in state.agg(*sizes).first())
        if worst <= list_limit:
            break
        sketch = _open_rows(source, state, group, targets).groupBy(*group).agg(
            *[F.percentile_approx(f"_w{t}", grid).alias(f"sk_{t}") for t, *_ in targets]
        )
        state = _cut(source, _join_state(state, sketch, group), group, targets)

    if worst > 0:
        gaps = _open_rows(source, state, group, targets).groupBy(*group).agg(
            *[F.sort_array(F.collect_list(f"_w{t}")).alias(f"gap_{t}") for t, *_ in targets]
        )
        state = _join_state(state, gaps, group)
        state = state.withColumns(
            {
                f"a{s}_{t}": F.coalesce(f"a{s}_{t}", F.get(f"gap_{t}", F.col(f"r{s}_{t}").cast("int")))
                for (t, *_), s in product(targets, "lu")
            }
        )

    answers = []
    for i in range(n_cols):
        values = []
        for j, p in enumerate(probs):
            place = (F.col(f"_c{i}") - 1) * F.lit(float(p))
            values.append(_between(F.col(f"al_{i}_{j}"), F.col(f"au_{i}_{j}"), place))
        answers.append(F.when(F.col(f"_c{i}") > 0, F.array(*values)).alias(f"_q{i}"))
    return state.select(*group, *answers)


def _is_open(t: str) -> Column:
    return F.col(f"al_{t}").isNull() | F.col(f"au_{t}").isNull()


def _in_gap(t: str, i: int) -> Column:
    """Value still in question for target ``t``: strictly between its two bounds."""
    v = F.col(f"_v{i}")
    above = F.col(f"lo_{t}").isNull() | (v > F.col(f"lo_{t}"))
    under = F.col(f"hi_{t}").isNull() | (v < F.col(f"hi_{t}"))
    return v.isNotNull() & _is_open(t) & above & under


def _open_rows(source: DataFrame, state: DataFrame, group: list[str], targets: list) -> DataFrame:
    """Rows with a value still in question; ``_w<target>`` holds it, null for settled targets.

    A projection of its own: inside an aggregate function the test would not be compiled.
    """
    tests = {t: _in_gap(t, i) for t, i, _ in targets}
    rows = _with_state(source, state, group).filter(reduce(or_, tests.values()))
    values = [F.when(tests[t], F.col(f"_v{i}")).alias(f"_w{t}") for t, i, _ in targets]
    keep = [c for c in state.columns if c.startswith(("x_", "y_"))]
    return rows.select(*group, *values, *keep)


def _join_state(state: DataFrame, extra: DataFrame, group: list[str]) -> DataFrame:
    """State plus what a pass found; groups without open rows find nothing."""
    renamed = extra.withColumnsRenamed({g: f"_e{g}" for g in group})
    match = F.lit(True)
    for g in group:
        match = match & state[g].eqNullSafe(renamed[f"_e{g}"])
    return state.join(renamed, match, "left").drop(*[f"_e{g}" for g in group])


def _cut(source: DataFrame, state: DataFrame, group: list[str], targets: list) -> DataFrame:
    """Cut every open gap at two sketched values around the wanted ranks, by exact counts.

    Ranks in the state are relative to the open gap.
    """
    probes = {}
    for t, *_ in targets:
        spot = F.floor(F.try_divide(F.col(f"rl_{t}") * GRID, F.greatest(F.col(f"left_{t}") - 1, F.lit(1)))).cast("int")
        probes[f"x_{t}"] = F.get(F.col(f"sk_{t}"), F.greatest(F.lit(0), spot - 1))
        probes[f"y_{t}"] = F.get(F.col(f"sk_{t}"), F.least(F.lit(GRID), spot + 2))
    keep = [c for c in state.columns if not c.startswith(("sk_", "_s"))]
    # Frozen so that the counts below and the update after them see the same sketch.
    probed = freeze(state.withColumns(probes).select(*keep, *probes), "quantile-probe")

    counts = []
    for t, *_ in targets:
        for name in "xy":
            value, probe = F.col(f"_w{t}"), F.col(f"{name}_{t}")
            counts.append(F.count_if(value < probe).alias(f"lt_{name}_{t}"))
            counts.append(F.count_if(value <= probe).alias(f"le_{name}_{t}"))
    counted = _join_state(probed, _open_rows(source, probed, group, targets).groupBy(*group).agg(*counts), group)

    solved = {}
    for (t, *_), s in product(targets, "lu"):
        rank = F.col(f"r{s}_{t}")
        hits = [
            F.when((F.col(f"lt_{n}_{t}") <= rank) & (rank < F.col(f"le_{n}_{t}")), F.col(f"{n}_{t}")) for n in "xy"
        ]
        solved[f"a{s}_{t}"] = F.coalesce(F.col(f"a{s}_{t}"), *hits)
    counted = counted.withColumns(solved)

    update = {}
    for t, *_ in targets:
        least = F.when(F.col(f"al_{t}").isNull(), F.col(f"rl_{t}")).otherwise(F.col(f"ru_{t}"))
        most = F.when(F.col(f"au_{t}").isNull(), F.col(f"ru_{t}")).otherwise(F.col(f"rl_{t}"))
        below_x, below_y = F.col(f"le_x_{t}") <= least, F.col(f"le_y_{t}") <= least
        above_x, above_y = F.col(f"lt_x_{t}") > most, F.col(f"lt_y_{t}") > most
        skipped = F.when(below_y, F.col(f"le_y_{t}")).when(below_x, F.col(f"le_x_{t}")).otherwise(0)
        kept = F.when(above_x, F.col(f"lt_x_{t}")).when(above_y, F.col(f"lt_y_{t}")).otherwise(F.col(f"left_{t}"))
        x, y = F.col(f"x_{t}"), F.col(f"y_{t}")
        update |= {
            f"lo_{t}": F.when(below_y, y).when(below_x, x).otherwise(F.col(f"lo_{t}")),
            f"hi_{t}": F.when(above_x, x).when(above_y, y).otherwise(F.col(f"hi_{t}")),
            f"rl_{t}": F.col(f"rl_{t}") - skipped,
            f"ru_{t}": F.col(f"ru_{t}") - skipped,
            f"left_{t}": kept - skipped,
        }
    return freeze(counted.withColumns(update).select(*keep), "quantile-state")
