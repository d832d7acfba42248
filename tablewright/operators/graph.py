"""Node and edge tables: matching and keyed upserts.

Nodes carry an id and properties, and a ``label`` column when several labels share a table.
Edges carry the ids of both ends, a ``type`` and properties.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import as_list, col, free_names, nan_to_null, nulls_last, require_columns, total_order
from .clean import filter_rows
from .joins import spread_join

MODES = ("merge", "replace")


def match_nodes(nodes: DataFrame, label: str | None = None, where: str | Column | None = None) -> DataFrame:
    """Nodes of a label for which ``where`` is true; NaN is missing, in the condition and in the result."""
    nodes = nan_to_null(nodes)
    if label is not None:
        nodes = nodes.filter(F.col("label") == label)
    return nodes if where is None else filter_rows(nodes, where)


def match_edges(
    nodes: DataFrame,
    edges: DataFrame,
    rel_type: str | None = None,
    from_label: str | None = None,
    to_label: str | None = None,
    *,
    id_field: str = "id",
    from_field: str = "from_id",
    to_field: str = "to_id",
    to_nodes: DataFrame | None = None,
) -> DataFrame:
    """Edges with both end nodes: the edge's columns, then ``from_*`` and ``to_*`` node properties.

    A node with very many edges does not slow its task down, see ``spread_join``.
    """
    edges = nan_to_null(edges)
    if rel_type is not None:
        edges = edges.filter(F.col("type") == rel_type)
    starts = _ends(match_nodes(nodes, from_label), id_field, from_field, "from_", edges)
    ends = _ends(match_nodes(to_nodes if to_nodes is not None else nodes, to_label), id_field, to_field, "to_", edges)
    started = spread_join(edges, starts, from_field)
    matched = spread_join(started, ends, to_field, measure=edges)
    return matched.select(*[col(c) for c in edges.columns], *[col(c) for c in matched.columns if c not in edges.columns])


def _ends(nodes: DataFrame, id_field: str, field: str, prefix: str, edges: DataFrame) -> DataFrame:
    named = {c: field if c == id_field else prefix + c for c in nodes.columns}
    clash = [n for c, n in named.items() if c != id_field and n in edges.columns]
    if clash:
        raise ValueError(f"node property columns collide with edge columns: {clash}")
    return nodes.withColumnsRenamed(named)


def _latest(incoming: DataFrame, keys: list[str], order_by) -> DataFrame:
    """The last record of each key; ties beyond ``order_by`` are settled by content."""
    order = total_order(incoming, as_list(order_by), skip=keys)
    if not order:
        return incoming.dropDuplicates(keys)
    backwards = [col(c).desc_nulls_last() for c in order]
    last = Window.partitionBy(*[col(k) for k in keys]).orderBy(*backwards)
    place = free_names(incoming.columns, "_place")[0]
    return incoming.withColumn(place, F.row_number().over(last)).filter(col(place) == 1).drop(place)


def _refuse_null(df: DataFrame, keys: list[str]) -> None:
    missing = F.lit(False)
    for k in keys:
        missing = missing | col(k).isNull()
    if df.filter(missing).limit(1).count():
        raise ValueError(f"null in key columns {keys}")


def _overlay(existing: DataFrame, incoming: DataFrame, keys: list[str], mode: str) -> DataFrame:
    """Keyed full outer join; incoming columns win where the key came in, nulls included."""
    extra = [c for c in incoming.columns if c not in existing.columns]
    was, now = free_names(keys, "_old", "_new")
    old = existing.select(*[col(k) for k in keys], F.struct(*[col(c) for c in existing.columns]).alias(was))
    new = incoming.select(*[col(k) for k in keys], F.struct(*[col(c) for c in incoming.columns]).alias(now))
    joined = old.join(new, keys, "full_outer")
    came = F.col(now).isNotNull()
    columns = []
    for c in existing.columns + extra:
        if c in keys:
            columns.append(col(c))
            continue
        before = F.col(was).getField(c) if c in existing.columns else F.lit(None)
        if c in incoming.columns:
            columns.append(F.when(came, F.col(now).getField(c)).otherwise(before).alias(c))
        elif mode == "replace":
            columns.append(F.when(~came, before).alias(c))
        else:
            columns.append(before.alias(c))
    return joined.select(*columns)


def upsert_nodes(
    existing: DataFrame,
    incoming: DataFrame,
    id_field: str = "id",
    mode: str = "merge",
    order_by: list[str] | str | None = None,
    label: str | None = None,
) -> DataFrame:
    """Nodes after writing ``incoming``, one per id; the last record of an id wins.

    ``merge`` overlays the record's columns on the node (a null removes the property),
    ``replace`` drops all other properties of a node that came in.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    keys = [id_field]
    existing, incoming = nan_to_null(existing), nan_to_null(incoming)
    if label is not None:
        incoming = incoming.withColumn("label", F.lit(label))
        keys = ["label", id_field]
    require_columns(existing, keys, "Node key")
    require_columns(incoming, keys, "Node key")
    _refuse_null(incoming, keys)
    return _overlay(existing, _latest(incoming, keys, order_by), keys, mode)


def upsert_edges(
    nodes: DataFrame,
    edges: DataFrame,
    incoming: DataFrame,
    *,
    rel_type: str = "RELATED_TO",
    id_field: str = "id",
    from_field: str = "from_id",
    to_field: str = "to_id",
    from_label: str | None = None,
    to_label: str | None = None,
    to_nodes: DataFrame | None = None,
    order_by: list[str] | str | None = None,
) -> DataFrame:
    """Edges after writing ``incoming``: one per (from, to, type), both ends must exist.

    Records without both end nodes are left out. Copies of one edge are reduced before the
    end nodes are looked up.
    """
    keys = [from_field, to_field, "type"]
    edges, incoming = nan_to_null(edges), nan_to_null(incoming).withColumn("type", F.lit(rel_type))
    require_columns(incoming, keys, "Edge key")
    incoming = incoming.filter(col(from_field).isNotNull() & col(to_field).isNotNull())
    latest = _latest(incoming, keys, order_by)
    starts = match_nodes(nodes, from_label).select(col(id_field).alias(from_field))
    ends = match_nodes(to_nodes if to_nodes is not None else nodes, to_label).select(col(id_field).alias(to_field))
    started = spread_join(latest, starts, from_field, "left_semi", measure=incoming)
    linked = spread_join(started, ends, to_field, "left_semi", measure=incoming)
    return _overlay(edges, linked, keys, "merge")
