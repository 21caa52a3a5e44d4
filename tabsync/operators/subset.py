"""Cutting a consistent subset out of an environment, starting from chosen rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsync.functions import has_key
from tabsync.sources.tables import in_list
from tabsync.spec import Env, TableSpec, by_name, table_tiers
from tabsync.storage import materialise, materialise_counted

#: Selected ids per table; each frame has the single column ``id`` and is written.
Selection = dict[str, DataFrame]


def root_ids(env: Env, spec: TableSpec, values: Sequence | DataFrame, match_by: str = "name") -> DataFrame:
    """Ids of the rows named by the caller; an empty result is an error."""
    column = spec.name_col if match_by == "name" else spec.id_col
    if column is None:
        raise ValueError(f"{spec.name} has no name column")
    ids, seen = materialise_counted(
        in_list(env[spec.name], column, values).select(F.col(spec.id_col).alias("id")).distinct(), "roots")
    if not seen["rows"]:
        raise ValueError(f"no row of {spec.name} matches by {column}")
    return ids


def _edges(specs: Sequence[TableSpec]) -> list[tuple[str, str, str]]:
    """(child, column, parent) of every reference in scope, those of a table to itself included."""
    scope = {s.name for s in specs}
    return [(s.name, r.col, p) for s in specs for r in s.refs if r.col not in s.exclude for p in r.to if p in scope]


def _among(df: DataFrame, col: str, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``col`` is a selected id; tables may well have a column of the name ``id``."""
    return df.join(ids.select(F.col("id").alias("_selected")), F.col(col) == F.col("_selected"), "left_semi")


def _below(rows: DataFrame, id_col: str, col: str, ids: DataFrame) -> DataFrame:
    """``id`` of the rows whose ``col`` is among ``ids``; values of one type are compared as they are, others as text."""
    same = rows.schema[col].dataType == ids.schema["id"].dataType
    plain = lambda c: F.col(c) if same else F.col(c).cast("string")
    pairs = rows.where(F.col(f"`{col}`").isNotNull()).select(F.col(id_col).alias("id"), plain(f"`{col}`").alias("_value"))
    return pairs.join(ids.select(plain("id").alias("_selected")), F.col("_value") == F.col("_selected"), "left_semi").select("id")


#: Pieces of a table's selection that are written together once there are so many.
PIECES = 16


class _Closure:
    """A selection that grows: per table the ids found so far, in the pieces in which they were found.

    Every edge remembers how many pieces of its source it has looked at, so each id is followed once along each edge, however
    often tables refer to each other or to themselves.
    """

    def __init__(self, env: Env, specs: Sequence[TableSpec], selected: Selection):
        self.env, self.specs = env, by_name(specs)
        self.pieces: dict[str, list[DataFrame]] = {t: [ids] for t, ids in selected.items()}
        self.seen: dict[tuple, int] = {}
        self.joined: dict[str, tuple[int, DataFrame]] = {}

    def fresh(self, edge: tuple, source: str) -> DataFrame | None:
        """Ids of ``source`` that the edge has not looked at; they count as looked at from now on."""
        at, pieces = self.seen.get(edge, 0), self.pieces.get(source, [])
        self.seen[edge] = len(pieces)
        return reduce(DataFrame.union, pieces[at:]) if pieces[at:] else None

    def ids(self, table: str) -> DataFrame:
        """All ids of a table; many pieces are written as one."""
        pieces = self.pieces[table]
        done, joined = self.joined.get(table, (0, None))
        if len(pieces) - done >= PIECES:
            joined = materialise(reduce(DataFrame.union, ([joined] if done else []) + pieces[done:]), f"selected-{table}")
            done = len(pieces)
            self.joined[table] = done, joined
        return reduce(DataFrame.union, ([joined] if done else []) + pieces[done:])

    def add(self, table: str, found: DataFrame, label: str) -> bool:
        """Take in the ids that are new (written and counted); whether there are any."""
        found = found.select(F.col("id").cast(self.env[table].schema[self.specs[table].id_col].dataType).alias("id")).where("id IS NOT NULL")
        if table in self.pieces:
            known = self.ids(table).select(F.col("id").alias("_known"))
            found = found.join(known, F.col("id") == F.col("_known"), "left_anti")
        ids, seen = materialise_counted(found.distinct(), f"{label}-{table}")
        if seen["rows"]:
            self.pieces.setdefault(table, []).append(ids)
        return bool(seen["rows"])

    def selection(self) -> Selection:
        return {t: self.ids(t) for t in self.pieces}


def _targets(refs: Sequence[tuple[str, str]]) -> Column:
    """(parent, value) for every reference of a row that has a value."""
    return F.explode(F.array_compact(F.array(*[
        F.when(F.col(col).isNotNull(), F.struct(F.lit(parent).alias("parent"), F.col(col).cast("string").alias("value"))) for col, parent in refs])))


def walk_down(env: Env, specs: Sequence[TableSpec], selected: Selection) -> Selection:
    """Add the rows below the selected ones, through every reference, to a fixpoint.

    Parents come before their children, so without cycles one sweep finds all; references of a table to itself and cycles of tables are followed until
    a sweep finds nothing. A sweep reads two columns of a table for each reference, and only for parents found since it was read last:
    ids move alone with the value in its own type, and not at all where Spark can broadcast the parents.
    """
    tiers, edges, walk = table_tiers(specs), _edges(specs), _Closure(env, specs, selected)
    grew = True
    while grew:
        grew = False
        for spec in sorted(specs, key=lambda s: tiers[s.name][0]):
            if spec.name not in env:
                continue
            fresh = [((col, parent), walk.fresh((spec.name, col, parent), parent)) for child, col, parent in edges if child == spec.name]
            fresh = [(ref, ids) for ref, ids in fresh if ids is not None]
            if not fresh:
                continue
            rows = env[spec.name].where(spec.filter) if spec.filter else env[spec.name]
            found = reduce(DataFrame.union, [_below(rows, spec.id_col, col, ids) for (col, _), ids in fresh])
            grew = walk.add(spec.name, found.select("id"), "down") or grew
    return walk.selection()


def walk_up(env: Env, specs: Sequence[TableSpec], selected: Selection, grow: bool = True) -> Selection:
    """Add the rows that the selected ones refer to, to a fixpoint.

    Children come before their parents, so without cycles one sweep closes the selection. A sweep reads a table once, and of it only the
    rows selected since it was read last. ``grow=False`` leaves tables alone that already have selected rows, as the way down found them.
    """
    tiers, edges, walk = table_tiers(specs), _edges(specs), _Closure(env, specs, selected)
    fixed = set(selected) if not grow else set()
    grew = True
    while grew:
        grew = False
        for spec in sorted(specs, key=lambda s: -tiers[s.name][0]):
            refs = [(col, parent) for child, col, parent in edges if child == spec.name and parent not in fixed and parent in env]
            fresh = walk.fresh((spec.name,), spec.name) if refs and spec.name in env else None
            if fresh is None:
                continue
            rows = _among(env[spec.name], spec.id_col, fresh)
            found = materialise(rows.select(_targets(refs).alias("r")).select("r.parent", "r.value").distinct(), f"refers-{spec.name}")
            for parent in dict.fromkeys(p for _, p in refs):
                ids = found.where(F.col("parent") == parent).select(F.col("value").alias("id"))
                grew = walk.add(parent, ids, "up") or grew
    return walk.selection()


def select_related(env: Env, specs: Sequence[TableSpec], root: str, values: Sequence | DataFrame,
                   match_by: str = "name", grow: bool = True) -> Selection:
    """Root rows, everything below them, and everything those rows refer to."""
    named = by_name(specs)
    if root not in named:
        raise ValueError(f"root table {root} is not among {sorted(named)}")
    roots = root_ids(env, named[root], values, match_by)
    return walk_up(env, specs, walk_down(env, specs, {root: roots}), grow)


def subset(env: Env, specs: Sequence[TableSpec], root: str, values: Sequence | DataFrame,
           match_by: str = "name", grow: bool = True) -> dict[str, DataFrame]:
    """The environment reduced to the related rows.

    Tables without related rows go away; tables that only serve to resolve references stay whole.
    """
    chosen = select_related(env, specs, root, values, match_by, grow)
    out = {}
    for spec in specs:
        if spec.resolve_only:
            out[spec.name] = env[spec.name]
        elif spec.name in chosen:
            out[spec.name] = _among(env[spec.name], spec.id_col, chosen[spec.name])
    return out


class PortableKeys(dict):
    """Per table (column, values) that pick its related rows; ``rest`` has the same for rows whose column is empty, further columns in turn."""

    def __init__(self):
        super().__init__()
        self.rest: dict[str, list[tuple[str, DataFrame]]] = {}


def portable_keys(env: Env, specs: Sequence[TableSpec], root: str, values: Sequence | DataFrame,
                  match_by: str = "name", grow: bool = True) -> PortableKeys:
    """Per table the column, and its values, that pick the related rows in another environment.

    The root goes by name. Other tables go by key unless it is automatically numbered or empty
    throughout, then by name, then by id; single rows without a value there go by the next of these columns that they have.
    """
    chosen = select_related(env, specs, root, values, match_by, grow)
    out = PortableKeys()
    for spec in specs:
        if spec.resolve_only or spec.name not in chosen:
            continue
        key = spec.key if spec.key and not spec.auto_number_key and spec.name != root else None
        columns = list(dict.fromkeys(c for c in (key, spec.name_col, spec.id_col) if c))
        rows, seen = materialise_counted(
            _among(env[spec.name].select(*columns), spec.id_col, chosen[spec.name]),
            f"portable-{spec.name}", **{f"n{i}": F.count_if(has_key(c)) for i, c in enumerate(columns)})
        best = next(i for i, c in enumerate(columns) if seen[f"n{i}"] or c == spec.id_col)
        picks = lambda df, c: df.where(has_key(c)).select(c).distinct()
        out[spec.name] = (columns[best], picks(rows, columns[best]))
        left = rows if seen[f"n{best}"] < seen["rows"] else None
        for i, c in enumerate(columns[best + 1:], best + 1):
            if left is not None:
                left = left.where(~has_key(columns[i - 1]))
                out.rest.setdefault(spec.name, []).append((c, picks(left, c)))
    return out


def restrict(env: Env, specs: Sequence[TableSpec], keys: Mapping[str, tuple[str, DataFrame]]) -> dict[str, DataFrame]:
    """Apply portable keys to an environment."""
    out = {}
    for spec in specs:
        if spec.name not in env:
            continue
        if spec.resolve_only:
            out[spec.name] = env[spec.name]
        elif spec.name in keys:
            column, values = keys[spec.name]
            found, left = in_list(env[spec.name], column, values), env[spec.name]
            for further, more in getattr(keys, "rest", {}).get(spec.name, ()):
                left = left.where(~has_key(column))
                found, column = found.unionByName(in_list(left, further, more)), further
            out[spec.name] = found
    return out


def subset_portable(src_env: Env, tgt_env: Env, specs: Sequence[TableSpec], root: str,
                    values: Sequence | DataFrame, match_by: str = "name") -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """The same subset, chosen in the source, of both environments."""
    keys = portable_keys(src_env, specs, root, values, match_by)
    return restrict(src_env, specs, keys), restrict(tgt_env, specs, keys)


__all__ = ["Selection", "portable_keys", "restrict", "root_ids", "select_related", "subset",
           "subset_portable", "walk_down", "walk_up"]
