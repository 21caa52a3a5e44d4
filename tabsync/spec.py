"""What a caller says about a table that its Spark schema cannot say.

A list of :class:`TableSpec` is the whole configuration of a run. These objects live on the driver;
their number is the number of tables and columns, never the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

#: One environment: table name -> DataFrame.
Env = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Ref:
    """A foreign key column and the table(s) it may point to, tried in order."""

    col: str
    to: tuple[str, ...]
    rel: str | None = None

    def __post_init__(self):
        if isinstance(self.to, str):
            object.__setattr__(self, "to", (self.to,))

    @property
    def relationship(self) -> str:
        """Name of the relationship; derived from the column when not given."""
        if self.rel:
            return self.rel
        if self.col.endswith("__c"):
            return self.col[:-3] + "__r"
        if self.col.endswith("Id") and len(self.col) > 2:
            return self.col[:-2]
        return self.col + "_rel"

    @property
    def key_col(self) -> str:
        """Column that carries the parent's business key after resolution."""
        return f"{self.relationship}__key"


@dataclass(frozen=True)
class FieldMeta:
    """Flags of one column of a table in one environment."""

    table: str
    name: str
    type: str = "string"
    reference_to: tuple[str, ...] = ()
    relationship: str | None = None
    is_key: bool = False
    nullable: bool = True
    createable: bool = True
    updateable: bool = True
    calculated: bool = False
    auto_number: bool = False
    defaulted: bool = False
    length: int = 0

    @property
    def is_reference(self) -> bool:
        return self.type == "reference" or bool(self.reference_to)


@dataclass(frozen=True)
class TableSpec:
    """How one table takes part in a migration.

    ``order_cols`` must order the rows of a table totally wherever "the last row wins".
    ``deferred`` is a (condition column, paired column or None) pair that is loaded with a
    provisional value and restored at the end. ``match_on_name`` tables are never written, only
    matched; ``load_first`` names the foreign key and the flag of its parent whose rows go first.
    """

    name: str
    id_col: str = "Id"
    key: str | None = None
    composite_key: tuple[str, ...] = ()
    refs: tuple[Ref, ...] = ()
    filter: str | None = None
    include: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()
    compare_ignore: tuple[str, ...] = ()
    auto_number_key: bool = False
    resolve_only: bool = False
    active_col: str | None = None
    order_cols: tuple[str, ...] = ()
    name_col: str | None = None
    self_refs: str = "two-pass"
    deferred: tuple[str, str | None] | None = None
    match_on_name: bool = False
    load_first: tuple[str, str] | None = None

    @property
    def parent_refs(self) -> tuple[Ref, ...]:
        """References that may lead to another table; excluded columns make no reference."""
        return tuple(r for r in self.refs if not self.is_self(r) and r.col not in self.exclude)

    @property
    def self_references(self) -> tuple[Ref, ...]:
        """References that may lead to the table itself, beside others or alone."""
        return tuple(r for r in self.refs if self.name in r.to and r.col not in self.exclude)

    def is_self(self, ref: Ref) -> bool:
        """Whether a reference leads nowhere but to the table itself."""
        return set(ref.to) == {self.name}

    def in_pass(self, second: bool) -> TableSpec:
        """References as they are bound in one of the passes of a load: to other tables first, to the table itself in the second."""
        refs = [replace(r, to=tuple(t for t in r.to if (t == self.name) == second)) for r in self.refs if not second or self.name in r.to]
        return replace(self, refs=tuple(r for r in refs if r.to))

    def ordering(self) -> tuple[str, ...]:
        return self.order_cols or (self.id_col,)

    def with_(self, **changes) -> TableSpec:
        return replace(self, **changes)


def by_name(specs: Iterable[TableSpec]) -> dict[str, TableSpec]:
    return {s.name: s for s in specs}


def spec_edges(specs: Sequence[TableSpec]) -> list[tuple[str, str]]:
    """Distinct (child, parent) pairs of the tables in scope, without self references."""
    scope = {s.name for s in specs}
    return sorted({(s.name, p) for s in specs for r in s.parent_refs for p in r.to
                   if p in scope and p != s.name})


def table_tiers(specs: Sequence[TableSpec]) -> dict[str, tuple[int, bool]]:
    """Load tier and cycle flag of every table of a run.

    This orders the steps of a run and so happens before any data is read. Graphs whose size
    depends on data go through :func:`tabsync.operators.graph.dependency_tiers`.
    """
    parents: dict[str, set[str]] = {s.name: set() for s in specs}
    for child, parent in spec_edges(specs):
        parents[child].add(parent)
    placed: dict[str, tuple[int, bool]] = {}
    level = 0
    while len(placed) < len(parents):
        ready = [t for t, ps in parents.items() if t not in placed and ps <= placed.keys()]
        stuck = not ready
        for t in ready or [t for t in parents if t not in placed]:
            placed[t] = (level, stuck)
        level += 1
    return placed


def load_order(specs: Sequence[TableSpec]) -> list[TableSpec]:
    """Specs by (tier, name)."""
    tiers = table_tiers(specs)
    return sorted(specs, key=lambda s: (tiers[s.name][0], s.name))
