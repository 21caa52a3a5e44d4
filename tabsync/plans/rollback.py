"""Taking a load back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tabsync.operators.log import rollback_plan, undo
from tabsync.plans.load import LoadResult
from tabsync.spec import Env, TableSpec, by_name


def rollback(target: Env, result: LoadResult, specs: Sequence[TableSpec],
             dry_run: bool = False) -> tuple[dict[str, DataFrame], DataFrame | None]:
    """Undo a load, latest table first; (environment, report).

    A dry run returns the environment as it is and the plan as report.
    """
    steps = rollback_plan(result.log)
    if dry_run:
        return dict(target), steps
    order = [r["table"] for r in steps.collect()]  # one line per table
    return undo(target, result.loaded, by_name(specs), order)
