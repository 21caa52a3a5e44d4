"""Bundle to target environment."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsync.functions import not_blank
from tabsync.functions.text import needs_mask
from tabsync.operators import clean, crosswalk
from tabsync.operators import load as write
from tabsync.operators.log import LOG_SCHEMA, load_summary
from tabsync.operators.lookup import only_read
from tabsync.plans.export import Bundle, read_bundle_table
from tabsync.sinks.bundle import write_results
from tabsync.spec import Env, FieldMeta, TableSpec, by_name
from tabsync.storage import materialise, materialise_counted, new_path, side_by_side, small_frame

#: Adds an ``errors`` array to the rows of a table that the target would refuse.
Checker = Callable[[DataFrame, TableSpec, int], DataFrame]
SAVED = ("log", "xwalk", "key_xwalk", "counters")
COUNTER_SCHEMA = "order int, table string, counter string, n bigint"
#: What the journal holds of an accepted step; paths are null where there is nothing.
STEP_SCHEMA = (f"seq int, kind string, {LOG_SCHEMA}, first_pass boolean, flagged boolean, changes string, rejected string, "
               "held string, matched string, stripped array<string>, counters map<string, bigint>")


@dataclass
class LoadResult:
    """State of the target after a load, and everything needed to undo it.

    ``loaded`` has one frame per table, because prior images have the table's columns. ``counters`` has what every step counted
    while it wrote: rows read, repeated keys left out, masked values, references found and not found, rows inserted and updated.
    """

    env: dict[str, DataFrame]
    log: DataFrame | None = None
    loaded: dict[str, DataFrame] = field(default_factory=dict)
    rejected: dict[str, DataFrame] = field(default_factory=dict)
    xwalk: DataFrame | None = None
    key_xwalk: DataFrame | None = None
    stripped: dict[str, list[str]] = field(default_factory=dict)
    counters: DataFrame | None = None
    journal: str | None = None

    def summary(self) -> DataFrame:
        return load_summary(self.log)

    def compact(self, *tables: str) -> dict[str, DataFrame]:
        """The target with the named tables (default: all loaded ones) written whole, instead of read from change sets."""
        return {t: materialise(df, f"table-{t}") if t in (tables or self.loaded) else df for t, df in self.env.items()}

    def save(self, path: str) -> str:
        """Write everything that a rollback, or a look at what was refused, needs; not the target's tables."""
        spark = self.log.sparkSession
        parts = [("loaded", t, df) for t, df in self.loaded.items()] + [("rejected", t, df) for t, df in self.rejected.items()]
        for i, (_, _, df) in enumerate(parts):
            df.write.parquet(f"{path}/part-{i}")
        for name in SAVED:
            if (df := getattr(self, name)) is not None:
                df.write.parquet(f"{path}/{name}")
        small_frame(spark, [(i, kind, t) for i, (kind, t, _) in enumerate(parts)], "part int, kind string, table string").write.parquet(f"{path}/index")
        return path

    @classmethod
    def open(cls, spark: SparkSession, path: str, env: Env | None = None) -> LoadResult:
        """A saved load, also in a later session; ``env`` is the target as it stands now."""
        out = cls(dict(env or {}), **{name: spark.read.parquet(f"{path}/{name}") for name in SAVED})
        for r in spark.read.parquet(f"{path}/index").orderBy("part").collect():  # one line per table
            getattr(out, r["kind"])[r["table"]] = spark.read.parquet(f"{path}/part-{r['part']}")
        return out

    @classmethod
    def recover(cls, target: Env, journal: str, specs: Sequence[TableSpec]) -> LoadResult:
        """A load that stopped, from its journal, also in a later session; ``target`` is the environment as it was before the load.

        What had been accepted by then counts, as if the load had been told to stop there; a rollback undoes it.
        """
        return _Run(target, None, by_name(specs), False, {}, None, 0, None, journal).replay()


class LoadStopped(RuntimeError):
    """A step failed in stop mode. ``result`` is the load up to there, ``result.journal`` where it can be recovered from."""

    def __init__(self, message: str, result: LoadResult):
        super().__init__(message)
        self.result = result


def load_preview(spark: SparkSession, bundle: Bundle) -> DataFrame:
    """The dry run: what would be loaded, in order."""
    return bundle.manifest(spark).select("order", "tier", "table", "rows", "operation", "pass2").orderBy("tier", "order")


def load(target: Env, bundle: Bundle, specs: Sequence[TableSpec], on_error: str = "stop", mask: bool = False,
         fields: Mapping[str, Sequence[FieldMeta]] | None = None, checker: Checker | None = None,
         retries: int = 2, id_pattern: str | None = None, journal: str | None = None, results: str | None = None) -> LoadResult:
    """Load a bundle tier by tier.

    Tiers come one after the other, because later ones join the crosswalks that earlier ones
    produced; the tables of a tier are loaded side by side, each as a change set of its table. With
    ``on_error="stop"`` nothing after a table with rejected rows takes effect, and a step that breaks raises :class:`LoadStopped`;
    ``"continue"`` goes on. Every accepted step is noted in the folder ``journal`` (default: a new one below the shared folder),
    from which :meth:`LoadResult.recover` opens a load that stopped, for whatever reason. With ``results``, accepted and
    refused rows of every step are written below that folder.
    """
    run = _Run(target, bundle, by_name(specs), mask, fields or {}, checker, retries, id_pattern,
               journal or new_path(next(iter(target.values())).sparkSession, "journal"), results)
    return run.all(on_error)


@dataclass
class _Outcome:
    """What loading one folder came to, before it is made current. Frames are written, and known by their paths."""

    spec: TableSpec
    line: tuple | None = None
    changes: str | None = None
    rejected: str | None = None
    held: str | None = None
    matched: str | None = None
    stripped: Sequence[str] = ()
    first_pass: bool = True
    flagged: bool = False  # the rows brought their own active flag
    counters: Mapping[str, int] = field(default_factory=dict)
    error: Exception | None = None


#: Errors found while rows were prepared; they stay with a row through all retries.
JUDGED = ("_invalid", "_repeated")


class _Run:
    def __init__(self, target, bundle, specs, mask, fields, checker, retries, id_pattern, journal, results=None):
        self.spark = next(iter(target.values())).sparkSession
        self.bundle, self.specs, self.mask, self.fields = bundle, specs, mask, fields
        self.checker, self.retries, self.id_pattern = checker, retries, id_pattern
        self.journal, self.results, self.seq = journal, results, 0
        self.versions = {t: write.Version(df, specs[t].id_col) if t in specs else None for t, df in target.items()}
        self.env = dict(target)
        self.xwalk = crosswalk.empty_xwalk(self.spark)
        self.key_xwalk = crosswalk.empty_key_xwalk(self.spark)
        self.loaded: dict[str, list[DataFrame]] = {}
        self.rejected: dict[str, list[DataFrame]] = {}
        self.stripped: dict[str, list[str]] = {}
        self.deferred: dict[str, DataFrame] = {}
        self.flagged: dict[str, list[DataFrame]] = {}
        self.active: dict[str, DataFrame] = {}
        self.lines: list[tuple] = []
        self.counters: list[tuple] = []

    def all(self, on_error: str) -> LoadResult:
        for name in dict.fromkeys(e[4] for e, _ in self.bundle.entries):
            spec = self.specs[name]
            if spec.active_col and name in self.env:
                off, ids = write.deactivate(self.env[name], spec.active_col, spec.id_col)
                path = self.place(f"active-{name}") if ids is not None else None
                if path:
                    materialise(ids, path=path)
                    self.switch_off(spec, off, path)
        self.note("start", None, None)
        broken = None
        for step in self.steps():
            done = side_by_side(self.spark, [partial(self.attempt, entry, rows, on_error) for entry, rows in step])
            failed = False
            for outcome in done:
                broken = outcome.error
                failed = self.accept(outcome)
                if (failed and on_error == "stop") or broken:
                    break
            if (failed and on_error == "stop") or broken:
                break
        result = self.finish()
        if broken:
            raise LoadStopped(f"{self.lines[-1][1]}: {broken}", result) from broken
        return result

    def place(self, label: str) -> str:
        return f"{self.journal}/data/{label}-{uuid.uuid4().hex}"

    def note(self, kind: str, line: tuple | None, o: _Outcome | None, path: str | None = None) -> None:
        """Add a line to the journal: one small file, written when everything that it names is."""
        row = (self.seq, kind, *(line or (None,) * 7),
               *((o.first_pass, o.flagged, o.changes, o.rejected, o.held, o.matched, list(o.stripped), list(dict(o.counters).items()))
                 if o else (None, None, path, None, None, None, [], [])))
        small_frame(self.spark, [row], STEP_SCHEMA).write.parquet(f"{self.journal}/steps/{self.seq:06d}")
        self.seq += 1

    def replay(self) -> LoadResult:
        """Take every step of the journal as accepted."""
        steps = self.spark.read.schema(STEP_SCHEMA).parquet(f"{self.journal}/steps/*").orderBy("seq").collect()  # one line per step
        self.seq = len(steps)
        for r in steps:
            if r["kind"] == "active":
                spec = self.specs[r["table"]]
                self.switch_off(spec, write.deactivate(self.env[spec.name], spec.active_col, spec.id_col)[0], r["changes"], again=True)
            elif r["kind"] == "step":
                line = tuple(r[c] for c in ("order", "table", "key_field", "submitted", "succeeded", "failed", "status"))
                self.apply_step(_Outcome(self.specs[r["table"]], line, r["changes"], r["rejected"], r["held"], r["matched"], r["stripped"],
                                         r["first_pass"], r["flagged"], dict(r["counters"])))
        return self.finish()

    def switch_off(self, spec: TableSpec, off: DataFrame, path: str, again: bool = False) -> None:
        self.env[spec.name] = off
        self.versions[spec.name] = write.Version(off, spec.id_col)
        self.active[spec.name] = self.spark.read.parquet(path)
        if not again:
            self.note("active", (None, spec.name, *(None,) * 5), None, path)

    def finish(self) -> LoadResult:
        """Held back values and flags come back, and the parts become a result."""
        for name, held in self.deferred.items():
            spec = self.specs[name]
            cols = [c for c in spec.deferred if c and c in self.env[name].columns]
            moved = self.key_xwalk.where(F.col("table") == name)
            # Rows that the target refused leave nothing behind.
            taken = clean.union_results(self.loaded[name]).select(F.coalesce("source_key", "target_key").alias("_taken"))
            held = held.join(taken, F.col("key") == F.col("_taken"), "left_semi")
            self.env[name] = clean.restore_deferred(self.env[name], held, spec.key, cols, moved)
        for name, ids in self.active.items():
            spec = self.specs[name]
            own = self.flagged.get(name)  # a flag that came with the rows counts
            left = write.without_given(ids, clean.union_results(own)) if own else ids
            self.env[name] = write.reactivate(self.env[name], left, spec.active_col, spec.id_col)
            self.loaded[name] = [write.flag_before(f, ids, spec.active_col) for f in self.loaded.get(name, [])]
        self.loaded = {t: fs for t, fs in self.loaded.items() if fs}
        return LoadResult(
            self.env, small_frame(self.spark, self.lines, LOG_SCHEMA),
            {t: clean.union_results(fs) for t, fs in self.loaded.items()},
            {t: clean.union_results(fs) for t, fs in self.rejected.items()},
            self.xwalk, self.key_xwalk, self.stripped, small_frame(self.spark, self.counters, COUNTER_SCHEMA), self.journal)

    def steps(self) -> list[list[tuple[tuple, int]]]:
        """Entries that may be loaded at the same time: the tables of a tier, then its second passes."""
        groups: dict[tuple, list] = {}
        for entry, rows in self.bundle.entries:
            _, tier, order, _, _, _, _, pass2, _ = entry
            groups.setdefault((tier, order if pass2 else 0), []).append((entry, rows))
        return [groups[k] for k in sorted(groups)]

    def attempt(self, entry: tuple, rows: int, on_error: str) -> _Outcome:
        _, _, order, path, name, _, _, pass2, _ = entry
        spec = self.specs[name]
        try:
            return self.table(spec, order, path, pass2)
        except Exception as e:  # noqa: BLE001 - the tables beside it may have been loaded, and are noted before it is raised
            going_on = on_error != "stop" and isinstance(e, PySparkException)
            return _Outcome(spec, (order, name, spec.key, rows, 0, rows, "failed"), first_pass=not pass2, error=None if going_on else e)

    def accept(self, o: _Outcome) -> bool:
        """Note a step and make its result current; True when rows were rejected.

        A table after a failed one is never accepted in stop mode, even if it was written.
        """
        self.note("step", o.line, o)
        self.apply_step(o)
        if self.results and o.changes:
            done = self.spark.read.parquet(o.changes).select(F.col(o.spec.id_col).cast("string").alias("target_id"), "_source_id", "_op")
            bad = self.spark.read.parquet(o.rejected) if o.rejected else done.where("false").withColumn("error", F.lit(None).cast("string"))
            shown = [c for c in ("_source_id", "error") if c in bad.columns]
            write_results(done, bad.select(*[F.col(c).cast("string").alias(c) for c in shown]), o.spec.name, self.results)
        return o.line[5] > 0 or o.line[6] == "failed"

    def apply_step(self, o: _Outcome) -> None:
        name, order = o.spec.name, o.line[0]
        self.counters += [(order, name, c, n) for c, n in o.counters.items()]
        if o.matched is not None:
            self.xwalk = self.xwalk.unionByName(self.spark.read.parquet(o.matched))
            return
        self.lines.append(o.line)
        if o.rejected is not None:
            self.rejected.setdefault(name, []).append(self.spark.read.parquet(o.rejected))
        if o.changes is not None:
            changes = self.spark.read.parquet(o.changes)
            done = write.loaded_rows(changes, order, name, o.spec.id_col, o.spec.key)
            self.versions[name] = self.versions[name].add(changes)
            self.env[name] = self.versions[name].read()
            self.loaded.setdefault(name, []).append(done)
            self.stripped.setdefault(name, []).extend(o.stripped)
            if o.flagged:
                self.flagged.setdefault(name, []).append(done)
            if o.held is not None:
                self.deferred[name] = self.spark.read.parquet(o.held)
            if o.first_pass:
                self.xwalk = self.xwalk.unionByName(
                    crosswalk.id_xwalk(done.where(F.col("source_id").isNotNull()), name))
                if o.spec.auto_number_key:
                    self.key_xwalk = self.key_xwalk.unionByName(crosswalk.key_xwalk(done, name, o.spec.key))

    def table(self, spec: TableSpec, order: int, path: str, pass2: bool) -> _Outcome:
        """Load one folder of the bundle: its change set, and what was refused.

        The folder is read once, into resolved rows, and the write counts all that the steps behind it decide by.
        """
        rows = read_bundle_table(self.spark, self.bundle, path, spec, self.specs)
        target = self.env[spec.name]
        if spec.match_on_name:
            return self.match(rows, spec, order)
        bound = spec.in_pass(pass2)
        rows, stripped, counts, once = self.prepare(rows, bound, target, pass2)
        held = None
        if spec.deferred and not pass2 and spec.deferred[0] in rows.columns:  # repeated keys are gone by now
            key = "_source_key" if spec.auto_number_key else spec.key
            rows, kept = clean.defer_values(rows, spec.name, key, spec.deferred[0], spec.deferred[1])
            held = self.place(f"deferred-{spec.name}")
            materialise(kept, path=held)
        judged = self.judge(rows, bound, 0, once)
        refused = F.count_if(F.size("errors") > 0)
        # Rows that are judged where they lie are only written when some are refused.
        seen = judged.agg(F.count(F.lit(1)).alias("rows"), refused.alias("refused")).first().asDict() if self.in_place(rows, judged) else None
        if not seen or seen["refused"]:
            judged, seen = materialise_counted(judged, f"judged-{spec.name}", refused=refused)
        submitted, refused, rejected = seen["rows"], seen["refused"], None
        counts |= {"repeated_keys": counts["read"] - submitted}
        ok, bad = self.split(judged, spec)
        if refused:
            again, bad, tally = write.retry_rejects(bad, lambda df, n: self.split(self.judge(df, bound, n, once), spec),
                                                    attempts=self.retries, bookkeeping=("error", "retryable"))
            if again is not None:
                ok = clean.union_results([ok, again])
            refused = tally["failed"]
            counts |= {"retried": tally["retried"], "recovered": tally["recovered"]}
            rejected = self.place(f"rejected-{spec.name}")
            materialise(bad.drop(*JUDGED).withColumn("table", F.lit(spec.name)), path=rejected)
        changes = self.place(f"changes-{spec.name}")
        _, wrote = materialise_counted(self.changes(target, ok, spec, pass2), path=changes, inserted=F.count_if(F.col("_op") == "insert"),
                                       updated=F.count_if(F.col("_op") == "update"))
        counts |= {"inserted": wrote["inserted"], "updated": wrote["updated"]}
        line = (order, spec.name, spec.key, submitted, submitted - refused, refused, "partial" if refused else "success")
        return _Outcome(spec, line, changes, rejected, held, None, stripped, not pass2, spec.active_col in ok.columns, counts)

    def match(self, rows: DataFrame, spec: TableSpec, order: int) -> _Outcome:
        found = crosswalk.match_by_name(rows, self.env[spec.name], spec.name_col, "_source_id", spec.id_col)
        path = self.place(f"matched-{spec.name}")
        found, seen = materialise_counted(found, path=path, matched=F.count_if(F.col("target_id").isNotNull()))
        pairs = self.place(f"pairs-{spec.name}")
        materialise(found.where(F.col("target_id").isNotNull()).select(F.lit(spec.name).alias("table"), "source_id", "target_id"), path=pairs)
        counts = {"read": seen["rows"], "matched": seen["matched"], "unmatched": seen["rows"] - seen["matched"]}
        return _Outcome(spec, (order, spec.name, spec.key, 0, 0, 0, "matched"), matched=pairs, counters=counts)

    def prepare(self, rows: DataFrame, spec: TableSpec, target: DataFrame, pass2: bool) -> tuple[DataFrame, list[str], dict[str, int], bool]:
        """Source rows in the shape the target takes, the columns left out, counters, and whether no key is left twice; the order of the steps matters."""
        if spec.id_col != spec.key:
            rows = rows.drop(spec.id_col)
        rows, marks = crosswalk.mark_raw_refs(crosswalk.rewrite_keys(rows, spec, self.key_xwalk), spec, self.xwalk, self.id_pattern)
        metas = self.fields.get(spec.name) or [
            FieldMeta(spec.name, f.name, "reference" if f.name in {r.col for r in spec.refs} else f.dataType.simpleString(),
                      nullable=True) for f in target.schema.fields]
        keys = [r.key_col for r in spec.refs if r.key_col in rows.columns]
        emails = clean.email_candidates(rows, metas) if self.mask and not pass2 else []
        rows, seen = materialise_counted(
            rows, f"resolved-{spec.name}", drop=[n for names in marks.values() for n in names],
            **{f"{kind}{i}": F.count_if(name) for i, names in enumerate(marks.values()) for kind, name in zip(("hit", "miss"), names)},
            **{f"key{i}": F.count_if(not_blank(c)) for i, c in enumerate(keys)},
            **{f"{kind}{i}": a for i, (_, _, n, e) in enumerate(emails) for kind, a in (("text", n), ("email", e))},
            **{f"mask{i}": F.count_if(needs_mask(c)) for i, (c, *_) in enumerate(emails)})
        resolved = [c for i, c in enumerate(marks) if seen[f"hit{i}"]]
        counts = {"read": seen["rows"], "references_found": sum(seen[f"hit{i}"] for i in range(len(marks))),
                  "references_missed": sum(seen[f"miss{i}"] for i in range(len(marks)))}
        gone = clean.columns_to_strip(rows.columns, metas, spec, resolved, [c for i, c in enumerate(keys) if seen[f"key{i}"]])
        rows = rows.drop(*gone)
        order = [c for c in spec.order_cols if c in rows.columns] or \
            ["_source_id" if "_source_id" in rows.columns else spec.key]
        if spec.auto_number_key:
            moved = self.key_xwalk.where(F.col("table") == spec.name)
            kept = rows.withColumn("_source_key", F.col(spec.key).cast("string"))
            rows = crosswalk.map_to_target_ids(kept, target, spec.key, spec.id_col, moved).drop("op")
            order = [c for c in order if c in rows.columns and c != spec.id_col]
            order += [c for c in ("_source_id",) if c in rows.columns and c not in order]
            rows = crosswalk.mark_repeated(rows, spec.id_col, order or ["_source_key"], spec.key)
        elif spec.key:
            rows = clean.dedupe_keep_last(rows, spec.key, order, spec.id_col)
        chosen = [(i, c) for i, (c, reason, _, _) in enumerate(emails) if c in rows.columns and (reason != "pattern" or seen[f"email{i}"] * 2 > seen[f"text{i}"])]
        counts["masked"] = sum(seen[f"mask{i}"] for i, _ in chosen)
        # A repeated key was dropped, unless masking or another type makes two keys one.
        once = bool(spec.key) and spec.key != spec.id_col and not spec.auto_number_key and spec.key in target.columns \
            and rows.schema[spec.key].dataType == target.schema[spec.key].dataType and spec.key not in [c for _, c in chosen]
        return write.conform(clean.masked(rows, [c for _, c in chosen]), target.schema), gone, counts, once

    def judge(self, rows: DataFrame, spec: TableSpec, attempt: int, once: bool = False) -> DataFrame:
        """Rows with foreign keys filled in and ``errors`` for what the target would refuse; with ``once`` no key is looked for twice."""
        bound = write.bind_parents(rows, spec, self.env, self.specs)
        metas = [f for f in self.fields.get(spec.name, ()) if f.name in rows.columns]
        judged = clean.check_rows(bound, metas, spec.with_(refs=(), key=None if once else spec.key))
        found = [c for c in JUDGED if c in judged.columns]
        judged = judged.withColumn("errors", F.concat("errors", "_unbound", *found)).drop("_unbound")
        return self.checker(judged, spec, attempt) if self.checker else judged

    def in_place(self, rows: DataFrame, judged: DataFrame) -> bool:
        """Whether the rows come straight from the resolved ones and meet their parents without moving; a checker may cost anything."""
        if self.checker or not only_read(rows):
            return False
        steps = judged._jdf.queryExecution().executedPlan().toString()
        return "SortMergeJoin" not in steps and "ShuffledHashJoin" not in steps

    def split(self, judged: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
        good, bad = clean.split_checked(judged)
        return good, bad.withColumn("error", F.array_join("errors", "; ")).drop("errors")

    def changes(self, target: DataFrame, rows: DataFrame, spec: TableSpec, pass2: bool) -> DataFrame:
        """Change set of a table's rows."""
        rows = rows.drop(*[r.key_col for r in spec.refs], *JUDGED)

        def put(into: DataFrame, part: DataFrame) -> DataFrame:
            if spec.auto_number_key:
                if pass2:  # never adds rows
                    return write.updated_rows(into, part.where(F.col(spec.id_col).isNotNull()), spec.id_col)
                return write.upserted_rows_by_id(into, part, spec.id_col, ["_source_id"], spec.key)
            if not spec.key:
                return write.insert(into, part, spec.id_col, ["_source_id"])
            if pass2:
                return write.updated_rows(into, part, spec.key)
            if spec.key == spec.id_col:
                return write.updated_rows(into, part, spec.key).unionByName(_new_rows(into, part, spec.key))
            order = ["_source_id"] if "_source_id" in part.columns else [spec.key]
            return write.upserted_rows(into, part, spec.key, spec.id_col, order)

        if spec.load_first and not pass2:
            fk, flag = spec.load_first
            parent = next(self.specs[t] for r in spec.refs if r.col == fk for t in r.to)
            first = self.env[parent.name].where(F.col(flag)).select(parent.id_col)
            return write.in_two_batches(target, rows, spec.id_col, fk, first, None, put)
        return put(target, rows)


def _new_rows(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Rows whose id is their key and not in the target yet; they keep it."""
    known = target.select(F.col(key).alias("_known"))
    new = batch.join(known, F.col(key) == F.col("_known"), "left_anti")
    kind = target.schema
    null = F.lit(None).cast("string")
    trace = F.col("_source_id").cast("string") if "_source_id" in new.columns else null
    return new.select(*[(F.col(f.name) if f.name in new.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                        for f in kind.fields],
                      F.lit("insert").alias("_op"), trace.alias("_source_id"),
                      F.col(key).cast("string").alias("_source_key"), F.lit(None).cast(kind).alias("_prior"))
