"""Running many specs: sources to targets, rejected rows and a log, in dependency order."""

from __future__ import annotations

import time
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import Future, ThreadPoolExecutor, as_completed
from datetime import datetime, timezone
from functools import reduce
from itertools import groupby

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.plans.table_plan import Planned, outcome, plan, source_kind
from millrace.session import durable
from millrace.sources.raw import capture_raw
from millrace.sources.readers import unite_farms
from millrace.sources.sinks import LOG_SCHEMA, TargetStore
from millrace.spec import Reference, TableSpec, select_specs

# target, name of the derived source, rows given a reader of this run's targets and of source tables
Derivation = tuple[str, str, int, Callable[["Load"], DataFrame | None]]


class Load:
    """What a run has loaded so far: targets by name, and access to sources."""

    def __init__(self, source, farms: Sequence[str] | None, store: TargetStore | None):
        self.source, self.farms, self.store = source, farms, store
        self.runs: dict[tuple[str, str], int] = dict(store.current_runs()) if store else {}
        self.earlier = dict(self.runs)
        self.planned: dict[str, list[DataFrame]] = defaultdict(list)
        self.fresh: set[tuple[str, str]] = set()
        self.asked: set[str] = set()

    def table(self, name: str, group: str = "main", kind_for: Callable[[str], str | None] | None = None) -> DataFrame | None:
        """A source table, over all farms when the run has several; None where it is absent everywhere.

        `kind_for` says what columns are that farms store differently.
        """
        if not self.farms:
            return self.source.read(name, group)
        found = {farm: self.source.read(name, group, farm) for farm in self.farms}
        present = {farm: df for farm, df in found.items() if df is not None}
        return unite_farms(present, kind_for) if present else None

    def target(self, name: str) -> DataFrame | None:
        """A target as loaded by this run, or by earlier ones where this run did not touch it."""
        self.asked.add(name)
        if self.planned.get(name):
            return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), self.planned[name])
        return self.store.read(name, self.runs) if self.store else None

    def loaded(self) -> set[str]:
        """Targets that this run has put rows into; staged ones also by the name they are read under."""
        return {name for _, name in self.fresh} | set(self.planned)

    def held(self, name: str) -> DataFrame | None:
        """Rows this run has already put into a target."""
        if self.store is None:
            return self.target(name)
        runs = {key: run for key, run in self.runs.items() if key in self.fresh and key[1] == name}
        return self.store.read(name, runs) if runs else None

    def before(self, name: str) -> DataFrame | None:
        return self.store.read(name, self.earlier) if self.store else None


def _log_row(run_id: int, source: str, target: str, started: datetime, farm: str, **values) -> tuple:
    row = {f.name: None for f in LOG_SCHEMA.fields} | {
        "run_id": run_id,
        "farm": farm,
        "source_table": source,
        "target_table": target,
        "started_at": started,
        "completed_at": datetime.now(timezone.utc),
    }
    row |= values
    return tuple(row[f.name] for f in LOG_SCHEMA.fields)


def chains(specs: Sequence[TableSpec]) -> list[list[int]]:
    """Specs of one order as numbers, in chains that do not depend on each other: sources of one target, and specs that refer
    to a target of their own order, follow one another as they are listed."""
    chain = list(range(len(specs)))
    for i, spec in enumerate(specs):
        needs = {spec.stored_as, *(r.target for r in spec.references)}
        for j in range(i):
            if needs & {specs[j].stored_as, specs[j].target}:
                chain = [chain[j] if c == chain[i] else c for c in chain]
    found: dict[int, list[int]] = {}
    for i, c in enumerate(chain):
        found.setdefault(c, []).append(i)
    return list(found.values())


def _outcomes(
    spark: SparkSession, work: Sequence[Sequence[tuple[int, Callable[[], tuple | None]]]], parallel: int
) -> Iterator[tuple[int, tuple | None]]:
    """(number, outcome) of chains of steps as each is done; chains run side by side, the steps of one after each other."""
    if parallel <= 1 or len(work) <= 1:
        yield from ((i, step()) for chain in work for i, step in chain)
        return
    with ThreadPoolExecutor(min(parallel, len(work))) as pool:
        waiting: dict[Future, tuple[int, Sequence]] = {}

        def start(chain: Sequence) -> None:
            if chain:
                (number, step), *rest = chain
                waiting[pool.submit(inheritable_thread_target(spark)(step))] = (number, rest)

        for chain in work:
            start(chain)
        while waiting:
            done = next(as_completed(list(waiting)))
            number, rest = waiting.pop(done)
            yield number, done.result()
            start(rest)


def run(
    spark: SparkSession,
    specs: Iterable[TableSpec],
    source,
    store: TargetStore,
    farms: Sequence[str] | None = None,
    tables: Iterable[str] | None = None,
    dry_run: bool = False,
    shared: Sequence[Reference] = (),
    schemas: Mapping[str, T.StructType] | None = None,
    derivations: Sequence[Derivation] = (),
    raw_tables: Sequence[str] = (),
    run_id: int | None = None,
    parallel: int = 4,
) -> DataFrame:
    """Load every spec and return the log, one row per (source, target).

    Up to `parallel` specs of one order are loaded side by side; orders, and derivations, follow one another. The log is the
    same as of a run one by one. A dry run plans and counts the same rows but writes no target, no raw table and no log.
    """
    specs = list(specs)
    chosen = select_specs(specs, tables)
    run_id = run_id or int(time.time() * 1000)
    load = Load(source, farms, None if dry_run else store)
    order_of = defaultdict(int)
    for spec in specs:
        order_of[spec.target] = max(order_of[spec.target], spec.order)
    farm_text = ",".join(farms) if farms else None
    rows: list[tuple] = []

    def logged(name: str, target: str, work: Callable[[], dict | None]) -> tuple | None:
        started = datetime.now(timezone.utc)
        try:
            values = work()
        except Exception as error:  # noqa: BLE001  one table's failure is logged whole and leaves the others alone
            values = {"status": "failed", "error_details": str(error)}
        return None if values is None else _log_row(run_id, name, target, started, farm_text, **values)

    def loaded(spec: TableSpec) -> tuple | None:
        usable = [r for r in shared if order_of.get(r.target, spec.order) < spec.order]
        return logged(spec.source, spec.stored_as, lambda: _load_one(load, spec, usable, (schemas or {}).get(spec.target), run_id))

    def kept(outcomes: Iterable[tuple[int, tuple | None]]) -> None:
        """Log rows, written one at a time as steps are done; put in the order of the steps."""
        found = {}
        for number, row in outcomes:
            if row is not None:
                found[number] = row
                if not dry_run:
                    _append(spark, store, row)
        rows.extend(found[number] for number in sorted(found))

    steps = sorted([(s.order, 0, s) for s in chosen] + [(d[2], 1, d) for d in derivations], key=lambda step: step[:2])
    for (_, is_derivation), group in groupby(steps, key=lambda step: step[:2]):
        found = [step for _, _, step in group]
        if is_derivation:
            one_by_one = ((i, logged(d[1], d[0], lambda: _derive(load, d, run_id, tables is not None))) for i, d in enumerate(found))  # noqa: B023
            kept(one_by_one)
        else:
            kept(_outcomes(spark, [[(i, lambda s=found[i]: loaded(s)) for i in chain] for chain in chains(found)], parallel))
    wanted = None if tables is None else {x.lower() for x in tables}
    raw = [t for t in raw_tables if wanted is None or t.lower() in wanted]
    work = [[(i, lambda t=t: logged(t, "raw", lambda: _capture(load, t, None if dry_run else store, run_id)))] for i, t in enumerate(raw)]
    kept(_outcomes(spark, work, parallel))
    return spark.createDataFrame(rows, LOG_SCHEMA)


def _capture(load: Load, name: str, store: TargetStore | None, run_id: int) -> dict | None:
    df = load.table(name)
    if df is None:
        return None
    written = read = df.count()
    if store is not None:
        store.write_raw(capture_raw(df, name), name, run_id)
        written = store.raw(name, run_id).count()
    return {"status": "completed", "rows_read": read, "rows_written": written}


def _append(spark: SparkSession, store: TargetStore, row: tuple) -> None:
    """Append a log row as soon as its step is done; its table becomes the current one with that."""
    store.append_log(spark.createDataFrame([row], LOG_SCHEMA).coalesce(1))


def _load_one(load: Load, spec: TableSpec, shared: Sequence[Reference], declared, run_id: int) -> dict | None:
    source = load.table(spec.source, spec.database, lambda column: source_kind(spec, declared, column))
    if source is None:
        # the target keeps what it had
        return {"status": "absent"}
    planned = plan(
        spec,
        source,
        reader=load.target,
        shared=shared,
        declared=declared,
        held=load.held(spec.stored_as) if spec.unique else None,
        before=load.before(spec.stored_as) if spec.surrogate else None,
    )
    read = planned.source.count()
    if load.store is None:
        # plans that use this target start from its rows, not from its plan
        planned.frame = durable(planned.frame)
        counts = outcome(planned.frame).first()
        load.planned[spec.stored_as].append(planned.good)
    else:
        written = load.store.write(planned.frame, spec.stored_as, spec.source, run_id, spec.years)
        counts = outcome(written).first()
        load.runs[(spec.source, spec.stored_as)] = run_id
        load.fresh.add((spec.source, spec.stored_as))
    values = {name: int(counts[name]) for name in counts.asDict()}
    deduped = _dropped_by_latest(planned, spec)
    return {
        "status": "completed",
        "rows_read": read,
        "rows_deduped": deduped,
        "missing_columns": ",".join(planned.missing) or None,
        **values,
    }


def _dropped_by_latest(planned: Planned, spec: TableSpec) -> int:
    """Rows a newest-per-key spec leaves behind, counted on the source and not derived from the other counts."""
    if not spec.latest:
        return 0
    df = planned.source
    keys = [*(["farm"] if "farm" in df.columns else []), *spec.latest.key]
    excess = df.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)))
    return int(excess.first()[0])


def _derive(load: Load, step: Derivation, run_id: int, selected: bool = False) -> dict | None:
    """Rows of a derivation; in a run of selected tables only where one of its inputs was loaded anew."""
    target, name, _, build = step
    load.asked.clear()
    df = build(load)
    if df is None or (selected and not load.asked & load.loaded()):
        return None
    if load.store is None:
        df = durable(df)
        load.planned[target].append(df)
        written = df.count()
    else:
        load.store.write_extra(df, target, name, run_id)
        load.runs[(name, target)] = run_id
        load.fresh.add((name, target))
        written = load.store.read(target, {(name, target): run_id}).count()
    return {"status": "completed", "rows_read": written, "rows_written": written}


def summary(log: DataFrame) -> DataFrame:
    """Newest log row per (source, target), counted by status, with the last completion."""
    newest = log.groupBy("source_table", "target_table").agg(
        F.max_by(F.struct("status", "completed_at"), "run_id").alias("last")
    )
    return newest.agg(
        F.count_if(F.col("last.status") == "completed").alias("ok"),
        F.count_if(F.col("last.status") == "failed").alias("failed"),
        F.count_if(F.col("last.status") == "running").alias("running"),
        F.max("last.completed_at").alias("last_completed"),
    )


def unbalanced(log: DataFrame) -> DataFrame:
    """Log rows whose rows are not all accounted for; empty when nothing was lost or made up."""
    accounted = reduce(
        lambda a, b: a + b,
        [
            F.coalesce(F.col(c), F.lit(0))
            for c in (
                "rows_written",
                "rows_deduped",
                "rows_junk",
                "rows_orphan",
                "rows_validate",
                "rows_conflict",
                "rows_rule",
            )
        ],
    )
    return log.where((F.col("status") == "completed") & (F.col("rows_read") != accounted))
