"""Loads of the landing, bronze, silver and gold layers, each one table at a time and restartable.

Every load reads its window from the control table, computes its change set once into the shared
folder, commits the target's next version, and only then marks the table processed. A run that dies
in between is repeated: tables already marked are skipped and a repeated merge changes no data.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor, as_completed
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.columns import business_columns, insert_stamp
from tidemark.functions.literals import ts_literal
from tidemark.functions.surrogate import number_rows
from tidemark.functions.typing import conform
from tidemark.operators.counts import load_counts
from tidemark.operators.merge import absent_rows, repeated_keys, upsert, within_key_range
from tidemark.operators.refresh import refresh_slices
from tidemark.operators.sales import daily_sales, fact_sales_delta, impacted_dates
from tidemark.operators.scd2 import conflicting_changes, scd2_parts
from tidemark.operators.updates import append_rows, keyed_update
from tidemark.operators.windows import change_window, in_window, load_bounds
from tidemark.plans import control as ctl
from tidemark.plans.runlog import latest_run, run_log_current
from tidemark.sources.eventlog import EventLog
from tidemark.sources.files import read_csv, read_snapshot, snapshot_path, write_snapshot
from tidemark.sources.partitioned import PartitionedTable
from tidemark.sources.shared import stage
from tidemark.sources.tables import BY_OPENNESS, OPEN, SLICE, Tables, by_month

CONTROL = "audit/cntrl_stm_mapping"
FILES = "audit/landing_file_list"
KEYS = "audit/primary_key_list"
RUNS = "audit/cntrl_batch_exec"
TASKS = "audit/cntrl_batch_exec_dtl"
DAILY = "gold/daily_sales_aggt"

# Columns of the control and audit tables, in order. "event_dt" and "event_seq" are our
# own: tasks are kept as a log of events and these order it.
AUDIT_TABLES = {
    CONTROL: "table_id string, source_table_name string, target_table_name string, target_layer_name string, "
    "active_flag boolean, is_delete_flag boolean, is_processed_flag boolean, last_load_start_dt timestamp_ntz, "
    "last_load_end_dt timestamp_ntz, source_count bigint, target_count bigint, dw_mdfctn_dt timestamp_ntz, "
    "dw_load_id string",
    FILES: "table_id string, table_name string, file_path string, delta_load_dt timestamp_ntz, "
    "file_create_dt timestamp_ntz, is_processed_flag boolean, dw_load_id string",
    KEYS: "table_name string, primary_key string",
    RUNS: "master_job_id string, job_exec_id string, job_name string, exec_status string, "
    "wf_start_datetime timestamp_ntz, wf_end_datetime timestamp_ntz, status_message string, "
    "data_load_start_dt timestamp_ntz, data_load_end_dt timestamp_ntz",
    TASKS: "master_job_id string, job_exec_id string, job_exec_dtl_id string, task_name string, "
    "component_name string, exec_status string, status_message string, insert_count bigint, update_count bigint, "
    "start_datetime timestamp_ntz, end_datetime timestamp_ntz, event_dt timestamp_ntz, "
    "event_seq bigint",
}
# Component and task names as the run log holds them.
COMPONENTS = {
    "landing": "C_source_landing",
    "bronze": "C_landing_bronze",
    "silver": "C_bronze_silver",
    "gold": "C_silver_gold",
}
TASK_NAMES = {
    "landing": "T_source_landing_{}",
    "bronze": "C_landing_bronze_{}",
    "silver": "C_bronze_silver_{}",
    "gold": "C_silver_gold_{}",
}
# How silver tables are kept. All others are upserted.
SILVER_KINDS = {"d_customers": "scd2", "d_products": "insert_absent"}
SURROGATES = {"d_customers": "customer_sk", "d_products": "product_sk"}

# The column of rejected rows that holds a line whose fields could not be told apart.
RAGGED = "dw_ragged_line"

# Facts are laid out by month where nothing else is asked for, so a merge rewrites only months it hits.
FACT_LAYOUTS = {"bronze": by_month("create_dt"), "silver": by_month("create_dt"), "gold": by_month("order_date")}


class LoadError(RuntimeError):
    """A load, a gate or a run that must stop."""


@dataclass(frozen=True)
class Counts:
    source: int = 0
    target: int = 0
    inserted: int = 0
    updated: int = 0


@dataclass(frozen=True)
class Run:
    """Who loads: stamped on rows and written to the run log."""

    load_id: str
    job_exec_id: str
    job_exec_dtl_id: str
    job_name: str


def _log_of(run: Run) -> str:
    """The part of the task log that a run writes to."""
    return f"{run.load_id}/{run.job_exec_id}"


class Warehouse:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc).replace(tzinfo=None),
        silver_mode: str = "both",
        silver_kinds: Mapping[str, str] = SILVER_KINDS,
        include_order_changes: bool = False,
        daily_partitions: str | None = None,
    ):
        """``daily_partitions`` ("day" or "month") keeps the daily aggregate in folders, of which a refresh writes only those it touches."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.clock = clock
        self.silver_mode = silver_mode
        self.silver_kinds = dict(silver_kinds)
        self.include_order_changes = include_order_changes
        self.tables = Tables(spark, f"{self.root}/tables")
        self.daily_partitions = daily_partitions

    # Set-up

    def create_audit_tables(self) -> None:
        for name, ddl in AUDIT_TABLES.items():
            if not self.tables.exists(name):
                self.tables.create(name, StructType.fromDDL(ddl))

    def create_table(self, name: str, ddl: str, layout: str | None = None) -> None:
        """A target table with its audit columns.

        Versioned silver tables are laid out open / closed, facts by month, others in one piece.
        """
        layer, short = name.split("/")
        schema = StructType.fromDDL(ddl)
        if layout is None and layer == "silver" and self.silver_kinds.get(short) in ("scd2", "insert_absent"):
            layout = BY_OPENNESS
        elif layout is None and short.startswith(("f_", "fact_")):
            usual = FACT_LAYOUTS[layer]
            layout = usual if usual.partition(":")[2] in schema.names else None
        self.tables.create(name, schema, layout)
        if self._in_partitions(name):
            self._partitions(name).create()

    def read(self, name: str) -> DataFrame:
        """The current rows of a table."""
        return self._partitions(name).read() if self._in_partitions(name) else self.tables.read(name)

    def _in_partitions(self, name: str) -> bool:
        return self.daily_partitions is not None and name == DAILY

    def _partitions(self, name: str) -> PartitionedTable:
        return PartitionedTable(self.spark, f"{self.root}/partitions/{name}", self.tables.schema(name), "order_date", self.daily_partitions)

    def append(self, name: str, rows: DataFrame, copies: bool = False) -> None:
        """Add rows, NULL in the columns they lack. ``copies`` says that a key may have very many of them."""
        empty = self.spark.createDataFrame([], self.tables.schema(name))
        # Such rows may bring surrogate keys of their own, so the highest is looked up again.
        unknown = {s: None for s in SURROGATES.values() if s in empty.columns}
        self.tables.append(name, append_rows(empty, rows), copies=copies, marks=unknown)

    def compact(self, name: str, slices: Sequence[str] | None = None) -> None:
        """Write slices (all, if None) of a table anew, so that each lies in one directory."""
        self.tables.compact(name, slices)

    # Runs

    def initialize(
        self, run: Run, layers: Sequence[str], start: datetime | str | None = None, end: datetime | str | None = None
    ) -> None:
        """Refuse to go on after a failed run of the job; otherwise open the next window."""
        last = latest_run(self.tables.read(RUNS).where(F.col("job_name") == run.job_name)).collect()
        if last and last[0].exec_status == ctl.FAILED:
            raise LoadError(f"the last run of {run.job_name} failed")
        now = self.clock()
        self.tables.update(CONTROL, lambda control: ctl.advance_window(control, layers, now, run.load_id, start, end))

    def open_run(self, run: Run, started: datetime | None = None) -> None:
        self._append_literal(
            RUNS,
            master_job_id=run.load_id,
            job_exec_id=run.job_exec_id,
            job_name=run.job_name,
            exec_status=ctl.STARTED,
            wf_start_datetime=started or self.clock(),
            status_message=ctl.IN_PROGRESS,
        )

    def close_run(self, run: Run, layers: Sequence[str] | None = None) -> None:
        """Write the outcome over ``layers`` (all, for a master run) and raise if tables are left."""
        outcome = ctl.run_outcome(self.tables.read(CONTROL), layers).collect()[0]
        mine = (F.col("master_job_id") == run.load_id) & (F.col("job_exec_id") == run.job_exec_id)
        self._end_run(mine, outcome.asDict())
        self._events().compact(_log_of(run))
        if outcome.exec_status == ctl.FAILED:
            raise LoadError(outcome.status_message)

    def fail_run(self, run: Run) -> str:
        """Mark the job's run failed and return the message."""
        message = ctl.failure_message(self.tables.read(CONTROL))
        mine = (F.col("master_job_id") == run.load_id) & (F.col("job_name") == run.job_name)
        self._end_run(mine, {"exec_status": ctl.FAILED, "status_message": message})
        self._events().compact(_log_of(run))
        return message

    def task_log(self) -> DataFrame:
        """The current state of every task."""
        keys = ["task_name", "job_exec_dtl_id"]
        # Logs of earlier versions lie in the table; nothing is added to it any more.
        events = self.tables.read(TASKS).unionByName(self._events().read())
        return run_log_current(events, keys, ["event_dt", "event_seq"]).drop("event_dt", "event_seq")

    def _events(self) -> EventLog:
        return EventLog(self.spark, f"{self.root}/logs/tasks", self.tables.schema(TASKS))

    # Layers

    def run_layer(
        self,
        layer: str,
        run: Run,
        source_root: str | None = None,
        day: tuple[str, str, str] | None = None,
        parallel: int = 4,
        tables: Sequence[str] | None = None,
    ) -> dict[str, Counts]:
        """Load the tables of a layer that are due; several at once, as they do not depend on each other.

        ``tables`` names the ones to load and to look at afterwards, say a table that failed before; several
        drivers may each load tables of their own at the same time. ``day`` (year, month, day) replaces the
        window of gold tables. A table that fails, also while it is marked or logged, does not keep
        the others from finishing; then, or if live tables are left over, ``LoadError`` is raised.
        """
        control = self.tables.read(CONTROL)
        mine = F.lit(True) if tables is None else self._name(layer).isin(list(tables))
        pending = ctl.pending_landing(control) if layer == "landing" else ctl.pending(control, layer)
        due = pending.where(mine).collect()
        keys = self._keys() if layer != "landing" else {}
        files = {}
        if layer == "bronze":
            picked = ctl.pick_files(self.tables.read(FILES), control).collect()
            files = {r.table_id: r.file_path for r in picked}
        started = self.clock()
        if due:
            opened = [(self._label(layer, row), ctl.STARTED, ctl.IN_PROGRESS, Counts()) for row in due]
            self._log(run, layer, opened, started)

        done: dict[str, Counts] = {}
        failed: dict[str, Exception] = {}
        with ThreadPoolExecutor(max_workers=parallel) as pool:
            jobs = {pool.submit(self._load, layer, row, run, keys, files, source_root, day): row for row in due}
            for job in as_completed(jobs):
                row = jobs[job]
                label = self._label(layer, row)
                try:
                    counts = job.result()
                    self._mark_processed(layer, row, run, counts)
                    self._log(run, layer, [(label, ctl.SUCCESS, ctl.SUCCESS, counts)], started, self.clock())
                    done[label] = counts
                except Exception as error:  # raised below for the layer as a whole
                    failed[label] = error
                    self._log_failure(run, layer, label, error, started)
        if failed:
            raise LoadError(f"failed in {layer}: {', '.join(sorted(failed))}") from next(iter(failed.values()))
        left = ctl.unprocessed_names(self.tables.read(CONTROL).where(mine), [layer]).collect()
        if left:
            raise LoadError(f"unprocessed in {layer}: {left[0].table_names}")
        return done

    def _log_failure(self, run: Run, layer: str, label: str, error: Exception, started: datetime) -> None:
        try:
            self._log(run, layer, [(label, ctl.FAILED, str(error), Counts())], started, self.clock())
        except Exception as second:
            # The table counts as failed either way; what kept it from being logged goes along.
            error.add_note(f"and the failure could not be logged: {second}")

    def _load(
        self, layer: str, row: Row, run: Run, keys: dict, files: dict, source_root: str | None, day: tuple | None
    ) -> Counts:
        if layer == "landing":
            return self._land(row, run, source_root)
        name = row.target_table_name
        if layer == "bronze":
            return self._load_bronze(row, run, keys[name], files.get(row.table_id))
        if layer == "silver":
            return self._load_silver(row, run, keys[name])
        bounds = load_bounds((row.last_load_start_dt, row.last_load_end_dt), *(day or ()))
        if f"gold/{name}" == DAILY:
            return self._refresh_daily(DAILY, bounds, run)
        if name == "fact_sales":
            return self._merge_fact(f"gold/{name}", bounds, run, keys[name])
        raise LoadError(f"no load is known for gold table {name}")

    def _land(self, row: Row, run: Run, source_root: str | None) -> Counts:
        """One pass over the extract; its text stays text. An empty change set writes no snapshot.

        Lines with too many or too few fields are set aside whole, whatever their times say, and so are
        rows whose times cannot be read."""
        name = row.source_table_name
        folder = (source_root or f"{self.root}/source_files").rstrip("/")
        extract = read_csv(self.spark, f"{folder}/{name}/{name}.csv", ragged=RAGGED)
        hit = in_window(extract, row.last_load_start_dt, row.last_load_end_dt, "either")
        hit = F.coalesce(hit, F.lit(False))
        times = ("create_dt", "mdfctn_dt")
        unreadable = reduce(
            lambda a, b: a | b, [F.col(c).isNotNull() & F.col(c).try_cast("timestamp_ntz").isNull() for c in times]
        )
        ragged = F.col(RAGGED).isNotNull()
        found = stage(extract.where(hit | unreadable | ragged), f"extract-{name}")
        self._reject("landing", name, found.where(ragged | unreadable & ~hit), run)
        changes = found.where(hit & ~ragged).drop(RAGGED)
        changed = changes.count()
        if changed:
            write_snapshot(changes, snapshot_path(self.root, name, row.last_load_end_dt))
        return Counts(source=changed)

    def _load_bronze(self, row: Row, run: Run, keys: Sequence[str], path: str | None) -> Counts:
        if path is None:
            return Counts()
        name = f"bronze/{row.target_table_name}"
        wanted = business_columns(self.tables.read(name))
        schema = StructType([f for f in self.tables.schema(name).fields if f.name in wanted])
        typed, rejected = conform(read_snapshot(self.spark, path), schema)
        self._reject("bronze", row.target_table_name, rejected, run)
        return self._merge(name, stage(typed, f"delta-{row.target_table_name}"), keys, run)

    def _load_silver(self, row: Row, run: Run, keys: Sequence[str]) -> Counts:
        short, end = row.target_table_name, row.last_load_end_dt
        name, kind = f"silver/{short}", self.silver_kinds.get(short, "upsert")
        bronze = self.tables.read(f"bronze/{row.source_table_name}")
        changes = change_window(bronze, row.last_load_start_dt, end, self.silver_mode)
        changes = stage(changes.select(*business_columns(changes)), f"delta-{short}")
        if kind == "upsert":
            return self._merge(name, changes, keys, run)
        found = changes.count()
        if not found:
            return Counts()

        at, surrogate, version = self.clock(), SURROGATES.get(short), self.tables.version(name)
        current = self.tables.read(name, {OPEN} if self.tables.layout(name) == BY_OPENNESS else None)
        if kind == "insert_absent":
            # Nothing is matched, so a key may come more than once: all its rows are new, or none is.
            new = absent_rows(current, changes, keys, end, run.load_id, at, surrogate)
            numbered, marks = self._numbered(name, new, surrogate)
            self.tables.append(name, numbered, based_on=version, marks=marks)
        else:
            self._refuse(name, conflicting_changes(current, changes, keys))
            parts = scd2_parts(current, changes, keys, end, run.load_id, at, surrogate)
            new, marks = self._numbered(name, parts.appended, surrogate)
            if self.tables.layout(name) == BY_OPENNESS:
                # Closed versions stay where they are; those closed now are added to them.
                self.tables.write(name, parts.was_open.unionByName(new), replace={OPEN}, based_on=version, marks=marks)
            else:
                whole = parts.closed.unionByName(parts.was_open).unionByName(new)
                self.tables.write(name, whole, based_on=version, marks=marks)
        return self._counts(name, run, at, found)

    def _merge_fact(self, name: str, bounds: tuple, run: Run, keys: Sequence[str]) -> Counts:
        items, orders = self.tables.read("silver/f_order_items"), self.tables.read("silver/f_orders")
        delta = fact_sales_delta(items, orders, *bounds, include_order_changes=self.include_order_changes)
        return self._merge(name, stage(delta, "delta-fact_sales"), keys, run)

    def _refresh_daily(self, name: str, bounds: tuple, run: Run) -> Counts:
        items, orders = self.tables.read("silver/f_order_items"), self.tables.read("silver/f_orders")
        dates = stage(impacted_dates(items, orders, *bounds), "dates-daily_sales")
        if dates.isEmpty():
            return Counts()
        at = self.clock()
        # Staged so that its true size decides how items are joined to it.
        scope = orders.select("order_id", "customer_id", "order_date").join(dates, "order_date", "left_semi")
        totals = daily_sales(items, stage(scope, "orders-daily_sales"), dates)
        empty = self.spark.createDataFrame([], self.tables.schema(name))
        fresh = append_rows(empty, totals, **insert_stamp(empty, run.load_id, at))
        if self._in_partitions(name):
            self._partitions(name).replace(fresh, dates)
        else:
            # One row per date, so the table is small and written whole.
            version, target = self.tables.version(name), self.tables.read(name)
            self.tables.write(name, refresh_slices(target, fresh, dates, "order_date"), based_on=version)
        counts = self._counts(name, run, at)
        return Counts(counts.source, counts.target, counts.inserted, 0)

    # Shared steps

    def _merge(self, name: str, delta: DataFrame, keys: Sequence[str], run: Run) -> Counts:
        """Upsert a staged change set, rewriting only the slices that hold a matched key.

        New rows of other slices are added to them. How many slices a table has is set by its layout,
        so their names may be collected.
        """
        found = delta.count()
        if not found:
            return Counts()
        at, version = self.clock(), self.tables.version(name)
        # The stored keys that match, once: they name the slices and answer what else is asked about keys.
        # Only the part of the table between the smallest and the largest key is looked at.
        stored = within_key_range(self.tables.read_sliced(name), delta, keys).select(*keys, SLICE)
        matched = stage(stored.join(delta.select(*keys), list(keys), "left_semi"), f"matched-{name.replace('/', '-')}")
        replace = {r[0] for r in matched.select(SLICE).distinct().collect()}
        matched = matched.drop(SLICE)
        target = self.tables.read(name, replace)
        many = self.tables.has_copies(name)
        repeated = repeated_keys(delta, keys)
        repeats = not repeated.isEmpty()
        if repeats:
            self._refuse(name, repeated.join(matched, list(keys), "left_semi"))
            # None of these keys is stored, so their rows are all new, however many copies there are.
            single = delta.join(repeated.select(*keys), list(keys), "left_anti")
            copies = delta.join(repeated.select(*keys), list(keys), "left_semi")
            stamp = insert_stamp(target, run.load_id, at)
            state = append_rows(upsert(target, single, keys, run.load_id, at, many, matched=matched), copies, **stamp)
        else:
            state = upsert(target, delta, keys, run.load_id, at, many, matched=matched)
        self.tables.write(name, state, replace=replace, copies=repeats, based_on=version)
        return self._counts(name, run, at, found)

    def _refuse(self, name: str, conflicts: DataFrame) -> None:
        """Stop the load if several source rows would change one stored row."""
        example = conflicts.head()
        if example is not None:
            raise LoadError(f"several source rows for one row of {name}, for instance {example.asDict()}")

    def _numbered(self, name: str, rows: DataFrame, surrogate: str | None) -> tuple[DataFrame, dict[str, int]]:
        """``rows`` with surrogate keys, and the highest one so far, to be kept with the version written."""
        if surrogate is None:
            return rows, {}
        dtype = self.tables.schema(name)[surrogate].dataType
        last = self.tables.mark(name, surrogate)
        if last is None:  # rows came from elsewhere: look once
            last = int(self.tables.read(name).agg(F.max(surrogate)).collect()[0][0] or 0)
        new = stage(rows, f"new-{name.replace('/', '-')}")
        numbered = number_rows(new, surrogate, last)
        return numbered.withColumn(surrogate, F.col(surrogate).cast(dtype)), {surrogate: last + new.count()}

    def _counts(self, name: str, run: Run, at: datetime, source: int | None = None) -> Counts:
        seen = load_counts(self.read(name), run.load_id, at).collect()[0]
        found = seen.written_count if source is None else source
        return Counts(found, seen.target_count, seen.insert_count, seen.update_count)

    def _reject(self, layer: str, name: str, rows: DataFrame, run: Run) -> None:
        """Keep rows that cannot be read, apart for each layer: both may set rows of one table aside."""
        if not rows.isEmpty():
            rows.write.mode("overwrite").parquet(f"{self.root}/rejected/{layer}/{name}/{run.load_id}")

    def _keys(self) -> dict[str, list[str]]:
        rows = self.tables.read(KEYS).collect()
        return {n: [r.primary_key for r in rows if r.table_name == n] for n in {r.table_name for r in rows}}

    # State

    def _mark_processed(self, layer: str, row: Row, run: Run, counts: Counts) -> None:
        now = self.clock()
        if layer == "landing":
            if counts.source:
                path = snapshot_path(self.root, row.source_table_name, row.last_load_end_dt)
                written = self.spark.createDataFrame(
                    [(row.bronze_table_id, path, row.last_load_end_dt)],
                    "table_id string, file_path string, delta_load_dt timestamp_ntz",
                )
                self.tables.update(FILES, lambda files: ctl.register_files(files, written, now, run.load_id))
            mine = F.col("source_table_name") == row.source_table_name
            values = {}
        else:
            mine = F.col("target_table_name") == row.target_table_name
            values = {"source_count": counts.source, "target_count": counts.target}
            if layer == "bronze":
                taken = {"is_processed_flag": True}
                where = F.col("table_name") == row.target_table_name
                self.tables.update(FILES, lambda files: keyed_update(files, where, taken))
            else:
                values["dw_load_id"] = run.load_id
        values |= {"is_processed_flag": True, "dw_mdfctn_dt": ts_literal(now)}
        marked = mine & (F.col("target_layer_name") == layer)
        self.tables.update(CONTROL, lambda control: keyed_update(control, marked, values))

    def _end_run(self, mine, values: dict) -> None:
        ended = {"wf_end_datetime": ts_literal(self.clock())}
        self.tables.update(RUNS, lambda runs: keyed_update(runs, mine, values | ended))

    def _name(self, layer: str) -> Column:
        return F.col("source_table_name" if layer == "landing" else "target_table_name")

    def _label(self, layer: str, row: Row) -> str:
        return row.source_table_name if layer == "landing" else row.target_table_name

    def _log(self, run: Run, layer: str, events: list, started: datetime, ended: datetime | None = None) -> None:
        events = self._literals(
            TASKS,
            [
                dict(
                    master_job_id=run.load_id,
                    job_exec_id=run.job_exec_id,
                    job_exec_dtl_id=run.job_exec_dtl_id,
                    task_name=TASK_NAMES[layer].format(label),
                    component_name=COMPONENTS[layer],
                    exec_status=status,
                    status_message=message,
                    insert_count=counts.inserted,
                    update_count=counts.updated,
                    start_datetime=started,
                    end_datetime=ended,
                    event_dt=ended or started,
                    event_seq=0 if ended is None else 1,
                )
                for label, status, message, counts in events
            ],
        )
        self._events().append(_log_of(run), events)

    def _literals(self, name: str, rows: list[dict]) -> DataFrame:
        schema = self.tables.schema(name)
        return self.spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)

    def _append_literal(self, name: str, **row) -> None:
        new = self._literals(name, [row])
        self.tables.update(name, lambda log: log.unionByName(new))
