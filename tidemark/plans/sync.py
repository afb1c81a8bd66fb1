"""One control row, end to end: extract, stage, merge, publish, advance, log."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime
from threading import Lock

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schema as S
from tidemark.control import audit
from tidemark.control import table as control_table
from tidemark.control.claims import Claims
from tidemark.control.events import ControlLog
from tidemark.functions.types import drift_between
from tidemark.operators import merge as M
from tidemark.operators.changes import apply_changes, reduced_changes
from tidemark.operators.columns import align, sanitize, with_select_list
from tidemark.operators.extract import extract, window_filter
from tidemark.operators.metrics import merge_metrics, observed, require_counts
from tidemark.session import staging
from tidemark.sinks.publish import Versions, archive_copy, archive_inputs
from tidemark.sinks.text import write_soh
from tidemark.sources.changes_csv import find_drops, read_files
from tidemark.sources.tables import snapshot
from tidemark.sources.text import read_soh


def _names(text: str | None) -> tuple[str, ...]:
    return tuple(n.strip() for n in text.split(",") if n.strip()) if text else ()


@dataclass(frozen=True)
class LoadSpec:
    """What one control row asks for."""

    id: int
    route: str
    load_type: str
    source_schema: str
    source_table: str
    target_schema: str
    target_table: str
    keys: tuple[str, ...] = ()
    column: str | None = None
    last_run: datetime | None = None
    second_last_run: datetime | None = None
    partition_by: tuple[str, ...] = ()
    partition_expr: str | None = None
    distribute_by: tuple[str, ...] = ()
    distribute_expr: str | None = None
    archived: bool = False
    # not in the control table: columns to delete by, cross-partition cleaning,
    # a key column that grows with time, a test of the target's keys before the
    # join, a count check after a full load, names of the change target's last
    # two columns
    delete_keys: tuple[str, ...] = ()
    global_keys: bool = False
    range_key: str | None = None
    key_filter: bool = False
    validate: bool = False
    flag: str = S.DELETED_FLAG
    stamp: str = S.LOAD_STAMP

    @classmethod
    def from_row(cls, row: Row, **more) -> LoadSpec:
        partitions = tuple(c for c in (row.first_partitioned_column,
                                       row.second_partitioned_column) if c)
        return cls(
            id=row.id, route=row.data_path, load_type=S.check_load_type(row.load_type),
            source_schema=row.source_schemaname, source_table=row.source_tablename,
            target_schema=row.target_schemaname, target_table=row.target_tablename,
            keys=_names(row.join_columns), column=row.incremental_column,
            last_run=row.last_run_time, second_last_run=row.second_last_run_time,
            partition_by=partitions if row.is_partitioned else (),
            partition_expr=row.partition_column_transformation,
            distribute_by=_names(row.distribution_columns),
            distribute_expr=row.dist_col_transformation,
            archived=bool(row.archived_enabled), **more)

    def with_layout_columns(self, df: DataFrame) -> DataFrame:
        """Distribution and partition columns from their configured expressions."""
        if self.distribute_expr and self.distribute_by:
            df = with_select_list(df, self.distribute_expr, self.distribute_by)
        if self.partition_expr and self.partition_by:
            df = with_select_list(df, self.partition_expr, self.partition_by)
        return df

    def partitions_follow_keys(self, rows: DataFrame) -> bool:
        """Whether the partition columns can be worked out from the key columns alone."""
        if not self.partition_expr:
            return set(self.partition_by) <= set(self.keys)
        try:
            with_select_list(rows.select(*self.keys), self.partition_expr, self.partition_by)
        except AnalysisException:
            return False
        return True

    @property
    def control_route(self) -> str:
        """The route whose control rows this load stands for: a database-to-table
        load covers its extract row and its staged row."""
        if control_table.DB_TO_TABLE in self.route:
            return control_table.STAGED_TO_TABLE
        return self.route


def check_target_schema(spec: LoadSpec, special: bool = False) -> None:
    """Loading into another schema has to be asked for."""
    if (control_table.DB_TO_TABLE in spec.route and not special
            and spec.source_schema != spec.target_schema):
        raise ValueError(f"load {spec.id}: target schema {spec.target_schema} differs from "
                         f"source schema {spec.source_schema}")


def _counted(counts: dict | None, target: DataFrame, rows: DataFrame, keys: Sequence[str],
             null_safe: bool, removing: DataFrame | None = None) -> None:
    """What a keyed merge is about to do, for the audit row.

    ``rows`` go in; target rows with their keys, or with those of ``removing``,
    go. One pass over the key columns of ``target``, which need not hold more
    than the partitions that can be concerned.
    """
    if counts is None:
        return
    found = merge_metrics(target, rows, keys, null_safe=null_safe, removing=removing).first()
    counts.update(rows_inserted=found.rows_incoming, rows_updated=found.rows_updated,
                  rows_deleted=found.rows_updated if removing is None else found.rows_removed)


def _replaced(counts: dict | None, target, rows: DataFrame, append: bool = False) -> None:
    """The same for a load without keys; the old rows all go or all stay."""
    if counts is None:
        return
    old = _rows_of(target) if target.exists() and not append else 0
    counts.update(rows_inserted=rows.count(), rows_updated=0, rows_deleted=old)


def _rows_of(target) -> int:
    """All rows of a target: from what it knows of itself, or a scan of no columns."""
    return target.row_count() if hasattr(target, "row_count") else target.read().count()


def _published(counts: dict | None, target) -> None:
    """Rows of the whole target as it is now, whichever part of it a load has touched."""
    if counts is not None:
        counts["target_row_count"] = _rows_of(target)


def _in_database(counts: dict | None, done: list[int]) -> None:
    """The counts the database gave for deletes, the insert and the drop of the staged table."""
    if counts is not None and done:
        counts.update(rows_deleted=sum(done[:-2]), rows_inserted=done[-2], rows_updated=0)


def _merge_into(target, spec: LoadSpec, incoming: DataFrame, state: str,
                counts: dict | None = None) -> None:
    """Publish staged incoming rows under the spec's load type."""
    if hasattr(target, "merge_rows") and not target.exists():
        target.create(incoming.schema)
    if spec.load_type != S.FULL and hasattr(target, "check_known"):
        target.check_known()
    if spec.load_type == S.FULL or not target.exists():
        _replaced(counts, target, incoming)
        if hasattr(target, "redefine"):
            target.redefine(_partitions_last(incoming, spec.partition_by), state,
                            spec.partition_by, spec.distribute_by)
            _published(counts, target)
        else:
            target.replace(align(incoming, target.read().columns), state)
        return
    current = target.read()
    incoming = align(incoming, current.columns)
    if spec.load_type == S.APPEND_ONLY:
        _replaced(counts, target, incoming, append=True)
        target.append(incoming, spec.distribute_by, state)
    elif hasattr(target, "merge_rows"):
        _in_database(counts, target.merge_rows(incoming, spec.keys, spec.load_type,
                                               null_safe=False))
        return
    elif target.partition_by:
        parts = target.partition_by
        in_reach = current if spec.global_keys else M.prune_to(
            current, M.affected_partitions(incoming, parts), parts)
        _counted(counts, in_reach, incoming, spec.keys, False)
        if spec.global_keys:
            touched = M.touched_partitions(current, incoming, spec.keys, parts)
            merged = M.merge_partitioned_global(current, incoming, spec.keys, parts)
        else:
            touched = M.affected_partitions(incoming, parts)
            merged = M.merge_partitioned(current, incoming, spec.keys, parts)
        target.replace_partitions(merged, touched, spec.distribute_by,
                                  may_empty=spec.global_keys)
    elif hasattr(target, "merge_files"):
        done = target.merge_files(incoming, spec.keys, state)
        if counts is not None:
            counts.update(done)
    else:
        _counted(counts, current, incoming, spec.keys, False)
        merged = M.merge_flat(current, incoming, spec.keys, range_key=spec.range_key,
                              key_filter=spec.key_filter)
        target.replace(merged, state, spec.distribute_by)
    if not hasattr(target, "merge_rows"):
        _published(counts, target)


def _partitions_last(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    return df.select(*[c for c in df.columns if c not in partition_by], *partition_by)


def load_table(spark: SparkSession, spec: LoadSpec, source: DataFrame, target, *,
               now: datetime, load_id: int, counts: dict | None = None) -> int:
    """Database-to-table and table-to-table routes; returns the rows that came in.

    A database source is read through the watermark window, a mirrored table or
    view whole. The rows are staged first, so the merge works on a fixed state
    and Spark knows its size when it picks the join.
    """
    if control_table.is_mirror(spec.route):
        rows = source
    else:
        rows = extract(sanitize(source), spec.load_type, spec.column, now=now,
                       last_run=spec.last_run, second_last_run=spec.second_last_run)
    counted, seen = observed(spec.with_layout_columns(rows))
    with staging(spark, f"load{load_id}") as path:
        staged = snapshot(counted, path)
        _merge_into(target, spec, staged, f"load{load_id}", counts)
        if spec.validate and spec.load_type == S.FULL:
            require_counts(staged, target.read())
    return seen.get["rows"]


def check_drift(spec: LoadSpec, changes: T.StructType, target: T.StructType) -> None:
    """Change rows must have the target's columns: a new one would be dropped in silence,
    a missing one filled with NULL."""
    added = {S.OP_CODE, S.TIME_KEY}
    own = {spec.flag, spec.stamp, *S.HOUSEKEEPING, *spec.partition_by, *spec.distribute_by}
    drift = drift_between(T.StructType([f for f in changes if f.name not in added]),
                          T.StructType([f for f in target if f.name not in own]))
    unknown = [n for n in drift["added"] if n not in own]
    if unknown or drift["removed"]:
        raise ValueError(f"load {spec.id}: the change columns of {spec.source_table} have drifted: "
                         f"new {unknown}, missing {drift['removed']}")


def load_changes(spark: SparkSession, spec: LoadSpec, changes: DataFrame, target, *,
                 now: datetime, load_id: int, counts: dict | None = None) -> int:
    """Change-file routes: null-safe keys, or strict ones on the strict route.

    A partitioned table is rewritten by partition. Where the partition columns
    don't follow from the key, partitions that hold a changed key's old row are
    rewritten as well.
    """
    check_drift(spec, changes.schema, target.read().schema)
    null_safe = spec.route != control_table.CHANGES_TO_DB_STRICT
    how = {"load_ts": now, "load_type": spec.load_type, "flag": spec.flag, "stamp": spec.stamp,
           "null_safe": null_safe}
    delete_keys = spec.delete_keys or None
    # a log that is appended keeps every row, and other columns for the delete split a key
    how["reduced"] = (set(spec.delete_keys) <= set(spec.keys)
                      and not (spec.load_type == S.APPEND_ONLY and null_safe))
    counted, seen = observed(spec.with_layout_columns(changes))
    reduced = reduced_changes(counted, spec.keys, load_type=spec.load_type, null_safe=null_safe,
                              delete_keys=delete_keys)
    with staging(spark, f"changes{load_id}") as path:
        staged, current = snapshot(reduced, path), target.read()
        if hasattr(target, "merge_rows"):
            # what the database needs are the rows an empty target would get
            fresh = spark.createDataFrame([], current.schema)
            rows = apply_changes(fresh, staged, spec.keys, **how)
            _in_database(counts, target.merge_rows(rows, spec.delete_keys or spec.keys,
                                                   spec.load_type, null_safe, deletes=staged))
            return seen.get["rows"]
        parts, done = target.partition_by, None
        if parts and spec.load_type != S.FULL and not spec.delete_keys:
            done = M.apply_in_partitions(
                current, staged, spec.keys, parts,
                moved=not spec.partitions_follow_keys(changes), **how)
        if counts is not None:
            fresh = spark.createDataFrame([], current.schema)
            rows = apply_changes(fresh, staged, spec.keys, **how)
            if spec.load_type == S.FULL:
                _replaced(counts, target, rows)
            else:
                # rows in partitions that are not touched have none of the keys
                scope = M.prune_to(current, done.touched, parts) if done else current
                _counted(counts, scope, rows, spec.delete_keys or spec.keys, null_safe,
                         removing=staged)
        if done:
            target.replace_partitions(done.rows, done.touched, spec.distribute_by,
                                      may_empty=done.may_empty)
        else:
            merged = apply_changes(current, staged, spec.keys, delete_keys=delete_keys, **how)
            target.replace(merged, f"load{load_id}", spec.distribute_by)
        _published(counts, target)
    return seen.get["rows"]


def business_schema(target, spec: LoadSpec) -> T.StructType:
    """A change target's columns without flag, stamp and derived columns, as change
    files carry them."""
    added = {spec.flag, spec.stamp, *S.HOUSEKEEPING}
    if spec.partition_expr:
        added |= set(spec.partition_by)
    return T.StructType([f for f in target.read().schema.fields if f.name not in added])


def load_drops(spark: SparkSession, spec: LoadSpec, directory: str, business: T.StructType,
               target, *, now: datetime, load_id: int, archive_root: str | None = None,
               counts: dict | None = None, claims: Claims | None = None, **how) -> int:
    """Apply the change files that wait for a table, then move them to the archive.

    The files are named once, so one that arrives meanwhile is neither half
    read nor archived unread. No files means nothing to do, which is a success.

    With ``claims`` files belong to the load that named them first: another run
    leaves them alone, and one that finds them published but not archived only
    archives them.
    """
    files, table = find_drops(spark, directory, spec.source_table), spec.source_table

    def archive(done: Sequence[str]) -> None:
        if archive_root and done:
            archive_inputs(spark, done, archive_root, spec.source_schema, table, now.date())
            if claims:
                claims.drop(table, done)

    if claims:
        share = claims.take(table, files, load_id)
        archive(share.applied)
        files = share.own
    if not files:
        return 0
    rows = load_changes(spark, spec, read_files(spark, files, business, **how), target,
                        now=now, load_id=load_id, counts=counts)
    if claims:
        claims.published(table, load_id)
    archive(files)
    return rows


def _upsert(target, spec: LoadSpec, rows: DataFrame, state: str, null_safe: bool,
            counts: dict | None = None) -> None:
    if hasattr(target, "merge_rows") and not target.exists():
        target.create(rows.schema)
    current = target.read()
    if hasattr(target, "merge_rows"):
        _in_database(counts, target.merge_rows(align(rows, current.columns), spec.keys,
                                               spec.load_type, null_safe))
        return
    if spec.load_type == S.FULL:
        _replaced(counts, target, rows)
    else:
        _counted(counts, current, rows, spec.keys, null_safe)
    merge = M.cross_sync if null_safe else M.upsert_rows
    target.replace(merge(current, rows, spec.keys, spec.load_type), state, spec.distribute_by)
    _published(counts, target)


def load_file(spark: SparkSession, spec: LoadSpec, source: DataFrame, target, *,
              now: datetime, load_id: int, counts: dict | None = None) -> int:
    """Database-to-database by file: exact window, export, strict delete, all rows in."""
    if spec.load_type != S.FULL:
        source = window_filter(source, spec.column, spec.last_run, now)
    counted, seen = observed(source)
    with staging(spark, f"file{load_id}") as path:
        write_soh(counted, path)
        _upsert(target, spec, read_soh(spark, path, source.schema), f"load{load_id}", False,
                counts)
    return seen.get["rows"]


def load_cross(spark: SparkSession, spec: LoadSpec, source: DataFrame, target, *,
               now: datetime, load_id: int, counts: dict | None = None) -> int:
    """Cross-database route: exact window, null-safe delete, insert by name."""
    if spec.load_type != S.FULL:
        source = window_filter(source, spec.column, spec.last_run, now)
    counted, seen = observed(source)
    with staging(spark, f"cross{load_id}") as path:
        _upsert(target, spec, snapshot(counted, path), f"load{load_id}", True, counts)
    return seen.get["rows"]


CROSS = "COMM2BUS"


def loader_for(route: str) -> Callable[..., int]:
    if route in (control_table.CHANGES_TO_DB, control_table.CHANGES_TO_DB_STRICT):
        return load_changes
    if route == control_table.DB_FILE_TO_DB:
        return load_file
    if route == CROSS:
        return load_cross
    if control_table.DB_TO_TABLE in route or control_table.is_mirror(route):
        return load_table
    raise ValueError(f"unknown route {route!r}")


def _advanced(control: DataFrame, spec: LoadSpec, now: datetime) -> DataFrame:
    if spec.route in (control_table.CHANGES_TO_DB, control_table.CHANGES_TO_DB_STRICT):
        control = control_table.changes_applied(control, spec.source_schema, spec.source_table,
                                                spec.route, now)
        return _completed(control, spec)
    if spec.route in (control_table.DB_FILE_TO_DB, CROSS):
        return _completed(control_table.file_loaded(control, spec.id, spec.route, now), spec)
    return control_table.advance(control, spec.target_schema, spec.target_table,
                                 spec.control_route, now)


def _completed(control: DataFrame, spec: LoadSpec) -> DataFrame:
    return control_table.set_status(control, spec.target_schema, spec.target_table,
                                    spec.control_route, S.STATUS_COMPLETED)


# counts of an audit row that a load takes itself
AUDITED = ("rows_inserted", "rows_updated", "rows_deleted")


@dataclass
class Outcome:
    spec: LoadSpec
    rows: int
    error: str | None = None
    counts: dict = field(default_factory=dict)


def run_due(spark: SparkSession, control: Versions | ControlLog, audit_path: str, *, route: str,
            schema: str,
            load_type: str, now: datetime, load_id: int,
            source_of: Callable[[LoadSpec], DataFrame], target_of: Callable[[LoadSpec], object],
            group: int | None = None, tables: Sequence[str] | None = None,
            archive_root: str | None = None, drops: str | None = None,
            claims: Claims | None = None,
            special: bool = False, at_once: int = 1,
            options: Mapping[str, Mapping] | None = None, **more) -> list[Outcome]:
    """Run every due load of a route, ``at_once`` of them at a time.

    With a ``ControlLog`` several runs may work on one control table; the loads
    of one run never lose one another's updates.

    ``more`` are fields of every load's ``LoadSpec``, ``options`` those of single
    targets by their full name: ``{"app.orders": {"delete_keys": ("id",)}}``.

    With ``drops``, change routes read the files that wait in that folder and
    move them below ``archive_root`` afterwards; ``source_of`` is not asked.
    ``claims`` keeps several runs from sharing these files.

    Data is published before the watermark moves, so a run that dies in between
    is repeated. Repeating a load under the same ``load_id`` changes nothing;
    only an append to a database adds its rows again. A failing load is logged and
    marked, the next one still runs.
    """
    state = control.read(spark.createDataFrame([], control_table.SCHEMA).schema)
    # control rows are one per configured table pair
    rows = control_table.due(state, route, schema, load_type, group=group, tables=tables).collect()
    saving = Lock()

    def save(change: Callable[[DataFrame], DataFrame]) -> None:
        with saving:
            _save(control, change)

    def run(row: Row) -> Outcome:
        own = (options or {}).get(f"{row.target_schemaname}.{row.target_tablename}", {})
        spec = LoadSpec.from_row(row, **{**more, **own})
        outcome = Outcome(spec, 0)
        try:
            check_target_schema(spec, special)
            save(lambda c: control_table.set_status(
                c, spec.target_schema, spec.target_table, spec.control_route, S.STATUS_RUNNING))
            target = target_of(spec)
            load = loader_for(spec.route)
            if load is load_changes and drops:
                outcome.rows = load_drops(spark, spec, drops, business_schema(target, spec), target,
                                          now=now, load_id=load_id, archive_root=archive_root,
                                          counts=outcome.counts, claims=claims)
            else:
                outcome.rows = load(spark, spec, source_of(spec), target, now=now,
                                    load_id=load_id, counts=outcome.counts)
            if spec.archived and archive_root:
                archive_copy(target.read(), f"{archive_root}/{spec.target_schema}",
                             spec.target_table, load_id)
            save(lambda c: _advanced(c, spec, now))
        except Exception as failure:  # one table must not stop the others
            outcome.error = str(failure) or type(failure).__name__
            save(lambda c: control_table.set_status(
                c, spec.target_schema, spec.target_table, spec.control_route, S.STATUS_ERROR))
        audit.append_event(
            spark, audit_path, load_id=load_id, run_id=spec.id,
            table_name=f"{spec.target_schema}.{spec.target_table}", data_path=spec.route,
            status=audit.JOB_ERROR if outcome.error else audit.JOB_FINISHED,
            technology="Spark", number_of_errors=int(outcome.error is not None),
            source_row_count=outcome.rows,
            **(dict.fromkeys(AUDITED, 0) | ({} if outcome.error else outcome.counts)),
            error_message=outcome.error or "No Errors",
            error_category=outcome.error or "")
        return outcome

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        return list(pool.map(run, rows))


def _save(control: Versions | ControlLog, change: Callable[[DataFrame], DataFrame]) -> None:
    """Next event, or next version, of the control table; it holds one row per load."""
    if isinstance(control, ControlLog):
        control.update(change)
        return
    schema = control.spark.createDataFrame([], control_table.SCHEMA).schema
    version = control.current()
    state = control.read(schema)
    control.publish(change(state).select(*[F.col(c) for c in schema.names]), (version or 0) + 1)
    control.prune(keep=3)
