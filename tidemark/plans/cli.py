"""Run the due loads of a route: ``python -m tidemark``."""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence
from datetime import datetime

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

from tidemark import schema as S
from tidemark.control import audit
from tidemark.control import table as control_table
from tidemark.control.claims import Claims
from tidemark.control.events import ControlLog
from tidemark.plans.sync import LoadSpec, run_due
from tidemark.session import RECOMMENDED_CONF
from tidemark.sinks.targets import JdbcTarget, TableTarget
from tidemark.sources import jdbc


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    p.add_argument("--control", required=True, help="folder of the control table")
    p.add_argument("--audit", required=True, help="folder of the audit log")
    p.add_argument("--route", required=True)
    p.add_argument("--schema", required=True, help="source schema; target schema for mirrors")
    p.add_argument("--load-type", required=True, choices=S.LOAD_TYPES)
    p.add_argument("--load-id", required=True, type=int)
    p.add_argument("--group", type=int)
    p.add_argument("--tables", help="comma separated")
    p.add_argument("--now", help="window end, yyyy-mm-dd hh:mm:ss; default: the clock")
    p.add_argument("--warehouse", help="folder under which table states are published")
    p.add_argument("--drops", help="folder of waiting change files")
    p.add_argument("--claims", help="folder of claims on change files, for runs that share drops")
    p.add_argument("--archive", help="folder for applied files and table copies")
    p.add_argument("--other-schema", action="store_true",
                   help="allow a target schema that differs from the source's")
    p.add_argument("--source-jdbc", help="JSON file with url and connection options")
    p.add_argument("--target-jdbc", help="JSON file with url and connection options")
    p.add_argument("--options", help="JSON file: full target name to delete_keys, global_keys, "
                                     "range_key, key_filter or validate of its load")
    p.add_argument("--at-once", type=int, default=4, help="loads that run at the same time")
    p.add_argument("--read-tasks", type=int, default=8, help="parallel reads of a database table")
    return p


def _connection(path: str) -> tuple[str, dict[str, str]]:
    with open(path) as f:
        options = json.load(f)
    return options.pop("url"), options


# a table's own options; lists become the tuples that a load's fields are
OPTIONS = ("delete_keys", "global_keys", "range_key", "key_filter", "validate")


def _options(path: str | None) -> dict[str, dict]:
    if not path:
        return {}
    with open(path) as f:
        found = json.load(f)
    for table, own in found.items():
        unknown = sorted(set(own) - set(OPTIONS))
        if unknown:
            raise ValueError(f"{table}: unknown options {', '.join(unknown)}")
    return {table: {k: tuple(v) if isinstance(v, list) else v for k, v in own.items()}
            for table, own in found.items()}


def _session(route: str, lasting: bool) -> SparkSession:
    """A session with the recommended settings where the site sets none."""
    site = SparkConf()
    builder = SparkSession.builder.appName(f"tidemark {route}")
    for key, value in RECOMMENDED_CONF.items():
        if not site.contains(key):
            builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if lasting:
        require_lasting_catalog(spark)
    return spark


def require_lasting_catalog(spark: SparkSession) -> None:
    """Table targets are known by the catalog, so it has to outlive the session."""
    if spark.conf.get("spark.sql.catalogImplementation") == "in-memory" and \
            not spark.conf.get("spark.sql.catalog.spark_catalog", ""):
        raise ValueError("table targets need a catalog that outlives the session: set "
                         "spark.sql.catalogImplementation to hive, or another spark_catalog")


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    """Returns the number of failed loads."""
    args = parser().parse_args(argv)
    spark = spark or _session(args.route, lasting=bool(args.warehouse) and not args.target_jdbc)
    now = datetime.fromisoformat(args.now) if args.now else datetime.now().replace(microsecond=0)
    mirror = control_table.is_mirror(args.route)

    def source_of(spec: LoadSpec) -> DataFrame:
        name = f"{spec.source_schema}.{spec.source_table}"
        if mirror or not args.source_jdbc:
            return spark.table(name)
        url, options = _connection(args.source_jdbc)
        split = jdbc.cuts(spec.load_type, spec.column, spec.second_last_run or spec.last_run, now,
                          args.read_tasks,
                          lambda: jdbc.bounds(spark, url, name, spec.column, options))
        # without a column that grows, rows are dealt by a hash of their key
        predicates = [] if split else jdbc.key_predicates(spec.keys, args.read_tasks)
        return jdbc.read(spark, url, table=name, split=split, connection=options,
                         predicates=predicates)

    def target_of(spec: LoadSpec):
        name = f"{spec.target_schema}.{spec.target_table}"
        if args.target_jdbc:
            url, options = _connection(args.target_jdbc)
            return JdbcTarget(spark, url, name, options)
        if not args.warehouse:
            raise ValueError("--warehouse is needed for table targets")
        return TableTarget(spark, name, f"{args.warehouse}/{spec.target_schema}/{spec.target_table}")

    outcomes = run_due(
        spark, ControlLog(spark, args.control), args.audit, route=args.route, schema=args.schema,
        load_type=args.load_type, now=now, load_id=args.load_id, source_of=source_of,
        target_of=target_of, group=args.group,
        tables=args.tables.split(",") if args.tables else None, archive_root=args.archive,
        drops=args.drops, special=args.other_schema, at_once=args.at_once,
        options=_options(args.options),
        claims=Claims(spark, args.claims) if args.claims else None)
    for outcome in outcomes:
        name = f"{outcome.spec.target_schema}.{outcome.spec.target_table}"
        print(f"{name}: {outcome.error or f'{outcome.rows} rows'}")
    if outcomes and any(o.error for o in outcomes):
        row = audit.failed_tables(audit.read(spark, args.audit), args.load_id).first()
        print(f"failed: {row.failed_tables}")
    elif not outcomes:
        print(f"no {args.load_type} {args.route} tables to load for schema {args.schema}")
    return sum(o.error is not None for o in outcomes)
