"""Command line: download, drift, normalize, curate, load and run."""

from __future__ import annotations

import argparse
import os
import sys
from datetime import date
from pathlib import Path

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

from .functions.types import TypeMappingError
from .operators import drift
from .operators.database import DIALECTS, JdbcSink
from .operators.load import FLUSH_ROWS, Connection, LoaderConfigError, LoaderConnectionError, LoaderError, ParquetSink, Sink, execute, identifier, plan_years
from .plans import bootstrap, pipeline
from .plans.mapping import MappingError
from .plans.normalize import normalize
from .session import configure
from .sources import download
from .sources.files import drop_corrupt, month_files

TYPES = list(download.SERIES)
#: The environment variable that holds the database's password.
PASSWORD = "DRIFTWRIGHT_DB_PASSWORD"


def open_sink(spark: SparkSession, args: argparse.Namespace) -> Sink:
    """The target of a load; a database is provisioned, but by a dry run, which takes one that is not there as empty."""
    if args.sink == "parquet":
        return ParquetSink(spark, str(Path(args.data_dir) / "warehouse"))
    if PASSWORD not in os.environ:
        raise LoaderConfigError(f"set {PASSWORD}")
    database = args.database if not args.host else identifier(args.database)
    sink = JdbcSink(spark, Connection(args.host, database, args.user, os.environ[PASSWORD], args.port, identifier(args.schema)), args.dialect, args.flush_rows)
    if not args.dry_run:
        sink.provision()
        return sink
    try:
        with sink.connected():
            return sink
    except LoaderConnectionError:
        return ParquetSink(spark, str(Path(args.data_dir) / "no-such-database"))


def _parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="driftwright", description=__doc__)
    out.add_argument("command", choices=["download", "drift", "normalize", "curate", "load", "run"])
    out.add_argument("types", nargs="*", metavar="type", default=[])
    out.add_argument("--data-dir", default=".")
    out.add_argument("--recent", nargs="?", type=int, const=3)
    out.add_argument("--sample", default="100%")
    out.add_argument("--output")
    out.add_argument("--one-file", action="store_true")
    out.add_argument("--sink", choices=["parquet", "jdbc"], default="parquet", help="load into DIR/warehouse or into a database")
    out.add_argument("--dialect", choices=sorted(DIALECTS), default="sqlserver")
    out.add_argument("--host", default="localhost", help="empty for an embedded database")
    out.add_argument("--port", type=int, default=1433)
    out.add_argument("--database", default="taxi", help="for an embedded database its path")
    out.add_argument("--schema", default="dbo")
    out.add_argument("--user", default="sa")
    out.add_argument("--flush-rows", type=int, default=FLUSH_ROWS, help="rows of a batch")
    for flag in ("--verify-data", "--generic", "--full-refresh", "--dry-run", "--skip-download", "--download-only", "--load"):
        out.add_argument(flag, action="store_true")
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None, http=None, today: date | None = None, sleep=None) -> int:
    args = _parser().parse_args(argv)
    root, types, today = Path(args.data_dir), args.types or TYPES, today or date.today()
    session = lambda: configure(spark or SparkSession.builder.appName("driftwright").getOrCreate())

    def place(folder: str):
        return lambda name: str(root / folder / name)

    raw, out, maps = map(place, ("raw", "normalized", "mappings"))

    def fetch(name: str) -> int:
        own, extra = http or download.Http(), {"sleep": sleep} if sleep else {}
        drop_corrupt(raw(name), session())
        walk = download.recent(own, name, root / "raw", args.recent, today, **extra) if args.recent else download.full(own, name, root / "raw", today, **extra)
        print(f"{name}: {walk.downloaded} downloaded, {walk.gave_up} given up")
        return 2 if walk.gave_up and not walk.downloaded else 0

    def tidy(name: str) -> int:
        return normalize(session(), name, raw(name), f"{maps(name)}.yaml", out(name), args.sample, args.one_file)

    def put(name: str) -> int:
        own = session()
        try:
            sink, months = open_sink(own, args), month_files(own, out(name))
            plans = plan_years(own, months, sink, name, args.full_refresh)
        except (LoaderError, PySparkException) as problem:
            print(problem, file=sys.stderr)
            return 2
        code = 0
        for plan in plans:
            print(f"{name} {plan.year}: {plan.action} {list(plan.months)}")
            try:
                if not args.dry_run:
                    execute(own, plan, months, sink, name)
            except (LoaderConnectionError, LoaderConfigError, TypeMappingError) as problem:
                print(problem, file=sys.stderr)
                return 2
            except (LoaderError, PySparkException, Py4JError) as problem:  # this year failed, the others go on
                print(f"{name} {plan.year}: {problem}", file=sys.stderr)
                code = 1
        return code

    if args.command == "drift":
        if not (root / "raw").exists():
            print(f"no folder {root / 'raw'}", file=sys.stderr)
            return 1
        text = drift.report(drift.analyze_all(session(), {t: raw(t) for t in types}, args.verify_data, args.generic))
        Path(args.output).write_text(text) if args.output else print(text)
        return 0
    if args.command == "curate":
        results, code = {}, 0
        for name in types:
            try:
                results[name] = bootstrap.curate(session(), raw(name), name, f"{maps(name)}.yaml", today.isoformat())
            except (MappingError, RuntimeError, FileNotFoundError) as problem:
                print(problem, file=sys.stderr)
                code = 2
        print(bootstrap.curation_report(results))
        return code
    if args.command == "run":
        try:
            planned = pipeline.stages(args.load, args.skip_download, args.download_only)
        except ValueError as problem:
            print(problem, file=sys.stderr)
            return 2
        if args.dry_run:
            print("\n".join(f"{t}: {', '.join(planned)}" for t in types))
            return 0

        def alone(stage: str, work):
            """A stage that breaks is a failed stage of its type: the other types go on."""

            def run(name: str) -> int:
                try:
                    return work(name)
                except Exception as problem:  # noqa: BLE001  whatever it is, it is this stage's outcome
                    print(f"{name} {stage}: {problem}", file=sys.stderr)
                    return 2

            return run

        work = {pipeline.DOWNLOAD: fetch, pipeline.NORMALIZE: tidy, pipeline.LOAD: put}
        runs, code = pipeline.run(types, planned, {stage: alone(stage, own) for stage, own in work.items()})
        print(pipeline.summary(runs))
        return code
    return max({"download": fetch, "normalize": tidy, "load": put}[args.command](t) for t in types)


if __name__ == "__main__":
    sys.exit(main())
