"""Job entry points: ``spark-submit spinledger/__main__.py <job> ...`` or ``python -m spinledger``."""

from __future__ import annotations

import argparse
import os
import sys

if not __package__:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from spinledger.plans.ingest import (  # noqa: E402
    FILE_MODE,
    ROW_MODE,
    load,
    run_and_archive,
    run_batch,
    source_id_of,
    transform,
    validate,
)
from spinledger.schemas import Layout  # noqa: E402
from spinledger.session import build_session  # noqa: E402
from spinledger.sources.csv_tables import read_songs, read_users  # noqa: E402
from spinledger.sources.lines import read_lines  # noqa: E402
from spinledger.sources.listing import zero_length_files  # noqa: E402
from spinledger.streaming.pipeline import start_stream  # noqa: E402


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="spinledger")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, summary: str, *, tables: bool = True) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=summary)
        sub.add_argument("--raw-root", required=True, help="folder of the incoming files")
        sub.add_argument("--root", required=True, help="folder of all tables")
        sub.add_argument("--mode", choices=[FILE_MODE, ROW_MODE], default=FILE_MODE)
        if name != "stream":
            sub.add_argument("--object-key", required=True, help="file or folder below --raw-root")
        if tables:
            sub.add_argument("--songs", required=True, help="songs CSV")
            sub.add_argument("--users", required=True, help="users CSV")
            sub.add_argument("--no-rebalance", dest="rebalance", action="store_false", help="write straight from the join, for arrivals of one day")
        return sub

    job("validate", "judge the files of one key", tables=False)
    job("transform", "store the plays of a validated key")
    job("load", "refresh the KPI tables for a transformed key", tables=False)
    job("run", "validate, transform and load").add_argument("--archive-root", help="move a loaded key here")
    stream = job("stream", "run for every file that arrives below <raw-root>/streams")
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--archive-root")
    stream.add_argument("--max-files-per-trigger", type=int, help="default: all that wait")
    stream.add_argument("--continuous", action="store_true", help="keep running after the backlog")
    return top


def main(argv: list[str] | None = None) -> int:
    """Run a job; 1 if files were rejected, so that a caller can stop there."""
    args = parser().parse_args(argv)
    spark = build_session(f"spinledger-{args.job}")
    layout = Layout(args.root)
    metrics: dict[str, int] = {}
    if args.job == "stream":
        start_stream(
            f"{args.raw_root.rstrip('/')}/streams",
            read_songs(spark, args.songs),
            read_users(spark, args.users),
            layout,
            args.checkpoint,
            max_files_per_trigger=args.max_files_per_trigger,
            archive_path=args.archive_root,
            mode=args.mode,
            rebalance=args.rebalance,
            available_now=not args.continuous,
        ).awaitTermination()
        return 0

    path, source_id = f"{args.raw_root.rstrip('/')}/{args.object_key}", source_id_of(args.object_key)
    if args.job == "validate":
        lines, empty = read_lines(spark, path), zero_length_files(spark, path)
        metrics = validate(spark, lines, empty, layout, source_id, mode=args.mode)
    elif args.job == "load":
        metrics = load(spark, layout, source_id)
    else:
        songs, users = read_songs(spark, args.songs), read_users(spark, args.users)
        options = {"mode": args.mode, "rebalance": args.rebalance}
        if args.job == "transform":
            lines = read_lines(spark, path)
            metrics = transform(spark, lines, songs, users, layout, source_id, **options)
        elif args.archive_root:
            metrics = run_and_archive(
                spark, args.raw_root, args.archive_root, args.object_key, songs, users, layout, **options
            )
        else:
            metrics = run_batch(spark, path, songs, users, layout, source_id=source_id, **options)
    print(metrics)
    return 1 if metrics.get("files_rejected") else 0


if __name__ == "__main__":
    sys.exit(main())
