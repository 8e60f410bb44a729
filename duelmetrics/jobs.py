"""The jobs as commands for spark-submit.

    spark-submit run_job.py ingest    --landed DIR --root DIR [--ingested-at ISO] [--players a,b]
                                      [--months 2025-01,2025-02] [--gather] [--allow-rejects]
    spark-submit run_job.py update    --landed DIR --root DIR [--ingested-at ISO] [--players a,b]
                                      [--months 2025-01,2025-02] [--allow-rejects]
                                      [--grain as_written] [--result-map lose=loss,won=win]
    spark-submit run_job.py transform --root DIR [--as-of ISO] [--players a,b,c] [--grain as_written]
                                      [--key game_url,username] [--result-map lose=loss,won=win]
                                      [--with-text]
    spark-submit run_job.py validate  --root DIR [--fail]
    spark-submit run_job.py repair    --root DIR

``ingest`` replaces the raw tables by what has landed, ``update`` adds what has landed since the last
update and brings the marts up to it; a root is kept by one of the two.

Each command raises, and so ends with an error, when a check it must hold fails.
"""

import argparse
from datetime import UTC, datetime

from pyspark.sql import SparkSession

from duelmetrics import fixed_values as fixed
from duelmetrics.plans import incremental, pipeline
from duelmetrics.quality.checks import DataCheckFailed, summarize


def _now() -> str:
    return datetime.now(UTC).replace(tzinfo=None).isoformat()


def _listed(text: str) -> list[str]:
    return text.split(",")


def _pairs(text: str) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in text.split(","))


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    commands = parser.add_subparsers(dest="command", required=True)
    ingest = commands.add_parser("ingest", help="landed payloads to raw tables")
    ingest.add_argument("--landed", required=True)
    ingest.add_argument("--ingested-at", default=_now())
    ingest.add_argument("--more-than", type=int, default=fixed.MIN_RAW_GAMES)
    ingest.add_argument("--players", type=_listed, help="load these players only")
    ingest.add_argument("--months", type=_listed, help="load these months only")
    ingest.add_argument("--gather", action="store_true", help="a player's games share files")
    ingest.add_argument("--allow-rejects", action="store_true", help="load what is readable")
    transform = commands.add_parser("transform", help="raw tables to marts, tests, freshness")
    transform.add_argument("--as-of", default=_now())
    transform.add_argument("--players", type=_listed, default=fixed.TRACKED_PLAYERS)
    transform.add_argument("--key", type=_listed, default=["game_url"])
    transform.add_argument("--result-map", type=_pairs, help="other result codes")
    transform.add_argument("--grain", choices=["day", "as_written"], default="day")
    transform.add_argument("--with-text", action="store_true", help="write stg_games too")
    validate = commands.add_parser("validate", help="expectation suites")
    validate.add_argument("--fail", action="store_true", help="end with an error on a failure")
    repair = commands.add_parser("repair", help="one row per game and player in the raw tables")
    update = commands.add_parser("update", help="what landed since the last update, up to the marts")
    update.add_argument("--landed", required=True)
    update.add_argument("--ingested-at", default=_now())
    update.add_argument("--players", type=_listed, help="load these players only")
    update.add_argument("--months", type=_listed, help="load these months only")
    update.add_argument("--allow-rejects", action="store_true", help="load what is readable")
    update.add_argument("--grain", choices=["day", "as_written"], default="day")
    update.add_argument("--result-map", type=_pairs, help="other result codes")
    for command in (ingest, update, transform, validate, repair):
        command.add_argument("--root", required=True)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _arguments(argv)
    spark = spark or SparkSession.builder.appName(f"duelmetrics-{args.command}").getOrCreate()
    if args.command == "ingest":
        done = pipeline.run_ingestion(
            spark,
            args.landed,
            args.root,
            args.ingested_at,
            args.more_than,
            args.gather,
            args.players,
            args.months,
            args.allow_rejects,
        )
        for source, lines in done.lines.items():
            print(f"{source}: {lines} lines, {done.rejected[source]} rejected")
        done.missing.show(truncate=False)
    elif args.command == "update":
        loaded = incremental.run_update(
            spark,
            args.landed,
            args.root,
            args.ingested_at,
            args.grain,
            args.result_map,
            players=args.players,
            months=args.months,
            allow_rejects=args.allow_rejects,
        )
        for source, files in loaded.files.items():
            print(f"{source}: {files} new files, {loaded.lines[source]} lines, {loaded.rejected[source]} rejected")
    elif args.command == "transform":
        fresh = pipeline.run_transformation(
            spark,
            args.root,
            args.as_of,
            args.players,
            key=args.key,
            result_map=args.result_map,
            grain=args.grain,
            with_text=args.with_text,
        )
        fresh.show(truncate=False)
        if not fresh.filter("status = 'error'").isEmpty():
            raise DataCheckFailed("a source is stale")
    elif args.command == "validate":
        results = pipeline.expectation_results(spark, args.root, args.fail)
        results.show(results.count(), truncate=False)  # one row per declared expectation
        summarize(results).show(truncate=False)
    else:
        pipeline.run_repair(spark, args.root)
