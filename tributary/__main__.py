"""Jobs from the command line, for spark-submit.

    python -m tributary publish-stories --lists top.json new.json --items items.json ...
    python -m tributary ingest --bootstrap host:9092 --root s3a://lake --duration 30
"""

from __future__ import annotations

import argparse
import os

from tributary import jobs, schemas, session
from tributary.operators import quality


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tributary")
    commands = top.add_subparsers(dest="command", required=True)

    stories = commands.add_parser("publish-stories")
    stories.add_argument("--lists", nargs="+", required=True)
    stories.add_argument("--items", required=True)
    events = commands.add_parser("publish-events")
    events.add_argument("--pages", required=True)
    videos = commands.add_parser("publish-videos")
    videos.add_argument("--popular", required=True)
    videos.add_argument("--searches", nargs="*", default=[])
    videos.add_argument("--details", required=True)
    for command in (stories, events, videos):
        command.add_argument("--state", required=True)
        command.add_argument("--limit", type=int)
        target = command.add_mutually_exclusive_group(required=True)
        target.add_argument("--bootstrap")
        target.add_argument("--replay")

    landing = commands.add_parser("ingest")
    landing.add_argument("--root", required=True)
    landing.add_argument("--duration", type=int)
    landing.add_argument("--max-offsets", type=int, default=10_000_000, help="records of a topic per batch")
    landing.add_argument("--min-partitions", type=int, help="tasks to read a topic with, at least")
    landing.add_argument("--max-files", type=int, default=1000, help="replay files per batch")
    source = landing.add_mutually_exclusive_group(required=True)
    source.add_argument("--bootstrap")
    source.add_argument("--replay")

    for name in ("silver", "check", "audit"):
        command = commands.add_parser(name)
        command.add_argument("--root", required=True)
        if name == "silver":
            command.add_argument("--full", action="store_true", help="start over from all of bronze")
        if name == "check":
            command.add_argument("--suites", help="JSON rule suites, a file or a folder")
            command.add_argument("--checkpoint", help="JSON checkpoint")
    for command in commands.choices.values():
        command.add_argument("--store-endpoint", help="object store; its keys come from the named variables")
        command.add_argument("--store-access-key-variable", default="AWS_ACCESS_KEY_ID")
        command.add_argument("--store-secret-key-variable", default="AWS_SECRET_ACCESS_KEY")
    return top


def store_options(args: argparse.Namespace) -> dict[str, str] | None:
    """Object-store settings, if an endpoint is given; keys never stand on the command line."""
    if not args.store_endpoint:
        return None
    keys = [os.environ[args.store_access_key_variable], os.environ[args.store_secret_key_variable]]
    return session.object_store_options(args.store_endpoint, *keys)


def main(arguments: list[str] | None = None) -> int:
    args = parser().parse_args(arguments)
    kafka = getattr(args, "bootstrap", None)
    spark = session.session(
        f"tributary-{args.command}",
        kafka=bool(kafka),
        streaming=args.command == "ingest",
        store=store_options(args),
    )
    if args.command.startswith("publish"):
        deliver = jobs.to_broker(kafka) if kafka else jobs.to_replay(args.replay)
        if args.command == "publish-stories":
            count = jobs.publish_stories(spark, args.lists, args.items, args.state, deliver, args.limit)
        elif args.command == "publish-events":
            count = jobs.publish_events(spark, args.pages, args.state, deliver, args.limit)
        else:
            count = jobs.publish_videos(
                spark, args.popular, args.searches, args.details, args.state, deliver, args.limit
            )
        print(f"published {count} messages")
        return 0
    if args.command == "ingest":
        if kafka:
            streams = jobs.topic_streams(
                spark, kafka, max_offsets_per_trigger=args.max_offsets, min_partitions=args.min_partitions
            )
            jobs.land(spark, streams, args.root, args.duration)
        else:
            jobs.land_available(jobs.replay_streams(spark, args.replay, args.max_files), args.root)
        return 0
    if args.command == "silver":
        for name in schemas.SOURCES:
            print(jobs.build_silver(spark, args.root, name, full=args.full))
        return 0
    if args.command == "check":
        checks = jobs.check_silver(spark, args.root, suites=args.suites, checkpoint=args.checkpoint)
    else:
        checks = jobs.audit_landing(spark, args.root)
    verdict = quality.tally(checks).first()
    print(f"{verdict['passed']} passed, {verdict['failed']} failed")
    return 0 if verdict["success"] else 1


if __name__ == "__main__":
    raise SystemExit(main())
