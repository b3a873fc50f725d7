"""The streaming job: ``python -m tidewatch.plans.processor_job --servers … --profile … --posts … --checkpoint …``.

Reads post messages from a topic, enriches them and appends them to the posts table. With ``--stage-only`` they are stored
as they are cleaned, for the batch load.
"""

from __future__ import annotations

import argparse
from functools import partial

from tidewatch import session
from tidewatch.constants import POST_TOPIC
from tidewatch.operators.language import load_language_profile
from tidewatch.plans.enrichment import Resources, enrich_posts
from tidewatch.sources import read_message_stream
from tidewatch.streaming import run_enrichment


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--servers", required=True, help="brokers of the topic")
    parser.add_argument("--topic", default=POST_TOPIC)
    parser.add_argument("--starting", default="latest", choices=("latest", "earliest"))
    parser.add_argument("--posts", required=True, help="where the posts go")
    parser.add_argument("--checkpoint", required=True, help="where the stream keeps its progress")
    what = parser.add_mutually_exclusive_group(required=True)
    what.add_argument("--profile", help="a written language profile")
    what.add_argument("--stage-only", action="store_true")
    args = parser.parse_args(argv)
    spark = session.build("post-processor")
    options = {"kafka.bootstrap.servers": args.servers}
    messages = read_message_stream(spark, path_or_topic=args.topic, starting=args.starting, **options)
    enrich = None
    if args.profile:
        resources = Resources(load_language_profile(spark.read.parquet(args.profile)))
        enrich = partial(enrich_posts, resources=resources, key="post_key", checked=True)  # the stream drops repeats
    run_enrichment(messages.selectExpr("CAST(value AS STRING) AS value"), enrich, args.posts, args.checkpoint).awaitTermination()


if __name__ == "__main__":
    main()
