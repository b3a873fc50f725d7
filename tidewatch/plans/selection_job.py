"""The feed job: ``python -m tidewatch.plans.selection_job --servers … --rejects … --checkpoint …``.

Reads raw events of the feed from a topic, sends the posts among them on as messages to another, and keeps the other events.
"""

from __future__ import annotations

import argparse

from tidewatch import session
from tidewatch.constants import POST_TOPIC
from tidewatch.sources import read_message_stream
from tidewatch.streaming import run_selection


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--servers", help="brokers of the topics; folders take their place without it")
    parser.add_argument("--events", required=True, help="topic of raw events, or a folder of text files")
    parser.add_argument("--messages", default=POST_TOPIC, help="topic of post messages, or a folder")
    parser.add_argument("--starting", default="latest", choices=("latest", "earliest"))
    parser.add_argument("--rejects", required=True, help="where events that are no posts go")
    parser.add_argument("--checkpoint", required=True, help="where the stream keeps its progress")
    parser.add_argument("--once", action="store_true", help="stop when everything that is there has been read")
    args = parser.parse_args(argv)
    spark = session.build("post-selection")
    fmt = "kafka" if args.servers else "text"
    options = {"kafka.bootstrap.servers": args.servers} if args.servers else {}
    events = read_message_stream(spark, fmt, args.events, starting=args.starting, **options)
    trigger = {"availableNow": True} if args.once else None
    run_selection(events, args.rejects, args.checkpoint, args.messages, fmt, trigger, **options).awaitTermination()


if __name__ == "__main__":
    main()
