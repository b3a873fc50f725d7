"""Streaming intake of post messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tidewatch.constants import MAX_OFFSETS_PER_TRIGGER, POST_TOPIC


def read_message_stream(
    spark: SparkSession,
    fmt: str = "kafka",
    path_or_topic: str = POST_TOPIC,
    max_per_trigger: int | None = None,
    starting: str = "latest",
    schema: StructType | str = "value string",
    **options: str,
) -> DataFrame:
    """An unbounded frame with a ``value`` column.

    ``kafka`` takes a topic, a start position (``latest`` or ``earliest``) and an offset cap per
    trigger (MAX_OFFSETS_PER_TRIGGER by default, 0 lifts it); it needs the connector package on the cluster and
    ``kafka.bootstrap.servers`` among ``options``. Any file format takes a folder and caps files instead, by default
    not at all.
    """
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = reader.option("subscribe", path_or_topic).option("startingOffsets", starting)
        offsets = MAX_OFFSETS_PER_TRIGGER if max_per_trigger is None else max_per_trigger
        if offsets:
            reader = reader.option("maxOffsetsPerTrigger", offsets)
        return reader.options(**options).load()
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    return reader.schema(schema).options(**options).load(path_or_topic)
