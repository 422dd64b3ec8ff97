"""Messages as a stream (an extension): first copies within a watermark, entities, counts by window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cauce.functions.registry import entities


def first_copies(messages: DataFrame, delay: str = "7 days") -> DataFrame:
    """MSG-11: a message id passes once while the watermark remembers it; later copies and messages without a time are dropped."""
    timed = messages.filter("received_at is not null and message_id is not null")
    return timed.withWatermark("received_at", delay).dropDuplicatesWithinWatermark(["message_id"])


def once(messages: DataFrame) -> DataFrame:
    """MSG-11 on a table: ``message_id, doc_id, veces``: the first copy of every message and how often it came."""
    return messages.filter("message_id is not null").groupBy("message_id").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("veces"))


def with_entities(messages: DataFrame) -> DataFrame:
    """MSG-4 on a stream or a table."""
    return messages.withColumn("entidades", entities(F.col("text")))


def volume(messages: DataFrame, window: str = "1 day", delay: str = "7 days") -> DataFrame:
    """Messages by window and source; a window is final once the watermark has passed it."""
    return messages.withWatermark("received_at", delay).groupBy(F.window("received_at", window), "source").agg(F.count("*").alias("mensajes"))
