"""Publishing: raw session tables to keyed messages in their topics."""

from __future__ import annotations

from pyspark.sql import DataFrame

from starmart.operators import events
from starmart.sources.topics import to_messages, write_topics

MAPPERS = {
    "race_result": events.race_result_messages,
    "pit_stop": events.pit_stop_messages,
    "telemetry": events.telemetry_messages,
    "weather": events.weather_messages,
}


def session_messages(rows: DataFrame, event_type: str, prefix: str = "", **settings) -> DataFrame:
    """(topic, key, value) of a session table; ``settings`` go to the mapper (``now``, ``sample_rate``, ...)."""
    return to_messages(MAPPERS[event_type](rows, **settings), event_type, prefix)


def publish(rows: DataFrame, event_type: str, servers: str, prefix: str = "", **settings) -> None:
    write_topics(session_messages(rows, event_type, prefix, **settings), servers)
