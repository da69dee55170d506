"""Settings of an ingestion run: an immutable value, read from a properties file or made in code."""

from __future__ import annotations

import argparse
from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class Config:
    """Durations are milliseconds, also in files, whose shipped value of the transaction timeout is as low as 300.

    include_tables empty: all tables. source_path: folders of files in Kafka's place. max_offsets_per_trigger 0: no bound.
    """

    sink_mode: str = "csv"
    csv_path: str = "./data"
    csv_header: bool = False
    topic_prefix: str = ""
    capture_database: str = ""
    include_tables: tuple[str, ...] = ()
    bootstrap_servers: str = ""
    group_id: str = ""
    value_format: str = "json"
    transaction_topic_suffix: str = "transaction"
    transaction_group_id: str = "transaction_consumer"
    transaction_timeout: int = 300_000
    schema_folder: str = ""
    source_path: str = ""
    state_path: str = ""
    max_offsets_per_trigger: int = 0
    flush_interval_ms: int = 5000
    max_retries: int = 3
    monitor_enabled: bool = True


#: Property names (fixed values) and the fields that they set.
PROPERTIES = {
    "sink.mode": "sink_mode",
    "sink.csv.path": "csv_path",
    "sink.csv.enable_header": "csv_header",
    "topic.prefix": "topic_prefix",
    "consumer.capture_database": "capture_database",
    "consumer.include_tables": "include_tables",
    "bootstrap.servers": "bootstrap_servers",
    "group.id": "group_id",
    "value.deserializer": "value_format",
    "transaction.topic.suffix": "transaction_topic_suffix",
    "transaction.topic.group_id": "transaction_group_id",
    "transaction.timeout": "transaction_timeout",
    "sink.schema.folder": "schema_folder",
    "source.path": "source_path",
    "sink.state.path": "state_path",
    "source.max_offsets_per_trigger": "max_offsets_per_trigger",
    "sink.flush.interval.ms": "flush_interval_ms",
    "sink.max.retries": "max_retries",
    "sink.monitor.enabled": "monitor_enabled",
    "sink.monitor.enable": "monitor_enabled",
}


def parse(text: str) -> Config:
    """A Config from the lines of a properties file; unknown names are ignored, bad values raise ValueError."""
    kinds = {f.name: f.type for f in fields(Config)}
    found: dict = {}
    for line in text.splitlines():
        name, eq, value = line.strip().partition("=")
        if not eq or name.startswith(("#", "!")) or name.strip() not in PROPERTIES:
            continue
        field, value = PROPERTIES[name.strip()], value.strip()
        if kinds[field] == "bool":
            found[field] = value.lower() == "true"
        elif kinds[field] == "int":
            found[field] = int(value)
        elif kinds[field].startswith("tuple"):
            found[field] = tuple(x.strip() for x in value.split(",") if x.strip())
        else:
            found[field] = value
    if "avro" in str(found.get("value_format", "")).lower():
        found["value_format"] = "avro"
    elif "value_format" in found:
        found["value_format"] = "json"
    return replace(Config(), **found)


def from_args(args: list[str]) -> Config:
    """-c / --config FILE"""
    parser = argparse.ArgumentParser(prog="tidemark")
    parser.add_argument("-c", "--config", required=True)
    with open(parser.parse_args(args).config, encoding="utf-8") as f:
        return parse(f.read())
