"""Where applied changes go."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WRITERS: dict[str, Callable[..., None]] = {}


def writer(mode: str):
    def put(f):
        WRITERS[mode] = f
        return f

    return put


def writer_for(mode: str) -> Callable[..., None]:
    """By name in any case."""
    if mode.lower() not in WRITERS:
        raise ValueError(f"unknown sink mode: {mode}")
    return WRITERS[mode.lower()]


def csv_lines(events: DataFrame, columns: list[str], separator: str = "|") -> DataFrame:
    """(line): the row of each event that is no delete; null is empty, nothing is quoted."""
    rows = events.where("op <> 'DELETE'")
    return rows.select(F.concat_ws(separator, *[F.coalesce(F.col(f"after.{c}").cast("string"), F.lit("")) for c in columns]).alias("line"))


def csv_header(columns: list[str], separator: str = "|") -> str:
    return separator.join(columns)


@writer("csv")
def write_csv(events: DataFrame, path: str, columns: list[str], header: bool = False, separator: str = "|", mode: str = "append") -> None:
    """Files of quoted CSV below path, columns in schema order."""
    rows = events.where("op <> 'DELETE'").select("after.*").select(*columns)
    rows.write.mode(mode).options(sep=separator, header=str(header).lower(), emptyValue="", quote='"').csv(path)


@writer("parquet")
def write_parquet(events: DataFrame, path: str, columns: list[str], header: bool = False, separator: str = "|", mode: str = "append") -> None:
    events.where("op <> 'DELETE'").select("after.*").select(*columns).write.mode(mode).parquet(path)


@writer("memory")
def write_memory(events: DataFrame, path: str, columns: list[str], header: bool = False, separator: str = "|", mode: str = "append") -> None:
    events.where("op <> 'DELETE'").select("after.*").select(*columns).createOrReplaceTempView(path)


def table_path(path: str, database: str, table: str) -> str:
    return f"{path}/{database}/{table}"


def write_tables(tables: dict[tuple[str, str], DataFrame], path: str, mode: str = "csv", header: bool = False, batch: int | None = None) -> None:
    """Typed events of each (database, table) below <path>/<database>/<table>; a batch that is written again replaces itself."""
    for (database, table), events in tables.items():
        at = table_path(path, database, table)
        columns = events.schema["after"].dataType.names
        if batch is None or mode.lower() == "memory":
            writer_for(mode)(events, at if mode.lower() != "memory" else table, columns, header=header)
        else:
            writer_for(mode)(events, f"{at}/batch={batch}", columns, header=header, mode="overwrite")
