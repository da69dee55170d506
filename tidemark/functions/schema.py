"""Schemas that travel with messages, as Spark types."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import types as T

#: Names of types on the wire and Spark's types for them (fixed values, as are the logical names below).
CONNECT = {"int8": T.ByteType, "int16": T.ShortType, "int32": T.IntegerType, "int64": T.LongType, "float": T.FloatType, "float32": T.FloatType, "double": T.DoubleType, "float64": T.DoubleType, "boolean": T.BooleanType, "string": T.StringType, "bytes": T.BinaryType}
AVRO = {"int": T.IntegerType, "long": T.LongType, "float": T.FloatType, "double": T.DoubleType, "boolean": T.BooleanType, "string": T.StringType, "bytes": T.BinaryType, "fixed": T.BinaryType, "enum": T.StringType}


class SchemaError(ValueError):
    """A schema that cannot be understood."""


def connect_type(node: dict) -> T.DataType:
    """Type of a Connect schema node: logical names first, unknown ones fall back to the physical type."""
    if "type" not in node:
        raise SchemaError(f"no type given for {node.get('field') or node}")
    kind, name, given = node["type"], node.get("name", ""), node.get("parameters") or {}
    if name == "org.apache.kafka.connect.data.Decimal":
        return T.DecimalType(int(given.get("connect.decimal.precision", 38)), int(given.get("scale", 0)))
    if name == "io.debezium.time.Date":
        return T.DateType()
    if name in ("io.debezium.time.MicroTimestamp", "io.debezium.time.Timestamp"):
        return T.TimestampNTZType()
    if kind == "struct":
        return T.StructType([T.StructField(f["field"].lower(), connect_type(f), bool(f.get("optional", True))) for f in node.get("fields", [])])
    if kind == "array":
        return T.ArrayType(connect_type(node["items"]))
    if kind == "map":
        return T.MapType(connect_type(node["keys"]), connect_type(node["values"]))
    if kind not in CONNECT:
        raise SchemaError(f"unsupported type: {kind}")
    return CONNECT[kind]()


def connect_row(schema: dict | str, image: str = "after") -> T.StructType:
    """The row type under `before` or `after` of an envelope schema."""
    node = json.loads(schema) if isinstance(schema, str) else schema
    for field in node.get("fields", []):
        if field.get("field") == image:
            got = connect_type(field)
            if not isinstance(got, T.StructType):
                raise SchemaError(f"{image} is no struct")
            return got
    raise SchemaError(f"no {image} in the schema")


def avro_type(node: dict | str | list) -> T.DataType:
    """Type of an Avro schema node; of a union its first branch that is not null."""
    if isinstance(node, list):
        branch = [b for b in node if b != "null"]
        if not branch:
            raise SchemaError("a union of null only")
        return avro_type(branch[0])
    if isinstance(node, str):
        node = {"type": node}
    kind, logical = node.get("type"), node.get("logicalType")
    if isinstance(kind, (dict, list)):
        return avro_type(kind)
    if logical == "decimal":
        return T.DecimalType(int(node["precision"]), int(node.get("scale", 0)))
    if logical == "date":
        return T.DateType()
    if logical in ("timestamp-millis", "timestamp-micros"):
        return T.TimestampType()
    if logical == "uuid":
        return T.StringType()
    if kind == "record":
        return T.StructType([T.StructField(f["name"].lower(), avro_type(f["type"]), isinstance(f["type"], list) and "null" in f["type"]) for f in node["fields"]])
    if kind == "array":
        return T.ArrayType(avro_type(node["items"]))
    if kind == "map":
        return T.MapType(T.StringType(), avro_type(node["values"]))
    if kind not in AVRO:
        raise SchemaError(f"unsupported Avro type: {kind}")
    return AVRO[kind]()


class Registry:
    """Row types and key columns by (database, table), whatever their case."""

    def __init__(self):
        self._rows: dict[tuple[str, str], tuple[T.StructType, tuple[str, ...]]] = {}
        self.avro: dict[tuple[str, str], str] = {}

    def put(self, database: str, table: str, row: T.StructType, keys: tuple[str, ...], unique: bool = True) -> None:
        """unique: whether the key columns are declared unique; others can't tell rows apart and are rejected."""
        if not unique or not keys:
            raise SchemaError(f"{database}.{table} has no unique key")
        names = {f.name.lower() for f in row.fields}
        if missing := [k for k in keys if k.lower() not in names]:
            raise SchemaError(f"key columns are not in the row: {missing}")
        self._rows[database.lower(), table.lower()] = row, tuple(k.lower() for k in keys)

    def get(self, database: str, table: str) -> tuple[T.StructType, tuple[str, ...]]:
        return self._rows[database.lower(), table.lower()]

    def tables(self) -> list[tuple[str, str]]:
        return sorted(self._rows)

    @classmethod
    def from_folder(cls, folder: str, database: str) -> Registry:
        """Files <table>.json: {"keys": [...], "unique": true, "schema": envelope schema of the connector or, under "avro", an Avro one}."""
        made = cls()
        for file in sorted(Path(folder).glob("*.json")):
            told = json.loads(file.read_text(encoding="utf-8"))
            if "avro" in told:
                image = next((f for f in told["avro"]["fields"] if f["name"] == "after"), None)
                row = avro_type(image["type"]) if image else None
            else:
                row = connect_row(told["schema"])
            if not isinstance(row, T.StructType):
                raise SchemaError(f"{file.name} describes no row")
            made.put(database, file.stem, row, tuple(told["keys"]), told.get("unique", True))
            made.avro[database.lower(), file.stem.lower()] = json.dumps(told["avro"]) if "avro" in told else ""
        return made
