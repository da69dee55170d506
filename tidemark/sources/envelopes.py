"""Change events and transaction metadata: encoding, decoding, sources, dead letters."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import Config
from tidemark.functions import values as V

SOURCE_TEXTS = ("version", "connector", "name", "snapshot", "db", "sequence", "schema", "table")
SOURCE_LONGS = ("ts_ms", "ts_us", "ts_ns", "txId", "lsn", "xmin")
SOURCE = "struct<" + ",".join([f"{n}:string" for n in SOURCE_TEXTS] + [f"{n}:bigint" for n in SOURCE_LONGS] + ["tx_id:bigint"]) + ">"
TRANSACTION = "struct<id:string,total_order:bigint,data_collection_order:bigint>"
PAYLOAD = f"struct<before:string,after:string,source:{SOURCE},op:string,ts_ms:bigint,ts_us:bigint,ts_ns:bigint,transaction:{TRANSACTION}>"
METADATA = "struct<status:string,id:string,event_count:bigint,ts_ms:bigint,data_collections:array<struct<data_collection:string,event_count:bigint>>>"


def image(row: T.StructType, struct: str | None = None) -> Column:
    """A row's columns as the JSON object that connectors send; nulls stay in it."""
    at = lambda n: F.col(f"{struct}.{n}" if struct else n)
    return F.struct(*[V.encode(at(f.name), f.dataType).alias(f.name) for f in row.fields])


def encode_changes(df: DataFrame, op: Column, table: str, before: Column | None, after: Column | None, order: Column, tx: Column | None = None, tx_order: Column | None = None, prefix: str = "tide", db: str = "shop") -> DataFrame:
    """(topic, value): one change event for each row of df. before and after are structs from image(), or None."""
    empty = F.lit(None).cast("string")
    source = F.struct(F.lit("shop").alias("name"), F.lit(db).alias("db"), F.lit(table).alias("table"), order.cast("long").alias("ts_ms"))
    txn = F.when(tx.isNotNull(), F.struct(tx.cast("string").alias("id"), tx_order.cast("long").alias("total_order"), tx_order.cast("long").alias("data_collection_order"))) if tx is not None else empty
    payload = F.struct((before if before is not None else empty).alias("before"), (after if after is not None else empty).alias("after"), source.alias("source"), op.alias("op"), order.cast("long").alias("ts_ms"), (order.cast("long") * 1000).alias("ts_us"), txn.alias("transaction"))
    return df.select(F.lit(f"{prefix}.{db}.{table}").alias("topic"), F.to_json(F.struct(payload.alias("payload")), {"ignoreNullFields": "false"}).cast("binary").alias("value"))


ROWS, TRANSACTIONS = "row-record", "transaction"


def read_kafka(spark: SparkSession, config: Config, kind: str = ROWS) -> DataFrame:
    """A stream of (topic, partition, offset, value) from Kafka; needs Spark's Kafka package.

    row-record: topics <prefix>.<database>.<table> of the included tables, new ones too. transaction: <prefix>.<suffix>.
    """
    return spark.readStream.format("kafka").options(**kafka_options(config, kind)).load().select("topic", "partition", "offset", "value")


def kafka_options(config: Config, kind: str = ROWS) -> dict[str, str]:
    """Options by the kind of topic; an unknown kind raises ValueError. Each kind reads under a group id of its own."""
    if kind == TRANSACTIONS:
        where, group = {"subscribe": f"{config.topic_prefix}.{config.transaction_topic_suffix}"}, f"{config.transaction_group_id}-{config.group_id}"
    elif kind == ROWS:
        tables = "|".join(map(re.escape, config.include_tables)) if config.include_tables else "[^.]+"
        where, group = {"subscribePattern": rf"{re.escape(config.topic_prefix)}\.{re.escape(config.capture_database)}\.(.+\.)?({tables})"}, f"{config.group_id}-rows"
    else:
        raise ValueError(f"no topics of kind {kind}")
    bound = {"maxOffsetsPerTrigger": str(config.max_offsets_per_trigger)} if config.max_offsets_per_trigger else {}
    return where | bound | {"kafka.bootstrap.servers": config.bootstrap_servers, "kafka.group.id": group, "startingOffsets": "earliest", "failOnDataLoss": "true"}


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """A stream of (topic, value) from a folder of Parquet files, in Kafka's place."""
    return spark.readStream.schema("topic string, value binary").parquet(path)


def read_stream(spark: SparkSession, config: Config, kind: str = ROWS) -> DataFrame:
    """From Kafka, or from the folder <source_path>/<kind> if the settings name one; (topic, value)."""
    if config.source_path:
        return read_files(spark, f"{config.source_path}/{kind}")
    return read_kafka(spark, config, kind).select("topic", "value")


def spread(df: DataFrame) -> DataFrame:
    """Rows of a batch dealt over all cores, if it has fewer partitions than there are cores; else df as it is, without a shuffle.

    For small inputs of one file or row group, before costly work on each row. An input of more partitions is never moved.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _not_empty(df: DataFrame) -> DataFrame:
    """Without tombstones: null or empty values."""
    return df.where("value IS NOT NULL AND octet_length(value) > 0")


def _events(rows: DataFrame, payload: str, before: Column, after: Column) -> DataFrame:
    """Change events of rows whose column `payload` is an envelope; what has no operation or an unknown one gets `error`."""
    here = {f.name.lower(): f for f in rows.schema[payload].dataType.fields}
    inside = lambda group: {f.name for f in here[group].dataType.fields} if group in here and isinstance(here[group].dataType, T.StructType) else set()
    from_source, from_tx = inside("source"), inside("transaction")
    p = lambda n, kind: F.col(f"{payload}.{n}") if n in here else F.lit(None).cast(kind)
    src = lambda n, kind: F.col(f"{payload}.source.{n}").cast(kind) if n in from_source else F.lit(None).cast(kind)
    tx = lambda n, kind: F.col(f"{payload}.transaction.{n}").cast(kind).alias(n) if n in from_tx else F.lit(None).cast(kind).alias(n)
    op = V.operation(p("op", "string"))
    bad = F.when(p("op", "string").isNull(), "unreadable message").when(op == "UNRECOGNIZED", F.concat(F.lit("unknown operation: "), p("op", "string")))
    source = F.struct(
        *[V.text_or_empty(src(n, "string")).alias(n) for n in SOURCE_TEXTS],
        *[V.long_or_zero(F.coalesce(src("txId", "bigint"), src("tx_id", "bigint")) if n == "txId" else src(n, "bigint")).alias(n) for n in SOURCE_LONGS],
    )
    there = F.col(f"{payload}.transaction").isNotNull() if "transaction" in here else F.lit(False)
    error = F.struct(bad.alias("message"), F.col("value").alias("original_data"), F.current_timestamp().alias("at"))
    return rows.select(
        "topic",
        op.alias("op"),
        *[V.long_or_zero(p(n, "bigint")).alias(n) for n in ("ts_ms", "ts_us", "ts_ns")],
        before.alias("before"),
        after.alias("after"),
        source.alias("source"),
        F.when(there, F.struct(tx("id", "string"), tx("total_order", "bigint"), tx("data_collection_order", "bigint"))).alias("transaction"),
        F.when(bad.isNotNull(), error).alias("error"),
        F.octet_length("value").cast("long").alias("bytes"),
    )


def decode_changes(df: DataFrame) -> DataFrame:
    """Change events from JSON (topic, value): tombstones (null or empty) go, what can't be read gets `error`.

    Missing texts of source become "", missing numbers 0; before and after stay JSON text.
    """
    text = F.col("value").cast("string")
    wrapped = F.from_json(text, f"struct<payload:{PAYLOAD}>")["payload"]
    rows = _not_empty(df).withColumn("__p", F.coalesce(wrapped, F.from_json(text, PAYLOAD)))
    return _events(rows, "__p", F.col("__p.before"), F.col("__p.after"))


def decode_avro_changes(df: DataFrame, row: T.StructType, event: str = "event", trim: bool = True) -> DataFrame:
    """Change events from decoded Avro (topic, value, event): as decode_changes and typed together.

    Images are structs already; fields of other case, absent ones, and values whose Avro schema has no logical type
    (decimals as bytes, dates as days, instants as microseconds) are brought to the row's types.
    """
    kind = df.schema[event].dataType
    images = {f.name.lower(): f for f in kind.fields}
    side = lambda n: V.avro_image(F.col(f"{event}.{images[n].name}"), images[n].dataType, row, trim) if n in images else F.lit(None).cast(row)
    return _events(_not_empty(df), event, side("before"), side("after"))


def dead_letters(events: DataFrame) -> DataFrame:
    return events.where("error IS NOT NULL").select("topic", F.col("error.message").alias("message"), F.col("error.original_data").alias("original_data"))


def typed(events: DataFrame, row: T.StructType, trim: bool = True, fold_case: bool = False) -> DataFrame:
    """Good events with before and after as typed structs; absent fields are null. fold_case: fields may come in upper case."""
    cases = [str, str.upper] if fold_case else [str]
    schemas = [T.StructType([T.StructField(case(f.name), V.wire(f.dataType)) for f in row.fields]) for case in cases]
    out = events.where("error IS NULL")
    for side in ("before", "after"):
        out = out.withColumns({f"__i{k}": F.from_json(side, schema) for k, schema in enumerate(schemas)})
        value = lambda i: F.coalesce(*[F.col(f"__i{k}.{schema[i].name}") for k, schema in enumerate(schemas)])
        there = F.col(side).isNotNull() & F.col("__i0").isNotNull()
        out = out.withColumn(side, F.when(there, F.struct(*[V.decode(value(i), f.dataType, trim).alias(f.name) for i, f in enumerate(row.fields)])))
        out = out.drop(*[f"__i{k}" for k in range(len(cases))])
    return out


def current(events: DataFrame) -> DataFrame:
    """Add `row`: the image that an event is about, before for a delete, else after."""
    return events.withColumn("row", F.when(F.col("op") == "DELETE", F.col("before")).otherwise(F.col("after")))


def decode_metadata(df: DataFrame) -> DataFrame:
    """Transaction metadata from JSON (value): status, id, event_count, ts_ms, data_collections; tombstones and unreadable ones go."""
    text = F.col("value").cast("string")
    m = F.coalesce(F.from_json(text, f"struct<payload:{METADATA}>")["payload"], F.from_json(text, METADATA))
    return _metadata(_not_empty(df).select(m.alias("m")))


def _metadata(rows: DataFrame) -> DataFrame:
    rows = rows.where("m.id IS NOT NULL")
    return rows.select(V.status(F.col("m.status")).alias("status"), "m.id", V.long_or_zero(F.col("m.event_count")).alias("event_count"), V.long_or_zero(F.col("m.ts_ms")).alias("ts_ms"), "m.data_collections")


def decode_avro_metadata(df: DataFrame, event: str = "event") -> DataFrame:
    """Transaction metadata from decoded Avro (value, event); absent fields are null or 0."""
    have = {f.name for f in df.schema[event].dataType.fields}
    one = lambda n, kind: (F.col(f"{event}.{n}") if n in have else F.lit(None)).cast(kind).alias(n)
    kinds = T._parse_datatype_string(METADATA)
    return _metadata(_not_empty(df).select(F.struct(*[one(f.name, f.dataType) for f in kinds]).alias("m")))


def from_avro(value: Column, schema: str) -> Column:
    """Decoded Avro, null where it can't be read; needs Spark's Avro package."""
    from pyspark.sql.avro.functions import from_avro as decode

    return decode(value, schema, {"mode": "PERMISSIVE"})
