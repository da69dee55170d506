"""Named queries over the test tables, and the SQL that each is held against.

The tables are encoded as change logs and decoded again. L(orders): a snapshot of every row, an
update where o_orderkey % 7 = 0 (status U, price + 1), a delete where o_orderkey % 11 = 0.
X(lineitem): a transaction for each order, its rows numbered over all columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import Config
from tidemark.functions import values as V
from tidemark.functions.schema import Registry
from tidemark.operators import apply as A
from tidemark.operators import metrics as M
from tidemark.operators import routing as R
from tidemark.operators import sinks as S
from tidemark.operators import transactions as X
from tidemark.sources import envelopes as E
from tidemark.sources.folders import fresh
from tidemark.streaming import assembler as Z
from tidemark.streaming.ingest import Ingestion

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}
MONEY = T.DecimalType(15, 2)


def query(name: str, sql: str | None = None):
    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return put


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table with money as decimals and order dates as dates, as the source databases have them."""
    df = spark.read.parquet(f"{sf}/{name}.parquet")
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType) and name != "events":
            df = df.withColumn(f.name, F.col(f.name).cast(MONEY))
        elif f.name.endswith("date"):
            df = df.withColumn(f.name, F.col(f.name).cast("date"))
    return df


def snapshot(spark: SparkSession, sf: str, name: str) -> tuple[DataFrame, T.StructType]:
    df = E.spread(read(spark, sf, name))
    log = E.encode_changes(df, F.lit("r"), name, None, E.image(df.schema), F.lit(1))
    return E.decode_changes(log), df.schema


#: Columns of the tables that are read back whole, and the SQL type of those that read() casts.
TABLES = {
    "region": "r_regionkey, r_name",
    "nation": "n_nationkey, n_name, n_regionkey",
    "supplier": "s_suppkey, s_name, s_nationkey, CAST(s_acctbal AS DECIMAL(15,2)) AS s_acctbal",
    "customer": "c_custkey, c_name, c_nationkey, CAST(c_acctbal AS DECIMAL(15,2)) AS c_acctbal, c_mktsegment",
    "part": "p_partkey, p_name, p_brand, p_type, p_size, CAST(p_retailprice AS DECIMAL(15,2)) AS p_retailprice",
    "orders": "o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(15,2)) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority",
    "lineitem": "l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS DECIMAL(15,2)) AS l_quantity, CAST(l_extendedprice AS DECIMAL(15,2)) AS l_extendedprice, CAST(l_discount AS DECIMAL(15,2)) AS l_discount, CAST(l_tax AS DECIMAL(15,2)) AS l_tax, l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate",
    "events": "event_id, ts, user_id, event_type, value, props",
}


def _decode_table(name: str):
    def run(spark, sf):
        log, row = snapshot(spark, sf, name)
        return E.typed(log, row, trim=False).select("after.*")

    return run


for _name, _columns in TABLES.items():
    query(f"decode_snapshot_{_name}", f"SELECT {_columns} FROM {_name}")(_decode_table(_name))


@query("decode_decimal", "SELECT o_orderkey, CAST(-CAST(o_totalprice AS DECIMAL(15,2)) AS DECIMAL(15,2)) AS small, CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS DECIMAL(38,2)) AS large FROM orders")
def decode_decimal(spark, sf):
    df = read(spark, sf, "orders").select("o_orderkey", V.encode_decimal((-F.col("o_totalprice")).cast(MONEY), 2).alias("n"), V.encode_decimal(F.col("o_totalprice"), 2).alias("p"))
    return df.select("o_orderkey", V.decode_decimal(F.col("n"), 15, 2).alias("small"), V.decode_decimal(F.col("p"), 38, 2).alias("large"))


@query("decode_date", "SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS d FROM lineitem")
def decode_date(spark, sf):
    df = read(spark, sf, "lineitem")
    return df.select("l_orderkey", "l_linenumber", V.decode(V.encode(F.col("l_shipdate"), T.DateType()), T.DateType()).alias("d"))


@query("decode_trim", "SELECT c_custkey, c_name FROM customer")
def decode_trim(spark, sf):
    df = read(spark, sf, "customer").select("c_custkey", F.rpad("c_name", 40, " ").alias("c_name"))
    log = E.encode_changes(df, F.lit("r"), "customer", None, E.image(df.schema), F.lit(1))
    return E.typed(E.decode_changes(log), df.schema).select("after.*")


@query("decode_trim_both", "SELECT c_custkey, c_name FROM customer")
def decode_trim_both(spark, sf):
    df = read(spark, sf, "customer").select("c_custkey", F.concat(F.lit(" \t\n "), "c_name", F.lit(" \r\x01 ")).alias("c_name"))
    log = E.encode_changes(df, F.lit("r"), "customer", None, E.image(df.schema), F.lit(1))
    return E.typed(E.decode_changes(log), df.schema).select("after.*")


@query("decode_binary", "SELECT c_custkey, hex(c_name) AS raw, CAST(NULL AS VARCHAR) AS none FROM customer")
def decode_binary(spark, sf):
    df = read(spark, sf, "customer").select("c_custkey", F.col("c_name").cast("binary").alias("raw"), F.lit(None).cast("binary").alias("none"))
    log = E.encode_changes(df, F.lit("r"), "customer", None, E.image(df.schema), F.lit(1))
    return E.typed(E.decode_changes(log), df.schema).select("after.c_custkey", F.hex("after.raw").alias("raw"), F.hex("after.none").alias("none"))


@query("decode_short_decimal", "SELECT o_orderkey, CAST(-CAST(o_totalprice AS DECIMAL(15,2)) AS DECIMAL(15,2)) AS n, CAST(o_custkey % 3 - 1 AS DECIMAL(15,2)) AS s, CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS DECIMAL(38,2)) AS large FROM orders")
def decode_short_decimal(spark, sf):
    """Decimals in as few bytes as hold them, as connectors send them."""
    df = read(spark, sf, "orders")
    short = lambda c: F.base64(F.unhex(F.regexp_replace(F.hex(F.unbase64(V.encode_decimal(c, 2))), "^(00)+(?=[0-7].)|^(FF)+(?=[89A-F].)", "")))
    back = lambda c, p: V.decode_decimal(short(c.cast(MONEY)), p, 2)
    return df.select("o_orderkey", back(-F.col("o_totalprice"), 15).alias("n"), back(F.col("o_custkey") % 3 - 1, 15).alias("s"), back(F.col("o_totalprice"), 38).alias("large"))


@query("decode_avro", f"SELECT {TABLES['orders']} FROM orders")
def decode_avro(spark, sf):
    """Records as the Avro reader gives them, decimals as bytes, dates as days and names in upper case."""
    df = read(spark, sf, "orders")
    sent = {f.name: F.unbase64(V.encode_decimal(F.col(f.name), 2)) if isinstance(f.dataType, T.DecimalType) else F.unix_date(f.name) if isinstance(f.dataType, T.DateType) else F.col(f.name) for f in df.schema.fields}
    event = F.struct(F.lit(None).cast("struct<O_ORDERKEY:bigint>").alias("before"), F.struct(*[c.alias(n.upper()) for n, c in sent.items()]).alias("after"), F.struct(F.lit("shop").alias("db"), F.lit("orders").alias("table")).alias("source"), F.lit("r").alias("op"), F.lit(1).cast("long").alias("ts_ms"))
    return E.decode_avro_changes(df.select(F.lit("tide.shop.orders").alias("topic"), F.lit(b"x").alias("value"), event.alias("event")), df.schema).select("after.*")


@query("decode_avro_transactions", "SELECT 'tx' || l_orderkey AS tx_id, count(*) AS expected FROM lineitem GROUP BY 1")
def decode_avro_transactions(spark, sf):
    each = spark.read.parquet(f"{sf}/lineitem.parquet").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    told = F.array(F.struct(F.lit("shop.lineitem").alias("data_collection"), F.col("n").alias("event_count")))
    event = F.struct(F.lit("END").alias("status"), F.concat(F.lit("tx"), "l_orderkey").alias("id"), F.lit(1).cast("long").alias("ts_ms"), told.alias("data_collections"))
    got = E.decode_avro_metadata(each.select(F.lit(b"x").alias("value"), event.alias("event")))
    return got.where("status = 'END'").select(F.col("id").alias("tx_id"), F.col("data_collections")[0]["event_count"].alias("expected"))


@query("tombstones_tx", "SELECT count(*) AS n FROM orders WHERE o_orderkey % 4 > 1")
def tombstones_tx(spark, sf):
    told = F.to_json(F.struct(F.struct(F.lit("BEGIN").alias("status"), F.col("o_orderkey").cast("string").alias("id")).alias("payload"))).cast("binary")
    value = F.when(F.col("o_orderkey") % 4 == 0, F.lit(None)).when(F.col("o_orderkey") % 4 == 1, F.lit(b"")).otherwise(told)
    return E.decode_metadata(read(spark, sf, "orders").select(value.alias("value"))).agg(F.count("*").alias("n"))


@query("source_info", "SELECT o_orderkey, 'shop' AS name, 'shop' AS db, 'orders' AS \"table\", '' AS version, CAST(0 AS BIGINT) AS lsn, o_orderkey AS ts_ms FROM orders")
def source_info(spark, sf):
    df = read(spark, sf, "orders")
    log = E.encode_changes(df, F.lit("r"), "orders", None, E.image(df.schema), F.col("o_orderkey"))
    got = E.typed(E.decode_changes(log), df.schema)
    return got.select("after.o_orderkey", *[F.col(f"source.{n}").alias(n) for n in ("name", "db", "table", "version", "lsn", "ts_ms")])


@query("current_row", "SELECT 'DELETE' AS op, o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 11 = 0 UNION ALL SELECT 'UPDATE', o_orderkey, 'U' FROM orders WHERE o_orderkey % 7 = 0 UNION ALL SELECT 'SNAPSHOT', o_orderkey, o_orderstatus FROM orders")
def current_row(spark, sf):
    """The image that each event is about: before of deletes, after of others."""
    return E.current(orders_log(spark, sf)[0]).select("op", "row.o_orderkey", "row.o_orderstatus")


@query("decode_null", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(15,2)) END AS o_totalprice, CAST(NULL AS INTEGER) AS absent FROM orders")
def decode_null(spark, sf):
    df = read(spark, sf, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")).alias("o_orderstatus"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice")).alias("o_totalprice"))
    log = E.encode_changes(df, F.lit("c"), "orders", None, E.image(df.schema), F.lit(1))
    return E.typed(E.decode_changes(log), T.StructType(df.schema.fields + [T.StructField("absent", T.IntegerType())])).select("after.*")


CODES = "CASE event_id % 6 WHEN 0 THEN 'c' WHEN 1 THEN 'U' WHEN 2 THEN 'd' WHEN 3 THEN 'r' WHEN 4 THEN 'x' ELSE NULL END"
OPS = "CASE event_id % 6 WHEN 0 THEN 'INSERT' WHEN 1 THEN 'UPDATE' WHEN 2 THEN 'DELETE' WHEN 3 THEN 'SNAPSHOT' ELSE 'UNRECOGNIZED' END"


@query("op_mapping", f"SELECT event_id, {OPS} AS op FROM events")
def op_mapping(spark, sf):
    return read(spark, sf, "events").select("event_id", V.operation(F.expr(CODES)).alias("op"))


@query("event_class_flags", f"SELECT event_id, op = 'INSERT' AS is_insert, op = 'UPDATE' AS is_update, op = 'DELETE' AS is_delete, op = 'SNAPSHOT' AS is_snapshot, op IN ('UPDATE','DELETE') AS has_before, op IN ('INSERT','UPDATE','SNAPSHOT') AS has_after FROM (SELECT event_id, {OPS} AS op FROM events)")
def event_class_flags(spark, sf):
    return R.with_flags(op_mapping(spark, sf)).drop("op")


@query("tx_status_mapping", "SELECT event_id, CASE WHEN event_type = 'click' THEN 'BEGIN' WHEN event_type = 'view' THEN 'END' ELSE 'UNRECOGNIZED' END AS status FROM events")
def tx_status_mapping(spark, sf):
    kind = F.when(F.col("event_type") == "click", "BEGIN").when(F.col("event_type") == "view", "END").otherwise(F.col("event_type"))
    return read(spark, sf, "events").select("event_id", V.status(kind).alias("status"))


TOPICS = "CASE user_id % 4 WHEN 0 THEN 'tide.shop.orders' WHEN 1 THEN 'tide.shop.nation' WHEN 2 THEN 'tide.other.orders' ELSE 'tide.shopping.x' END"


def _topics(spark, sf):
    return read(spark, sf, "events").select("event_id", F.expr(TOPICS).alias("topic"))


@query("table_routing", "SELECT event_id, CASE user_id % 4 WHEN 0 THEN 'orders' ELSE 'nation' END AS \"table\" FROM events WHERE user_id % 4 < 2")
def table_routing(spark, sf):
    return R.routed(_topics(spark, sf), "tide", "shop").drop("topic")


@query("include_tables", "SELECT event_id, 'orders' AS \"table\" FROM events WHERE user_id % 4 = 0")
def include_tables(spark, sf):
    return R.routed(_topics(spark, sf), "tide", "shop", ("orders",)).drop("topic")


@query("full_table_name", "SELECT n_nationkey, 'shop.nation' AS full_name FROM nation")
def full_table_name(spark, sf):
    log, row = snapshot(spark, sf, "nation")
    return E.typed(log, row).select("after.n_nationkey", R.full_name(F.col("source.db"), F.col("source.table")).alias("full_name"))


@query("new_topics", "SELECT DISTINCT event_type AS topic FROM events WHERE event_type NOT IN (SELECT event_type FROM events WHERE event_id < 3)")
def new_topics(spark, sf):
    kinds = read(spark, sf, "events")
    return R.new_topics(kinds.select(F.col("event_type").alias("topic")).distinct(), kinds.where("event_id < 3").select(F.col("event_type").alias("topic")))


@query("dead_letter", "SELECT 'unreadable message' AS message, count(*) AS n FROM events WHERE event_id % 100 = 0")
def dead_letter(spark, sf):
    df = read(spark, sf, "events")
    log = E.encode_changes(df, F.lit("r"), "events", None, E.image(df.schema), F.col("event_id"))
    cut = F.when(F.get_json_object(F.col("value").cast("string"), "$.payload.ts_ms").cast("long") % 100 == 0, F.lit(b"{broken")).otherwise(F.col("value"))
    return E.dead_letters(E.decode_changes(log.withColumn("value", cut))).groupBy("message").agg(F.count("*").alias("n"))


@query("tombstones", "SELECT count(*) AS n FROM orders WHERE o_orderkey % 4 > 1")
def tombstones(spark, sf):
    df = read(spark, sf, "orders")
    log = E.encode_changes(df, F.lit("c"), "orders", None, E.image(df.schema), F.col("o_orderkey"))
    key = F.get_json_object(F.col("value").cast("string"), "$.payload.ts_ms").cast("long") % 4
    log = log.withColumn("value", F.when(key == 0, F.lit(None)).when(key == 1, F.lit(b"")).otherwise(F.col("value")))
    return E.decode_changes(log).agg(F.count("*").alias("n"))


def orders_log(spark: SparkSession, sf: str) -> tuple[DataFrame, T.StructType]:
    """L(orders) decoded and typed."""
    df = read(spark, sf, "orders")
    row = df.schema
    updated = df.where("o_orderkey % 7 = 0").select(F.struct(*df.columns).alias("old"), F.struct(*[F.lit("U").alias(c) if c == "o_orderstatus" else (F.col(c) + 1).cast(MONEY).alias(c) if c == "o_totalprice" else F.col(c) for c in df.columns]).alias("new"))
    log = E.encode_changes(df, F.lit("r"), "orders", None, E.image(row), F.lit(1))
    log = log.union(E.encode_changes(updated, F.lit("u"), "orders", E.image(row, "old"), E.image(row, "new"), F.lit(2)))
    log = log.union(E.encode_changes(df.where("o_orderkey % 11 = 0"), F.lit("d"), "orders", E.image(row), None, F.lit(3)))
    return E.typed(E.decode_changes(log), row), row


REPLAYED = """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 = 0 THEN 'U' ELSE o_orderstatus END AS o_orderstatus,
CAST(CAST(o_totalprice AS DECIMAL(15,2)) + CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS DECIMAL(15,2)) AS o_totalprice,
CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 11 <> 0"""


@query("replay_orders", REPLAYED)
def replay_orders(spark, sf):
    return A.replay(orders_log(spark, sf)[0], ["o_orderkey"], "ts_us")


@query("merge_orders", REPLAYED)
def merge_orders(spark, sf):
    changes = orders_log(spark, sf)[0].where("op <> 'SNAPSHOT'")
    return A.merge(read(spark, sf, "orders"), changes, ["o_orderkey"], "ts_us")


@query("replay_composite_key", "SELECT conv_id, turn, CASE WHEN turn = 1 THEN 'edited' ELSE role END AS role, text FROM conversations WHERE turn <> 2")
def replay_composite_key(spark, sf):
    df = spark.read.parquet(f"{sf}/conversations.parquet")
    row = df.schema
    new = df.where("turn = 1").select(F.struct(*df.columns).alias("old"), F.struct("conv_id", "turn", F.lit("edited").alias("role"), "text").alias("new"))
    log = E.encode_changes(df, F.lit("c"), "conversations", None, E.image(row), F.lit(1))
    log = log.union(E.encode_changes(new, F.lit("u"), "conversations", E.image(row, "old"), E.image(row, "new"), F.lit(2)))
    log = log.union(E.encode_changes(df.where("turn = 2"), F.lit("d"), "conversations", E.image(row), None, F.lit(3)))
    return A.replay(E.typed(E.decode_changes(log), row, trim=False), ["conv_id", "turn"], "ts_us")


@query("replay_key_change", "SELECT CASE WHEN c_custkey % 10 = 0 THEN c_custkey + 1000000000 ELSE c_custkey END AS c_custkey, c_name FROM customer")
def replay_key_change(spark, sf):
    df = read(spark, sf, "customer").select("c_custkey", "c_name")
    row = df.schema
    new = df.where("c_custkey % 10 = 0").select(F.struct(*df.columns).alias("old"), F.struct((F.col("c_custkey") + 1_000_000_000).alias("c_custkey"), "c_name").alias("new"))
    log = E.encode_changes(df, F.lit("c"), "customer", None, E.image(row), F.lit(1)).union(E.encode_changes(new, F.lit("u"), "customer", E.image(row, "old"), E.image(row, "new"), F.lit(2)))
    return A.replay(E.typed(E.decode_changes(log), row), ["c_custkey"], "ts_us")


@query("replay_delete_only", "SELECT p_partkey, p_name FROM part WHERE p_partkey % 2 = 1")
def replay_delete_only(spark, sf):
    df = read(spark, sf, "part").select("p_partkey", "p_name")
    log = E.encode_changes(df.where("p_partkey % 2 = 0"), F.lit("d"), "part", E.image(df.schema), None, F.lit(2))
    return A.merge(df, E.typed(E.decode_changes(log), df.schema), ["p_partkey"], "ts_us")


@query("key_uniqueness_violations", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def key_uniqueness_violations(spark, sf):
    return A.key_violations(read(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("index_key", "SELECT conv_id, turn, conv_id || ':' || turn AS k FROM conversations")
def index_key(spark, sf):
    return spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", A.index_key(["conv_id", "turn"]).alias("k"))


COLUMNS = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"
NUMBERED = f"(SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {COLUMNS}) AS pos FROM lineitem)"


def tx_log(spark: SparkSession, sf: str, keep: str = "true") -> tuple[DataFrame, DataFrame]:
    """X(lineitem): (events, metadata); rows that `keep` leaves out never arrive."""
    raw = spark.read.parquet(f"{sf}/lineitem.parquet")
    w = Window.partitionBy("l_orderkey").orderBy(*COLUMNS.split(", "))
    rows = raw.withColumn("pos", F.row_number().over(w).cast("long")).select(F.concat(F.lit("tx"), "l_orderkey").alias("tx_id"), F.col("l_orderkey").alias("ts_ms"), F.lit("lineitem").alias("table"), F.col("pos").alias("total_order"), F.col("pos").alias("data_collection_order"), F.col("l_linenumber").cast("string").alias("body"), "l_linenumber")
    each = raw.groupBy("l_orderkey").agg(F.count("*").alias("n"))
    tx = F.concat(F.lit("tx"), "l_orderkey")
    none = F.lit(None).cast("array<struct<data_collection:string,event_count:bigint>>")
    told = F.array(F.struct(F.lit("shop.lineitem").alias("data_collection"), F.col("n").alias("event_count")))
    one = lambda status, c: F.struct(F.lit(status).alias("status"), tx.alias("id"), F.col("n").alias("event_count"), F.col("l_orderkey").alias("ts_ms"), c.alias("data_collections"))
    # through the wire form and back
    sent = each.select(F.explode(F.array(one("BEGIN", none), one("END", told))).alias("m")).select(F.to_json(F.struct(F.col("m").alias("payload"))).cast("binary").alias("value"))
    return rows.where(keep), E.decode_metadata(sent)


@query("tx_event_counts", "SELECT 'tx' || l_orderkey AS tx_id, count(*) AS n FROM lineitem GROUP BY l_orderkey")
def tx_event_counts(spark, sf):
    return X.event_counts(tx_log(spark, sf)[0])


@query("tx_table_counts", "SELECT 'tx' || l_orderkey AS tx_id, 'lineitem' AS \"table\", count(*) AS n FROM lineitem GROUP BY l_orderkey")
def tx_table_counts(spark, sf):
    return X.table_counts(tx_log(spark, sf)[0])


COMPLETE = "SELECT 'tx' || l_orderkey AS tx_id, count(*) AS expected, count(*) FILTER (l_linenumber <> 3) AS received, count(*) = count(*) FILTER (l_linenumber <> 3) AS complete FROM lineitem GROUP BY l_orderkey"


@query("tx_completeness", COMPLETE)
def tx_completeness(spark, sf):
    return X.completeness(*tx_log(spark, sf, "l_linenumber <> 3"))


@query("tx_incomplete", f"SELECT tx_id FROM ({COMPLETE}) WHERE NOT complete")
def tx_incomplete(spark, sf):
    return tx_completeness(spark, sf).where("NOT complete").select("tx_id")


@query("tx_committed_rows", f"SELECT tx_id, pos AS total_order, l_linenumber FROM (SELECT 'tx' || l_orderkey AS tx_id, pos, l_linenumber FROM {NUMBERED}) JOIN ({COMPLETE}) USING (tx_id) WHERE complete")
def tx_committed_rows(spark, sf):
    return X.committed_rows(*tx_log(spark, sf, "l_linenumber <> 3")).select("tx_id", "total_order", "l_linenumber")


@query("tx_orphans", f"SELECT 'tx' || l_orderkey AS tx_id, pos AS total_order FROM {NUMBERED} WHERE l_orderkey % 5 = 0")
def tx_orphans(spark, sf):
    rows, told = tx_log(spark, sf)
    return X.orphans(rows, told.where("ts_ms % 5 <> 0")).select("tx_id", "total_order")


@query("tx_end_without_begin", "SELECT DISTINCT 'tx' || l_orderkey AS tx_id FROM lineitem WHERE l_orderkey % 5 = 0")
def tx_end_without_begin(spark, sf):
    return X.ends_without_begin(tx_log(spark, sf)[1].where("status = 'END' OR ts_ms % 5 <> 0"))


@query("tx_order_gaps", f"SELECT tx_id, 'lineitem' AS \"table\", a AS after, pos AS before FROM (SELECT 'tx' || l_orderkey AS tx_id, pos, lag(pos, 1, 0) OVER (PARTITION BY l_orderkey ORDER BY pos) AS a FROM {NUMBERED} WHERE l_linenumber <> 3) WHERE pos > a + 1")
def tx_order_gaps(spark, sf):
    return X.order_gaps(tx_log(spark, sf, "l_linenumber <> 3")[0])


@query("tx_out_of_order", f"SELECT tx_id, pos AS total_order FROM (SELECT 'tx' || l_orderkey AS tx_id, pos, max(pos) OVER (PARTITION BY l_orderkey ORDER BY (pos * 7) % 5 * 1000 + pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM {NUMBERED}) WHERE m > pos")
def tx_out_of_order(spark, sf):
    rows = tx_log(spark, sf)[0].withColumn("arrival", F.col("total_order") * 7 % 5 * 1000 + F.col("total_order"))
    return X.out_of_order(rows, "arrival").select("tx_id", "total_order")


@query("tx_cursor", f"SELECT tx_id, 'lineitem' AS \"table\", count(*) FILTER (r = pos) + 1 AS cursor FROM (SELECT 'tx' || l_orderkey AS tx_id, pos, row_number() OVER (PARTITION BY l_orderkey ORDER BY pos) AS r FROM {NUMBERED} WHERE l_linenumber <> 3) GROUP BY tx_id")
def tx_cursor(spark, sf):
    return X.cursors(tx_log(spark, sf, "l_linenumber <> 3")[0])


@query("tx_commit_ids", "SELECT 'tx' || k AS tx_id, row_number() OVER (ORDER BY k) AS commit_id FROM (SELECT DISTINCT l_orderkey AS k FROM lineitem)")
def tx_commit_ids(spark, sf):
    return X.commit_ids(tx_log(spark, sf)[1])


@query("tx_expired", "SELECT 'tx' || l_orderkey AS tx_id, max(l_orderkey) AS last_ts FROM lineitem WHERE l_orderkey % 3 = 0 GROUP BY l_orderkey HAVING (SELECT max(l_orderkey) FROM lineitem) - max(l_orderkey) > 500")
def tx_expired(spark, sf):
    rows, told = tx_log(spark, sf)
    return X.expired(rows, told.where("ts_ms % 3 <> 0"), 500)


@query("non_tx_bypass", "SELECT event_id FROM events WHERE event_id % 3 < 2")
def non_tx_bypass(spark, sf):
    df = read(spark, sf, "events").select("event_id")
    tx = F.when(F.col("event_id") % 3 == 0, "").when(F.col("event_id") % 3 == 2, F.concat(F.lit("t"), "event_id"))
    log = E.encode_changes(df, F.lit("c"), "events", None, E.image(df.schema), F.lit(1), tx, F.col("event_id"))
    return E.typed(E.decode_changes(log), df.schema).where(~R.transactional(F.col("transaction.id"))).select("after.event_id")


@query("tx_java_hash", "SELECT o_orderkey, CAST(CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS INTEGER) AS trans_id FROM (SELECT o_orderkey, list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(string_split('tx' || o_orderkey, ''), lambda c: CAST(unicode(c) AS BIGINT))), lambda a, c: (a * 31 + c) % 4294967296) AS h FROM orders)")
def tx_java_hash(spark, sf):
    return read(spark, sf, "orders").select("o_orderkey", V.java_hash(F.concat(F.lit("tx"), "o_orderkey")).alias("trans_id"))


ROW_CHANGES = "SELECT 'orders' AS \"table\", op, count(*) AS n FROM (SELECT 'SNAPSHOT' AS op FROM orders UNION ALL SELECT 'UPDATE' FROM orders WHERE o_orderkey % 7 = 0 UNION ALL SELECT 'DELETE' FROM orders WHERE o_orderkey % 11 = 0) GROUP BY op"


def _named(events: DataFrame) -> DataFrame:
    return events.withColumn("table", R.table_of(F.col("topic")))


@query("metric_row_changes", ROW_CHANGES)
def metric_row_changes(spark, sf):
    return M.row_changes(_named(orders_log(spark, sf)[0]))


@query("metric_table_changes", f"SELECT \"table\", CAST(sum(n) AS BIGINT) AS n FROM ({ROW_CHANGES}) GROUP BY 1")
def metric_table_changes(spark, sf):
    return M.table_changes(_named(orders_log(spark, sf)[0]))


@query("metric_totals", f"SELECT \"table\", op, CAST(sum(n) AS BIGINT) AS n FROM ({ROW_CHANGES}) GROUP BY ROLLUP (\"table\", op)")
def metric_totals(spark, sf):
    return M.totals(_named(orders_log(spark, sf)[0]))


@query("metric_transactions", f"SELECT count(*) AS n FROM ({COMPLETE}) WHERE complete")
def metric_transactions(spark, sf):
    return M.transactions(X.committed_rows(*tx_log(spark, sf, "l_linenumber <> 3")))


@query("metric_bytes", "SELECT 'region' AS \"table\", CAST(sum(strlen('{\"payload\":{\"before\":null,\"after\":{\"r_regionkey\":' || r_regionkey || ',\"r_name\":\"' || r_name || '\"},\"source\":{\"name\":\"shop\",\"db\":\"shop\",\"table\":\"region\",\"ts_ms\":1},\"op\":\"r\",\"ts_ms\":1,\"ts_us\":1000,\"transaction\":null}}')) AS BIGINT) AS bytes FROM region")
def metric_bytes(spark, sf):
    return M.bytes_read(_named(snapshot(spark, sf, "region")[0]))


@query("metric_latency_quantiles", "SELECT event_type, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.75) AS p75, quantile_cont(value, 0.95) AS p95, quantile_cont(value, 0.99) AS p99 FROM events GROUP BY 1")
def metric_latency_quantiles(spark, sf):
    return M.latency(read(spark, sf, "events"), "value", ["event_type"], exact=True)


LINES = "o_orderkey || '|' || o_custkey || '|' || CASE WHEN u THEN 'U' ELSE o_orderstatus END || '|' || CAST(CAST(o_totalprice AS DECIMAL(15,2)) + CASE WHEN u THEN 1 ELSE 0 END AS DECIMAL(15,2)) || '|' || CAST(o_orderdate AS DATE) || '|' || o_orderpriority"


@query("csv_sink_lines", f"SELECT {LINES} AS line FROM (SELECT *, false AS u FROM orders UNION ALL SELECT *, true FROM orders WHERE o_orderkey % 7 = 0)")
def csv_sink_lines(spark, sf):
    events, row = orders_log(spark, sf)
    return S.csv_lines(events, row.names)


@query("csv_sink_roundtrip", f"SELECT {TABLES['customer']} FROM customer")
def csv_sink_roundtrip(spark, sf):
    log, row = snapshot(spark, sf, "customer")
    path = fresh(spark)
    S.writer_for("CSV")(E.typed(log, row), path, row.names, header=True)
    return spark.read.schema(row).options(sep="|", header="true").csv(path)


@query("csv_header", "SELECT 'n_nationkey|n_name|n_regionkey' AS header UNION ALL SELECT n_nationkey || '|' || n_name || '|' || n_regionkey FROM nation")
def csv_header(spark, sf):
    """The lines of a written file, header first."""
    log, row = snapshot(spark, sf, "nation")
    path = fresh(spark)
    S.writer_for("csv")(E.typed(log, row).coalesce(1), path, row.names, header=True)
    return spark.read.text(path).select(F.col("value").alias("header"))


@query("csv_tables", f"SELECT 'customer' AS \"table\", c_custkey AS k, c_name AS name FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier")
def csv_tables(spark, sf):
    """Two tables written below <path>/<database>/<table> in one go, a batch twice, and read back."""
    path, made = fresh(spark), {}
    for name in ("customer", "supplier"):
        log, row = snapshot(spark, sf, name)
        made["shop", name] = E.typed(log, row)
    for _ in range(2):
        S.write_tables(made, path, "csv", batch=0)
    parts = [spark.read.schema(made["shop", n].schema["after"].dataType).options(sep="|").csv(f"{S.table_path(path, 'shop', n)}/batch=0").select(F.lit(n).alias("table"), F.col("s_suppkey").alias("k"), F.col("s_name").alias("name")) for n in ("supplier",)]
    custom = spark.read.schema(made["shop", "customer"].schema["after"].dataType).options(sep="|").csv(f"{S.table_path(path, 'shop', 'customer')}/batch=0")
    return custom.select(F.lit("customer").alias("table"), F.col("c_custkey").alias("k"), F.col("c_name").alias("name")).union(parts[0])


@query("parquet_sink_roundtrip", f"SELECT {TABLES['supplier']} FROM supplier")
def parquet_sink_roundtrip(spark, sf):
    log, row = snapshot(spark, sf, "supplier")
    path = fresh(spark)
    S.writer_for("parquet")(E.typed(log, row), path, row.names)
    return spark.read.schema(row).parquet(path)


@query("stream_tx_assembly", ORACLES["tx_committed_rows"])
def stream_tx_assembly(spark, sf):
    """Rows in three parts of many files, in no order of transactions; BEGIN and END come with the second. Each part is one batch."""
    path = fresh(spark)
    rows, told = tx_log(spark, sf, "l_linenumber <> 3")
    parts = [rows.where("total_order % 3 = 0"), rows.where("total_order % 3 = 1"), rows.where("total_order % 3 = 2")]
    for k, part in enumerate(parts):
        Z.items(part, told if k == 1 else told.where("false")).write.mode("append").parquet(f"{path}/in")
        done = Z.assemble(spark.readStream.schema(Z.ITEM).parquet(f"{path}/in"), f"{path}/out", timeout_ms=None)
    return done.select("tx_id", "total_order", F.col("body").cast("int").alias("l_linenumber"))


@query("stream_replay_orders", REPLAYED)
def stream_replay_orders(spark, sf):
    path = fresh(spark)
    df = read(spark, sf, "orders")
    log, row = orders_log(spark, sf)
    log.select("op", "before", "after", "ts_us").write.parquet(f"{path}/in")

    def put(batch: DataFrame, number: int) -> None:
        old = spark.read.schema(row).parquet(f"{path}/table/{number - 1}") if number else df.where("false")
        A.merge(old, batch, ["o_orderkey"], "ts_us").write.mode("overwrite").parquet(f"{path}/table/{number}")

    stream = spark.readStream.schema(log.select("op", "before", "after", "ts_us").schema).parquet(f"{path}/in")
    run = stream.writeStream.foreachBatch(put).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    Z.finish(run, 600)
    return spark.read.schema(row).parquet(f"{path}/table/{run.lastProgress['batchId'] if run.lastProgress else 0}")


@query("tx_row_info", f"SELECT o_orderkey, o_orderkey % 5 AS _tx_order, trans_id AS _tx_hash FROM orders JOIN ({ORACLES['tx_java_hash']}) USING (o_orderkey)")
def tx_row_info(spark, sf):
    df = read(spark, sf, "orders").select("o_orderkey")
    log = E.encode_changes(df, F.lit("c"), "orders", None, E.image(df.schema), F.lit(1), F.concat(F.lit("tx"), "o_orderkey"), F.col("o_orderkey") % 5)
    return A.with_transaction(E.typed(E.decode_changes(log), df.schema)).select("after.o_orderkey", "_tx_order", "_tx_hash")


@query("metric_latency_approx", "SELECT DISTINCT event_type, true AS p50, true AS p75, true AS p95, true AS p99 FROM events")
def metric_latency_approx(spark, sf):
    """Whether each approximate quantile's rank is within the error that is allowed for it."""
    events = read(spark, sf, "events").where("value IS NOT NULL")
    near = M.latency(events, "value", ["event_type"])
    allowed = {0.5: 0.05, 0.75: 0.01, 0.95: 0.005, 0.99: 0.001}
    both = events.join(F.broadcast(near), "event_type")  # as many rows as event types
    share = lambda q: (F.avg((F.col("value") <= F.col(f"p{round(100 * q)}")).cast("int")), F.avg((F.col("value") < F.col(f"p{round(100 * q)}")).cast("int")))
    # a rank of one row more or less is no error
    inside = lambda q: (share(q)[1] <= q + allowed[q] + 1 / F.count("*")) & (share(q)[0] >= q - allowed[q] - 1 / F.count("*"))
    return both.groupBy("event_type").agg(*[inside(q).alias(f"p{round(100 * q)}") for q in M.QUANTILES])


@query("metric_total_latency", "SELECT 'orders' AS \"table\", 'SNAPSHOT' AS op, quantile_cont(100000000 - o_orderkey, 0.5) AS p50, quantile_cont(100000000 - o_orderkey, 0.75) AS p75, quantile_cont(100000000 - o_orderkey, 0.95) AS p95, quantile_cont(100000000 - o_orderkey, 0.99) AS p99 FROM orders")
def metric_total_latency(spark, sf):
    df = read(spark, sf, "orders")
    log = E.encode_changes(df, F.lit("r"), "orders", None, E.image(df.schema), F.col("o_orderkey"))
    return M.total_latency(_named(E.decode_changes(log)), F.lit(100_000_000), exact=True)


def _keyed(spark: SparkSession, parts: list[DataFrame], timeout_ms: int) -> DataFrame:
    """assemble_keyed over a folder of files: the stream takes what is there after each part is written."""
    path = fresh(spark)
    for part in parts:
        part.write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(Z.ITEM).parquet(f"{path}/in")
        run = Z.assemble_keyed(stream, timeout_ms).writeStream.format("parquet").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start(f"{path}/out")
        Z.finish(run, 1800)
    return spark.read.schema(Z.OUT).parquet(f"{path}/out")


@query("stream_tx_keyed", ORACLES["tx_committed_rows"])
def stream_tx_keyed(spark, sf):
    """Rows in two parts, in no order of transactions; BEGIN and END come with the first."""
    rows, told = tx_log(spark, sf, "l_linenumber <> 3")
    parts = [Z.items(rows.where("total_order % 2 = 0"), told), Z.items(rows.where("total_order % 2 = 1"), told.where("false"))]
    return _keyed(spark, parts, 10**12).where("outcome = 'committed'").select("tx_id", "total_order", F.col("body").cast("int").alias("l_linenumber"))


@query("stream_tx_expired", ORACLES["tx_expired"])
def stream_tx_expired(spark, sf):
    rows, told = tx_log(spark, sf)
    got = _keyed(spark, [Z.items(rows, told.where("ts_ms % 3 <> 0"))], 500)
    return got.where("outcome = 'expired'").groupBy("tx_id").agg(F.max("ts_ms").alias("last_ts"))


@query("stream_end_to_end", REPLAYED)
def stream_end_to_end(spark, sf):
    """Files of raw messages to a table by key: a snapshot, updates and deletes in transactions of five orders, unread ones and tombstones."""
    path = fresh(spark)
    df = read(spark, sf, "orders")
    row = df.schema
    changed = df.where("o_orderkey % 7 = 0").withColumn("tx", F.concat(F.lit("u"), (F.col("o_orderkey") / 35).cast("long")))
    gone = df.where("o_orderkey % 11 = 0").withColumn("tx", F.concat(F.lit("d"), (F.col("o_orderkey") / 55).cast("long")))
    new = F.struct(*[F.lit("U").alias(c) if c == "o_orderstatus" else (F.col(c) + 1).cast(MONEY).alias(c) if c == "o_totalprice" else F.col(c) for c in df.columns])
    updated = changed.select("tx", F.col("o_orderkey").alias("k"), F.struct(*df.columns).alias("old"), new.alias("new"))
    log = E.encode_changes(df, F.lit("r"), "orders", None, E.image(row), F.lit(1))
    tx_rows = E.encode_changes(updated, F.lit("u"), "orders", E.image(row, "old"), E.image(row, "new"), F.lit(2), F.col("tx"), F.col("k"))
    tx_rows = tx_rows.union(E.encode_changes(gone, F.lit("d"), "orders", E.image(row), None, F.lit(3), F.col("tx"), F.col("o_orderkey")))
    junk = df.select(F.lit("tide.shop.orders").alias("topic"), F.when(F.col("o_orderkey") % 2 == 0, F.lit(b"{broken")).cast("binary").alias("value")).limit(20)
    for part in (tx_rows, log.union(junk)):  # changes before what they change
        part.write.mode("append").parquet(f"{path}/{E.ROWS}")
    each = changed.select("tx").union(gone.select("tx")).groupBy("tx").agg(F.count("*").alias("n"))
    told = F.array(F.struct(F.lit("shop.orders").alias("data_collection"), F.col("n").alias("event_count")))
    one = lambda status, c: F.struct(F.lit(status).alias("status"), F.col("tx").alias("id"), F.col("n").alias("event_count"), F.lit(3).alias("ts_ms"), c.alias("data_collections"))
    sent = each.select(F.explode(F.array(one("BEGIN", F.lit(None).cast("array<struct<data_collection:string,event_count:bigint>>")), one("END", told))).alias("m"))
    sent.select(F.lit("tide.transaction").alias("topic"), F.to_json(F.struct(F.col("m").alias("payload"))).cast("binary").alias("value")).write.parquet(f"{path}/{E.TRANSACTIONS}")
    known = Registry()
    known.put("shop", "orders", row, ("o_orderkey",))
    config = Config(sink_mode="table", csv_path=f"{path}/out", topic_prefix="tide", capture_database="shop", include_tables=("orders",), source_path=path)
    job = Ingestion(spark, config, known)
    run = job.start(once=True)
    Z.finish(run, 1800)
    return job.table("shop", "orders", run.lastProgress["batchId"])
