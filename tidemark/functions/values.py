"""Column expressions for values as connectors send them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Operation codes (fixed values).
OPERATIONS = {"c": "INSERT", "u": "UPDATE", "d": "DELETE", "r": "SNAPSHOT"}


def operation(code: Column) -> Column:
    """INSERT, UPDATE, DELETE, SNAPSHOT; UNRECOGNIZED for other codes and null."""
    out = F.lit("UNRECOGNIZED")
    for c, name in OPERATIONS.items():
        out = F.when(F.lower(code) == c, name).otherwise(out)
    return out


def status(text: Column) -> Column:
    return F.when(text.isin("BEGIN", "END"), text).otherwise("UNRECOGNIZED")


def trimmed(text: Column) -> Column:
    """Without characters up to U+0020 at either end."""
    return F.regexp_replace(text, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def long_or_zero(c: Column) -> Column:
    return F.coalesce(c.cast("long"), F.lit(0).cast("long"))


def encode_decimal(c: Column, scale: int) -> Column:
    """base64 of the unscaled value's eight bytes in two's complement."""
    return F.base64(F.unhex(F.lpad(F.hex((c * F.lit(10**scale)).cast("long")), 16, "0")))


def decode_decimal(c: Column, precision: int, scale: int) -> Column:
    """Decimal of a base64 big-endian two's-complement integer of any length up to 38 digits."""
    raw = F.unbase64(c)
    kind = T.DecimalType(precision, scale)
    unit = F.lit(f"{10 ** -scale:.{scale}f}" if scale else "1").cast(T.DecimalType(scale + 1, scale))
    if precision <= 18:
        text = F.hex(raw)
        pad = F.when(text >= "8", "F").otherwise("0")
        unscaled = F.conv(F.lpad(text, 16, pad), 16, -10).cast("long").cast(T.DecimalType(20, 0))
        return F.when(F.length(raw) > 0, (unscaled * unit).cast(kind))
    byte = lambda i: F.conv(F.hex(F.substring(raw, i, F.lit(1))), 16, 10).cast("int")
    first = (byte(F.lit(1)) - F.when(byte(F.lit(1)) >= 128, 256).otherwise(0)).cast(T.DecimalType(38, 0))
    rest = F.when(F.length(raw) > 1, F.sequence(F.lit(2), F.length(raw))).otherwise(F.array().cast("array<int>"))
    whole = F.aggregate(rest, first, lambda a, i: (a * 256 + byte(i)).cast(T.DecimalType(38, 0)))
    return F.when(F.length(raw) > 0, (whole.cast(T.DecimalType(38 - scale, 0)) * unit).cast(kind))


def encode(c: Column, kind: T.DataType) -> Column:
    """The JSON form of a typed value."""
    if isinstance(kind, T.DecimalType):
        return encode_decimal(c, kind.scale)
    if isinstance(kind, T.DateType):
        return F.unix_date(c)
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.BinaryType):
        return F.base64(c)
    return c


def wire(kind: T.DataType) -> T.DataType:
    """Type of encode's result."""
    if isinstance(kind, (T.DecimalType, T.BinaryType)):
        return T.StringType()
    if isinstance(kind, T.DateType):
        return T.IntegerType()
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return T.LongType()
    return kind


def avro_value(c: Column, sent: T.DataType, kind: T.DataType, trim: bool = True) -> Column:
    """A value of an Avro record as the row's type: logical types are there already, others come in their physical form."""
    if isinstance(sent, T.BinaryType) and isinstance(kind, T.DecimalType):
        return decode_decimal(F.base64(c), kind.precision, kind.scale)
    if isinstance(sent, T.IntegerType) and isinstance(kind, T.DateType):
        return F.date_from_unix_date(c)
    if isinstance(sent, T.LongType) and isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.timestamp_micros(c).cast(kind)
    if isinstance(kind, T.StringType) and trim:
        return trimmed(c.cast(kind))
    return c.cast(kind)


def avro_image(image: Column, sent: T.StructType, row: T.StructType, trim: bool = True) -> Column:
    """A before or after record as the row's struct; null stays null, absent fields are null."""
    have = {f.name.lower(): f for f in sent.fields}
    one = lambda f: avro_value(image[have[f.name.lower()].name], have[f.name.lower()].dataType, f.dataType, trim) if f.name.lower() in have else F.lit(None).cast(f.dataType)
    return F.when(image.isNotNull(), F.struct(*[one(f).alias(f.name) for f in row.fields]))


def decode(c: Column, kind: T.DataType, trim: bool = True) -> Column:
    if isinstance(kind, T.DecimalType):
        return decode_decimal(c, kind.precision, kind.scale)
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(c)
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(c)
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_micros(c).cast("timestamp_ntz")
    if isinstance(kind, T.BinaryType):
        return F.unbase64(c)
    if isinstance(kind, T.StringType) and trim:
        return trimmed(c)
    return c


def java_hash(text: Column) -> Column:
    """int: String.hashCode of the text, over UTF-16 units."""
    points = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), F.ascii)
    pair = lambda p: F.array(((p - 65536) / 1024).cast("int") + 55296, (p - 65536) % 1024 + 56320)
    units = F.flatten(F.transform(points, lambda p: F.when(p > 65535, pair(p)).otherwise(F.array(p))))
    wrapped = F.aggregate(units, F.lit(0).cast("long"), lambda a, u: (a * 31 + u).bitwiseAND(F.lit(2**32 - 1)))
    return F.when(wrapped >= 2**31, wrapped - 2**32).otherwise(wrapped).cast("int")
