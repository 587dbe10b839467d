"""D1-D4 on Spark columns: nested structs and arrays to ordered numeric leaves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from diagarc.functions.scalar import SEPARATOR, clean_key, double_to_i64

_LEAF = "array<struct<field:array<string>,name:string,bson_type:string,value:bigint>>"


def _leaf(c: Column, t: T.DataType):
    """(type name, value) of a numeric-like column, None for skipped types."""
    if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)):
        return "int32", c.cast("bigint")
    if isinstance(t, T.LongType):
        return "int64", c
    if isinstance(t, (T.DoubleType, T.FloatType)):
        return "double", double_to_i64(c)
    if isinstance(t, T.DecimalType):
        return "decimal128", F.lit(0).cast("bigint")
    if isinstance(t, T.BooleanType):
        return "bool", c.cast("bigint")
    if isinstance(t, T.TimestampType):
        return "datetime", F.unix_millis(c)
    if isinstance(t, T.TimestampNTZType):
        from diagarc.functions.scalar import ntz_to_ms

        return "datetime", ntz_to_ms(c)
    if isinstance(t, T.StringType):
        return None
    raise TypeError(f"no numeric form for type {t.simpleString()}")


def _walk(c: Column, t: T.DataType, field: Column, name: Column | None) -> list[Column]:
    """Expressions of type ``_LEAF`` that concatenate to the leaves below ``c``."""
    if isinstance(t, T.StructType):
        parts = []
        for f in t.fields:
            if not f.name:
                raise ValueError("empty field name")
            # Names are known here, so the cleaned path is a constant Catalyst folds.
            own = clean_key(F.lit(f.name))
            path = own if name is None else F.when(name == "", own).otherwise(F.concat(name, F.lit(SEPARATOR), own))
            parts += _walk(c[f.name], f.dataType, F.concat(field, F.array(F.lit(f.name))), path)
        return parts
    if isinstance(t, T.ArrayType):
        def item(x, i):
            n = i.cast("string")
            below = _walk(x, t.elementType, F.concat(field, F.array(n)), F.concat(name, F.lit(SEPARATOR), n))
            return F.concat(*below) if below else F.array().cast(_LEAF)

        return [F.coalesce(F.flatten(F.transform(c, item)), F.array().cast(_LEAF))]
    leaf = _leaf(c, t)
    if leaf is None:
        return []
    type_name, value = leaf
    row = F.struct(field.alias("field"), name.alias("name"), F.lit(type_name).alias("bson_type"), value.alias("value"))
    return [F.array(row)]


def leaf_fields(column: Column, schema: T.StructType) -> Column:
    """Ordered leaves of a struct column; text is skipped, other types are an error."""
    parts = _walk(column, schema, F.array().cast("array<string>"), None)
    return F.concat(*parts) if parts else F.array().cast(_LEAF)


def _presence(c: Column, t: T.DataType) -> tuple[list[Column], list[Column]]:
    """Whether each single leaf below ``c`` has a value, and a text for each array of leaves."""
    if isinstance(t, T.StructType):
        below = [_presence(c[f.name], f.dataType) for f in t.fields]
        return [b for bits, _ in below for b in bits], [a for _, arrays in below for a in arrays]
    if isinstance(t, T.ArrayType):
        return [], [F.concat_ws(",", F.transform(c, lambda x: _signs(x, t.elementType, as_text=True)))]
    leaf = _leaf(c, t)
    return ([], []) if leaf is None else ([leaf[1].isNotNull()], [])


def _signs(c: Column, t: T.DataType, as_text: bool) -> Column:
    bits, arrays = _presence(c, t)
    words = []
    for at in range(0, len(bits), 62):
        word = F.lit(0).cast("bigint")
        for i, bit in enumerate(bits[at : at + 62]):
            word = word + F.when(bit, F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
        words.append(word)
    if len(words) == 1 and not arrays and not as_text:
        return words[0]
    return F.concat(F.lit("("), F.concat_ws("|", *[w.cast("string") for w in words], *arrays), F.lit(")"))


def shape_sign(column: Column, schema: T.StructType) -> Column:
    """Which leaves of a struct column have a value: equal for two rows just when ``leaf_fields`` gives
    the same fields and types with values. One integer where at most 62 leaves and no arrays are; no
    leaf is built for it."""
    return _signs(column, schema, as_text=False)


def flatten_struct(df: DataFrame, column: str, out="fields") -> DataFrame:
    """Add ``out``, the ordered numeric leaves of struct ``column``."""
    return df.withColumn(out, leaf_fields(F.col(column), df.schema[column].dataType))


def explode_fields(df: DataFrame, fields="fields") -> DataFrame:
    """One row per leaf: ``key_no``, ``name``, ``bson_type``, ``value``."""
    rest = [c for c in df.columns if c != fields]
    rows = df.select(*rest, F.posexplode(fields).alias("key_no", "f"))
    return rows.select(*rest, "key_no", "f.name", "f.bson_type", "f.value")


def split_timestamp(name: Column, seconds: Column, increment: Column, spec_bases=False) -> Column:
    """The two metrics of a (seconds, increment) timestamp. Values are 0 as the decoder
    stores them, unless ``spec_bases`` asks for the real parts."""
    zero = F.lit(0).cast("bigint")

    def part(suffix, value):
        v = value.cast("bigint") if spec_bases else zero
        return F.struct(F.concat(name, F.lit(SEPARATOR + suffix)).alias("name"), v.alias("value"))

    return F.explode(F.array(part("t", seconds), part("i", increment)))
