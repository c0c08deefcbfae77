"""Canonical Extended JSON: wrapped numbers and dates, one document per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from camadas.contracts import Entity, Field
from camadas.functions.text import clean, to_number

# Wrapper names of the wire format.
NUMBER_WRAPPERS = ("$numberInt", "$numberLong", "$numberDouble")
DATE_WRAPPER = "$date"
DATE_MILLIS = "$numberLong"
# Epoch seconds that a timestamp of 64-bit microseconds can hold; years before 1 and after 9999 are among them.
INSTANTS = (-9223372036854, 9223372036854)

_NUMBER = "struct<" + ",".join(f"`{w}`:string" for w in NUMBER_WRAPPERS) + ">"
_DATE = f"struct<`{DATE_WRAPPER}`:struct<`{DATE_MILLIS}`:string>>"
_WIRE_TYPES = {
    "string": "string", "boolean": "boolean", "integer": _NUMBER, "number": _NUMBER, "date": _DATE,
}


def wire_schema(entity: Entity) -> str:
    """The contract as the DDL of its wire form; nothing is inferred from data."""
    return ", ".join(f"`{f.name}` {_WIRE_TYPES[f.wire]}" for f in entity.fields)


def number_value(node: Column, target: str) -> Column:
    return to_number(F.coalesce(*(node.getField(w) for w in NUMBER_WRAPPERS)), target)


def date_value(node: Column, target: str) -> Column:
    """Epoch milliseconds to whole seconds (towards zero), then to a day if asked."""
    millis = node.getField(DATE_WRAPPER).getField(DATE_MILLIS).try_cast("bigint")
    seconds = F.call_function("div", millis, F.lit(1000))
    known = seconds.between(*INSTANTS)
    instant = F.timestamp_seconds(F.when(known, seconds))
    return instant.cast("date") if target == "date" else instant


def field_value(document: Column, field: Field) -> Column:
    node = document.getField(field.name)
    if field.wire in ("integer", "number"):
        value = number_value(node, field.type)
    elif field.wire == "date":
        value = date_value(node, field.type)
    else:
        value = node.try_cast(field.type)
    return clean(value, field.clean)


def decode(raw: DataFrame, entity: Entity, document: str = "raw_document") -> DataFrame:
    """Add one typed, normalised column per contract field; other columns stay.

    A field that does not parse is null; a line that is not JSON gives only nulls.
    """
    parsed = raw.withColumn("_doc", F.from_json(F.col(document), wire_schema(entity)))
    return parsed.select(
        *(F.col(c) for c in raw.columns),
        *(field_value(F.col("_doc"), f).alias(f.name) for f in entity.fields),
    )


def wrap(df: DataFrame, field: Field) -> Column:
    """A typed column to its wire form; null stays null, 32-bit and 64-bit integers differ."""
    column = F.col(field.name)
    if field.wire == "integer":
        small = df.schema[field.name].dataType.simpleString() == "int"
        inner = column.cast("string").alias("$numberInt" if small else "$numberLong")
    elif field.wire == "number":
        inner = column.cast("string").alias("$numberDouble")
    elif field.wire == "date":
        millis = F.unix_millis(column.cast("timestamp")).cast("string")
        inner = F.struct(millis.alias(DATE_MILLIS)).alias(DATE_WRAPPER)
    else:
        return column.alias(field.name)
    return F.when(column.isNotNull(), F.struct(inner)).alias(field.name)


def wrapped(df: DataFrame, entity: Entity) -> DataFrame:
    """Typed columns to wire-form columns, ready for ``df.write.json``."""
    return df.select(*(wrap(df, f) for f in entity.fields))


def encode(df: DataFrame, entity: Entity, document: str = "raw_document") -> DataFrame:
    """Replace the contract columns by one JSON text column; other columns stay."""
    rest = [c for c in df.columns if c not in entity.columns]
    body = F.struct(*(wrap(df, f) for f in entity.fields))
    return df.select(*rest, F.to_json(body, {"ignoreNullFields": "false"}).alias(document))


def shape(document: Column, name: str) -> Column:
    """The JSON shape of a field: VOID for null, SQL null where the field is absent."""
    return F.schema_of_variant(F.try_variant_get(document, f"$.{name}", "variant"))


def number_wrappers(field: Field) -> tuple[str, ...]:
    """Whole numbers have no fractional form."""
    return NUMBER_WRAPPERS if field.wire == "number" else NUMBER_WRAPPERS[:2]


def allowed_shapes(field: Field) -> list[str]:
    if field.wire == "date":
        shapes = [f"OBJECT<`{DATE_WRAPPER}`: OBJECT<`{DATE_MILLIS}`: STRING>>"]
    elif field.wire in ("integer", "number"):
        shapes = [f"OBJECT<`{w}`: STRING>" for w in number_wrappers(field)]
    else:
        shapes = [field.wire.upper()]
    return shapes if field.required else [*shapes, "VOID"]
