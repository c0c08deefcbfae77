"""Row validation, business uniqueness and reference checks.

Checks add columns instead of splitting the data, so one pass over the candidates yields the valid
rows, the rejects with their reasons, and every count.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from camadas.contracts import Entity, Field, Reference, Unique
from camadas.entities import DOCUMENT_LENGTHS, DOCUMENT_RANGES
from camadas.functions.extjson import DATE_MILLIS, DATE_WRAPPER, NUMBER_WRAPPERS, allowed_shapes, number_wrappers, shape
from camadas.functions.keys import spread_nulls
from camadas.functions.text import to_number
from camadas.sources.state import offered

STATUSES = ("field", "business", "referential", "valid")

# How curated tables name their log columns and the log's producer.
LOG_PRODUCER = "bronze_to_silver"
FIELD_KIND = "campo_invalido"
REFERENCE_KIND = "referencia_inexistente"


def field_checks(field: Field) -> dict[str, Column]:
    """Rule name -> a condition that is true exactly when the rule is broken."""
    value = F.col(field.name)
    checks: dict[str, Column] = {}
    if field.required:
        empty = F.length(value) == 0 if field.type == "string" else F.lit(False)
        checks["required"] = value.isNull() | empty
    rules = {
        "domain": value.isin(*field.one_of) if field.one_of else None,
        "pattern": value.rlike(field.pattern) if field.pattern else None,
        "minimum": value >= F.lit(field.low) if field.low is not None else None,
        "maximum": value <= F.lit(field.high) if field.high is not None else None,
    }
    for rule, holds in rules.items():
        if holds is not None:
            checks[rule] = value.isNotNull() & ~holds
    return checks


def all_checks(entity: Entity) -> dict[str, Column]:
    return {f"{f.name}:{rule}": c for f in entity.fields for rule, c in field_checks(f).items()}


def is_valid(entity: Entity) -> Column:
    return ~reduce(Column.__or__, all_checks(entity).values())


def violations(entity: Entity) -> Column:
    """The names of all broken rules of a row, in contract order."""
    return F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in all_checks(entity).items())))


def violation_counts(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """(rule, broken, checked): one scan and one global aggregate, whatever the number of rules."""
    names = list(checks)
    counts = df.agg(
        F.count(F.lit(1)).alias("checked"),
        *(F.count_if(checks[n]).alias(f"c{i}") for i, n in enumerate(names)),
    )
    pairs = F.array(
        *(
            F.struct(F.lit(n).alias("rule"), F.col(f"c{i}").alias("broken"))
            for i, n in enumerate(names)
        )
    )
    return counts.select(F.inline(pairs), "checked").select("rule", "broken", "checked")


def document_checks(entity: Entity, document: Column) -> dict[str, Column]:
    """The source-side document contract: presence, JSON shape, domain, range and length.

    ``document`` is the parsed (variant) document; an absent optional field breaks nothing.
    """
    checks: dict[str, Column] = {}
    for f in entity.fields:
        kind = shape(document, f.name)
        if f.required:
            checks[f"{f.name}:required"] = kind.isNull()
        if f.one_of:
            value = F.try_variant_get(document, f"$.{f.name}", "string")
            inside = F.coalesce(value.isin(*f.one_of), F.lit(False))
            checks[f"{f.name}:domain"] = kind.isNotNull() & ~inside
        else:
            checks[f"{f.name}:type"] = kind.isNotNull() & ~kind.isin(*allowed_shapes(f))
        if f.name in DOCUMENT_RANGES:
            low, high = DOCUMENT_RANGES[f.name]
            texts = (
                F.try_variant_get(document, f"$.{f.name}['{w}']", "string")
                for w in NUMBER_WRAPPERS
            )
            number = to_number(F.coalesce(*texts), "bigint")
            checks[f"{f.name}:range"] = number.isNotNull() & ~number.between(low, high)
        if f.name in DOCUMENT_LENGTHS:
            low, high = DOCUMENT_LENGTHS[f.name]
            size = F.length(F.try_variant_get(document, f"$.{f.name}", "string"))
            checks[f"{f.name}:length"] = (kind == "STRING") & ~size.between(low, high)
    return {n: F.coalesce(c, F.lit(False)) for n, c in checks.items()}


# Characters that stand for themselves in a JSON text, and how many a plain one has at most.
_PLAIN = r'[^"\\\x00-\x1f]'
_LONGEST = 10_000


def _plain_value(field: Field) -> str:
    """Pattern of a field's JSON texts that break no rule of the contract; not all of them, but the usual ones."""
    if field.one_of:
        value = '"(?:' + "|".join(map(re.escape, field.one_of)) + ')"'
    elif field.wire == "boolean":
        value = "(?:true|false)"
    elif field.wire == "string":
        low, high = DOCUMENT_LENGTHS.get(field.name, (0, _LONGEST))
        value = f'"{_PLAIN}{{{low},{high}}}+"'
    elif field.wire == "date":
        value = rf'\{{"{re.escape(DATE_WRAPPER)}":\{{"{re.escape(DATE_MILLIS)}":"{_PLAIN}{{0,{_LONGEST}}}+"\}}\}}'
    else:
        low, high = DOCUMENT_RANGES.get(field.name, (0, -1))
        inside = "|".join(map(re.escape, map(str, range(low, high + 1)))) or f"{_PLAIN}{{0,{_LONGEST}}}+"
        value = rf'\{{"(?:{"|".join(map(re.escape, number_wrappers(field)))})":"(?:{inside})"\}}'
    return value if field.required or field.one_of else f"(?:null|{value})"


def plain_document(entity: Entity) -> str:
    """Pattern of documents that keep the whole contract: its fields in order, without blanks, escapes or others.

    The identifier that the source puts before them is no contract field and may stand there.
    """
    fields = (f'"{re.escape(f.name)}":{_plain_value(f)}' for f in entity.fields)
    source_id = rf'(?:"_id":\{{"\$oid":"{_PLAIN}{{0,{_LONGEST}}}+"\}},)?'
    return rf"\A\{{{source_id}{','.join(fields)}\}}\z"


def document_report(raw: DataFrame, entity: Entity, document: str = "raw_document") -> DataFrame:
    """``violation_counts`` of the document contract.

    Documents as their source writes them are known to keep it by one look at the text. Only the others
    are parsed and checked rule by rule, whatever is unusual about them.
    """
    text = F.col(document)
    odd = ~F.coalesce(text.rlike(plain_document(entity)), F.lit(False))
    parsed = raw.select(document, odd.alias("_odd")).select(
        "_odd", F.when(F.col("_odd"), F.try_parse_json(text)).alias("_doc"))
    broken = document_checks(entity, F.col("_doc"))
    return violation_counts(parsed, {n: F.col("_odd") & c for n, c in broken.items()})


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of copies."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def flag_duplicates(
    df: DataFrame, rule: Unique, key: str, order: Sequence[str], scope: Column | None = None,
    flag: str = "_loser",
) -> DataFrame:
    """Mark rows that break a business-uniqueness rule; the newest row of a group is kept.

    Groups are first reduced to one row each (partial aggregation, so a hot value costs one row per
    map task), only groups with two or more members are kept, and these are joined back. No task
    ever holds a whole group. ``key`` breaks the last ties: the highest wins.
    """
    inside = F.lit(True) if scope is None else scope
    if rule.when_field is not None:
        inside = inside & (F.col(rule.when_field) == F.lit(rule.when_value))
    inside = F.coalesce(inside, F.lit(False))
    newest = F.max(F.struct(*order, F.col(key).alias("_winner")))
    contested = (
        df.filter(inside)
        .groupBy(*rule.fields)
        .agg(F.count(F.lit(1)).alias("_members"), newest.alias("_newest"))
        .filter("_members > 1")
        .select(
            *(F.col(f).alias(f"_u{i}") for i, f in enumerate(rule.fields)),
            F.col("_newest._winner").alias("_winner"),
        )
    )
    same = [F.col(f).eqNullSafe(F.col(f"_u{i}")) for i, f in enumerate(rule.fields)]
    lost = inside & F.col("_winner").isNotNull() & (F.col(key) != F.col("_winner"))
    return df.join(contested, reduce(Column.__and__, same), "left").select(
        *(F.col(c) for c in df.columns), F.coalesce(lost, F.lit(False)).alias(flag)
    )


def flag_reference(
    df: DataFrame, ref: Reference, parent: DataFrame, key: str, flag: str, rows: int | None = None
) -> DataFrame:
    """Mark whether a row's reference resolves; an optional reference may be null.

    A parent whose rows have been counted is broadcast where their number allows it, so that the rows stay
    where they are. Otherwise it is not hinted: Spark broadcasts it only below its size threshold and splits
    hot references at run time. Null references are spread over many tasks.
    """
    known = parent.select(F.col(ref.parent_field).alias("_parent")).distinct()
    known = known if rows is None else offered(known, rows)
    value = F.col(ref.field)
    if ref.required:
        match = value == F.col("_parent")
    else:
        match = (spread_nulls(value, F.col(key)) == F.col("_parent")) & value.isNotNull()
    found = F.col("_parent").isNotNull()
    return df.join(known, match, "left").select(
        *(F.col(c) for c in df.columns),
        (found if ref.required else found | value.isNull()).alias(flag),
    )


def resolved(df: DataFrame, ref: Reference, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose reference resolves, for callers that need no report of the others."""
    if ref.required:
        known = parent.select(F.col(ref.parent_field).alias(ref.field))
        return df.join(known, ref.field, "left_semi").select(*df.columns)
    return flag_reference(df, ref, parent, key, "_found").filter("_found").drop("_found")


def orphans(df: DataFrame, ref: Reference, parent: DataFrame) -> DataFrame:
    """Rows whose non-null reference resolves to nothing."""
    known = parent.select(F.col(ref.parent_field).alias(ref.field))
    present = df.filter(F.col(ref.field).isNotNull())
    return present.join(known, ref.field, "left_anti").select(*df.columns)


def assess(
    df: DataFrame, entity: Entity, parents: Mapping[str, DataFrame], order: Sequence[str],
    parent_rows: Mapping[str, int] | None = None,
) -> DataFrame:
    """Add ``_status`` (see STATUSES), ``_kind`` and ``_reason`` to de-duplicated candidates.

    Uniqueness looks only at rows that pass the field rules, each further rule only at survivors of
    the one before, and references only decide rows that passed everything else. ``parent_rows``: of the
    parents whose rows have been counted.
    """
    ok = is_valid(entity)
    out = df.withColumn("_ok", ok).withColumn("_violations", F.when(~ok, violations(entity)))
    alive = F.col("_ok")
    lost: list[tuple[str, Unique]] = []
    for i, rule in enumerate(entity.unique):
        flag = f"_lost{i}"
        out = flag_duplicates(out, rule, entity.key, order, scope=alive, flag=flag)
        alive = alive & ~F.col(flag)
        lost.append((flag, rule))
    found: list[tuple[str, Reference]] = []
    for i, ref in enumerate(entity.references):
        flag = f"_found{i}"
        out = flag_reference(out, ref, parents[ref.parent], entity.key, flag, (parent_rows or {}).get(ref.parent))
        found.append((flag, ref))

    status = F.when(~F.col("_ok"), "field")
    kind = F.when(~F.col("_ok"), FIELD_KIND)
    reason = F.when(~F.col("_ok"), F.array_join("_violations", ","))
    for flag, rule in lost:
        status = status.when(F.col(flag), "business")
        kind = kind.when(F.col(flag), rule.kind)
        reason = reason.when(F.col(flag), rule.detail)
    for flag, ref in found:
        status = status.when(~F.col(flag), "referential")
        kind = kind.when(~F.col(flag), REFERENCE_KIND)
        reason = reason.when(~F.col(flag), f"{ref.field} -> {ref.parent}.{ref.parent_field}")
    return out.select(
        *(F.col(c) for c in df.columns),
        status.otherwise("valid").alias("_status"), kind.alias("_kind"), reason.alias("_reason"),
    )


def quality_log(
    assessed: DataFrame, entity: Entity, run_id: str, at: Column, digest: str,
    classes: Sequence[str] = ("business",),
) -> DataFrame:
    """Rejected rows in the append-only log's layout; business rejects unless told otherwise."""
    return assessed.filter(F.col("_status").isin(*classes)).select(
        F.lit(run_id).alias("run_id"),
        F.lit(LOG_PRODUCER).alias("dag_id"),
        F.lit(entity.name).alias("tabela"),
        F.col(entity.key).cast("string").alias("chave_primaria"),
        F.col("_kind").alias("tipo_rejeicao"),
        F.col("_reason").alias("detalhe"),
        F.col(digest).alias("hash_registro"),
        at.alias("rejeitado_em"),
    )
