"""Declarative contracts: what a curated entity or a star-schema model must look like.

Nothing here touches Spark. The operators compile these objects to Columns, so
a new entity is data, not code.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass


@dataclass(frozen=True)
class Field:
    name: str
    wire: str  # string | boolean | integer | number | date
    type: str  # Spark type name of the curated column
    required: bool = True
    clean: str | None = None  # trim | lower | upper | digits
    one_of: tuple[str, ...] = ()
    pattern: str | None = None
    low: float | None = None
    high: float | None = None


@dataclass(frozen=True)
class Reference:
    field: str
    parent: str
    parent_field: str
    required: bool = True


@dataclass(frozen=True)
class Unique:
    """At most one row per ``fields``, optionally only where ``when_field`` equals ``when_value``."""

    fields: tuple[str, ...]
    kind: str
    detail: str
    when_field: str | None = None
    when_value: str | None = None


@dataclass(frozen=True)
class Entity:
    name: str
    key: str
    fields: tuple[Field, ...]
    references: tuple[Reference, ...] = ()
    unique: tuple[Unique, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    def field(self, name: str) -> Field:
        return next(f for f in self.fields if f.name == name)


@dataclass(frozen=True)
class Link:
    """A fact looks up ``dimension`` as it was valid on ``event``."""

    dimension: str
    event: str


@dataclass(frozen=True)
class Model:
    name: str
    kind: str  # dimension | fact
    key: str
    sources: tuple[str, ...]
    history: str = "none"  # none | static | type2
    natural_key: str | None = None
    partition: tuple[str, ...] = ()
    links: tuple[Link, ...] = ()


def _names(text: str | Iterable[str] | None, known: Iterable[str], what: str) -> tuple[str, ...]:
    known = list(known)
    if text is None or text == "":
        return tuple(known)
    parts = text.split(",") if isinstance(text, str) else list(text)
    names = [p.strip() for p in parts if p.strip()]
    if not names:
        raise ValueError(f"{what}: the selection is empty")
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"{what}: duplicate names {repeated}")
    unknown = sorted(set(names) - set(known))
    if unknown:
        raise ValueError(f"{what}: unknown names {unknown}")
    return tuple(names)


def select_collections(text, known: Iterable[str]) -> tuple[str, ...]:
    """Source collections keep the order in which the caller names them."""
    return _names(text, known, "collections")


def select_entities(text, entities: Mapping[str, Entity]) -> tuple[str, ...]:
    """Curated tables: every referenced parent must be selected; result is in dependency order."""
    chosen = set(_names(text, entities, "silver tables"))
    for name in sorted(chosen):
        missing = sorted({r.parent for r in entities[name].references} - chosen)
        if missing:
            raise ValueError(f"silver tables: {name} needs {missing}")
    return tuple(n for n in entities if n in chosen)


def select_models(text, models: Mapping[str, Model]) -> tuple[str, ...]:
    """Star-schema models: dimensions always run before facts."""
    chosen = set(_names(text, models, "gold models"))
    return tuple(n for n in models if n in chosen)
