"""Reading messages as VARIANT, which tells a field that is missing from one that is null."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def field(of: Column, name: str) -> Column:
    """The field as VARIANT: SQL null if there is none, a variant null if null is written out."""
    return F.try_variant_get(of, f"$.{name}", "variant")


def value(of: Column, name: str, kind: str) -> Column:
    """The field as a type; null also where it is of another kind."""
    return F.try_variant_get(of, f"$.{name}", kind)


def is_text(of: Column, name: str) -> Column:
    """Whether the field is a text: of all kinds of values only those become bytes."""
    return value(of, name, "binary").isNotNull()


def fields_null(of: Column, names: Mapping[str, str]) -> list[tuple[Column, str]]:
    """Checks that fail for a null written out; names: the field's, which a column has that holds its value, to the one in the reason.

    Only a field without a value is looked at again.
    """
    return [(F.col(name).isNull() & F.is_variant_null(field(of, name)), f"null {shown}") for name, shown in names.items()]
