"""Fields of schema-on-read (variant) rows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def field(column: str, path: str, data_type: str, strict: bool = True) -> Column:
    """The value at ``path`` cast to ``data_type``; a bad cast fails the job when strict."""
    get = F.variant_get if strict else F.try_variant_get
    return get(F.col(column), path, data_type)


def integer_field(column: str, path: str, strict: bool = True) -> Column:
    """A number rounded (not truncated) to a whole one."""
    return field(column, path, "decimal(38,0)", strict).cast("bigint")


def has_path(column: str, path: str) -> Column:
    """Whether the key exists. A JSON null counts as present."""
    return F.variant_get(F.col(column), path, "variant").isNotNull()


def variant_fields(column: str, fields: dict[str, tuple[str, str]], strict: bool = True) -> list[Column]:
    """One aliased column per ``name: (path, type)``; type ``integer`` rounds."""
    return [
        (integer_field(column, path, strict) if kind == "integer" else field(column, path, kind, strict)).alias(name)
        for name, (path, kind) in fields.items()
    ]
