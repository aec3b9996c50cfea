"""Rewriting nested columns at any depth: keys, private fields, and values of structs, arrays and maps.

The rewrite follows the column's type once, when the plan is made, and leaves one expression; parts of the type that
nothing changes are passed through as they are. Null structs, arrays and maps stay null.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructType

from .expressions import camel_to_snake, remap_path

Leaf = Callable[[Column, DataType], Column]


class Rewrite:
    """``name`` renames struct fields, ``keep`` says which stay, ``key`` maps the keys of maps, ``leaf`` all other values."""

    def __init__(self, name: Callable[[str], str] | None = None, keep: Callable[[str], bool] | None = None, key: Callable[[Column], Column] | None = None, leaf: Leaf | None = None):
        self.name, self.keep, self.key, self.leaf = name or (lambda n: n), keep or (lambda n: True), key, leaf

    def changes(self, kind: DataType) -> bool:
        if isinstance(kind, StructType):
            return any(self.name(f.name) != f.name or not self.keep(f.name) or self.changes(f.dataType) for f in kind.fields)
        if isinstance(kind, ArrayType):
            return self.changes(kind.elementType)
        if isinstance(kind, MapType):
            return (self.key is not None and isinstance(kind.keyType, StringType)) or self.changes(kind.valueType)
        return self.leaf is not None and isinstance(kind, StringType)

    def apply(self, value: Column, kind: DataType) -> Column | None:
        """The rewritten value; nothing for a struct of which no field is kept."""
        if not self.changes(kind):
            return value
        if isinstance(kind, StructType):
            fields = self.fields(lambda f: value.getField(f), kind)
            return F.when(value.isNotNull(), F.struct(*fields)) if fields else None
        if isinstance(kind, ArrayType):
            probe = self.apply(F.lit(None).cast(kind.elementType), kind.elementType)
            return None if probe is None else F.transform(value, lambda x: self.apply(x, kind.elementType))
        if isinstance(kind, MapType):
            if self.apply(F.lit(None).cast(kind.valueType), kind.valueType) is None:
                return None
            out = F.transform_values(value, lambda k, v: self.apply(v, kind.valueType)) if self.changes(kind.valueType) else value
            return F.transform_keys(out, lambda k, v: self.key(k)) if self.key is not None and isinstance(kind.keyType, StringType) else out
        return self.leaf(value, kind)

    def fields(self, get: Callable[[str], Column], kind: StructType) -> list[Column]:
        """Named fields that are kept; of names that become equal the first stays."""
        out: dict[str, Column] = {}
        for f in kind.fields:
            name = self.name(f.name)
            if self.keep(f.name) and name not in out and (v := self.apply(get(f.name), f.dataType)) is not None:
                out[name] = v.alias(name)
        return list(out.values())

    def frame(self, df: DataFrame) -> DataFrame:
        return df.select(*self.fields(lambda n: F.col("`" + n.replace("`", "``") + "`"), df.schema))


def snake_name(name: str) -> str:
    """The same rule as ``camel_to_snake`` for a field's name."""
    return re.sub("([a-z0-9])([A-Z])", r"\1_\2", re.sub("([A-Z]+)([A-Z][a-z])", r"\1_\2", name)).lower()


def snake_keys(df: DataFrame) -> DataFrame:
    """Field names and map keys at any depth in snake case."""
    return Rewrite(name=snake_name, key=camel_to_snake).frame(df)


def without_private(df: DataFrame, prefix: str = "_") -> DataFrame:
    """Without the fields whose name begins with ``prefix``, at any depth, and without structs that lose all fields."""
    return Rewrite(keep=lambda n: not n.startswith(prefix)).frame(df)


def remap_paths(df: DataFrame, old: str, new: str) -> DataFrame:
    """Every text at any depth that begins with ``old`` begins with ``new`` instead; keys stay."""
    return Rewrite(leaf=lambda v, _: remap_path(v, old, new)).frame(df)


def message_json(df: DataFrame, keys: list[str], prefix: str = "_") -> DataFrame:
    """``keys`` and the whole rest of a message as JSON, private fields dropped at any depth."""
    rest = df.drop(*keys).schema
    fields = Rewrite(keep=lambda n: not n.startswith(prefix)).fields(lambda n: F.col("`" + n.replace("`", "``") + "`"), rest)
    return df.select(*keys, (F.to_json(F.struct(*fields)) if fields else F.lit("{}")).alias("message"))
