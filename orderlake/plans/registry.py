"""Transform registry: which function feeds which table, under which key."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from orderlake.operators import flatten


@dataclass(frozen=True)
class Transform:
    name: str
    fn: Callable[..., DataFrame]
    table: str
    keys: list[str]


_REGISTRY: dict[str, Transform] = {}


def register(name: str, fn: Callable[..., DataFrame], table: str, keys: list[str]) -> Transform:
    """Add a transform, or replace the one of that name."""
    _REGISTRY[name] = Transform(name, fn, table, keys)
    return _REGISTRY[name]


def transforms() -> dict[str, Transform]:
    return dict(_REGISTRY)


def apply(df: DataFrame, name: str, **options) -> DataFrame:
    return df.transform(_REGISTRY[name].fn, **options)


# The six history tables; a table's hash key is named after it.
for _name in ("order", "payment", "offerhead", "bucket", "row", "offerline"):
    register(
        _name, getattr(flatten, f"flatten_{_name}_h"), f"orderupdated_{_name}", [f"{_name}_hashkey"]
    )
