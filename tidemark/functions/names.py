"""Column names: cleaning rules, and choosing columns by presence, type or pattern (no job runs)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The literal replacements of each name style, applied in this order.
NAME_STYLES: dict[str, list[tuple[str, str]]] = {
    "basic": [(" ", "_"), ("(", ""), (")", "")],
    "no_degree": [(" ", "_"), ("(", ""), (")", ""), ("°", "")],
    "no_slash": [(" ", "_"), ("(", ""), (")", ""), ("/", "_")],
    "standard": [("°c", ""), ("°", ""), ("mm", ""), ("/", "_"), (" ", "_"), ("(", ""), (")", ""), (".", "_")],
}


def clean_name(name: str, style: str = "standard") -> str:
    """One cleaned name. ``standard`` also strips, lowers, and drops underscores left at the end."""
    standard = style == "standard"
    cleaned = name.strip().lower() if standard else name
    for old, new in NAME_STYLES[style]:
        cleaned = cleaned.replace(old, new)
    return cleaned.rstrip("_") if standard else cleaned


def with_clean_names(df: DataFrame, style: str = "standard") -> DataFrame:
    names = [clean_name(c, style) for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"cleaning makes equal names: {sorted(n for n in set(names) if names.count(n) > 1)}")
    return df.toDF(*names)


def rename_key(df: DataFrame, key: str = "date", spellings: Sequence[str] = ("time", "date", "Date")) -> DataFrame:
    """Give the date column one name, whichever spelling the table uses."""
    if key in df.columns:
        return df
    found = [s for s in spellings if s in df.columns]
    return df.withColumnRenamed(found[0], key) if found else df


def present(df: DataFrame, wanted: Iterable[str]) -> list[str]:
    """The wanted columns that exist, in the wanted order."""
    have = set(df.columns)
    return [c for c in wanted if c in have]


def select_present(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    return df.select(*present(df, wanted))


def numeric_columns(df: DataFrame, without: Iterable[str] = ()) -> list[str]:
    skip = set(without)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def feature_columns(df: DataFrame, exclude: Iterable[str]) -> list[str]:
    """All columns outside the exclude list, in table order."""
    skip = set(exclude)
    return [c for c in df.columns if c not in skip]


def columns_like(df: DataFrame, ending: Sequence[str] = (), containing: Sequence[str] = ()) -> list[str]:
    """Columns that end with, or contain, one of the given texts."""
    return [c for c in df.columns if c.endswith(tuple(ending)) or any(part in c for part in containing)]


def resolve_strict(df: DataFrame, wanted: Iterable[str]) -> list[str]:
    """The wanted columns; an unknown name is an error rather than a silent gap."""
    names = list(wanted)
    unknown = [c for c in names if c not in df.columns]
    if unknown:
        raise ValueError(f"columns not in the table: {unknown}")
    return names
