"""Label normalisation: numeric conventions per origin (C2/J2), names <-> ids."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from textlens.constants import (DEFAULT_NUMERIC_LABELS, FILE_NUMERIC_LABELS,
                                LABEL2ID, LABELS)
from textlens.functions.text import capitalize, is_integer_string, strip_ws


def _str_map(d: Mapping[str, str]) -> Column:
    items = []
    for k, v in d.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items) if items else F.create_map().cast("map<string,string>")


def map_numeric_label(label: Column, origin: Column,
                      conventions: Mapping[str, Mapping[str, str]] | None = None) -> Column:
    """Numeric code -> name, by the convention of the row's origin.

    Origins listed in ``conventions`` map their string codes only; every other
    origin uses the default convention, where a code also matches through its
    integer value ('00', '-0').  Anything unmapped passes through unchanged.
    """
    conventions = FILE_NUMERIC_LABELS if conventions is None else conventions
    default_str = _str_map(DEFAULT_NUMERIC_LABELS)
    default_int = F.create_map(*[x for k, v in DEFAULT_NUMERIC_LABELS.items()
                                 for x in (F.lit(int(k)).cast("bigint"), F.lit(v))])
    by_int = F.when(is_integer_string(label),
                    F.try_element_at(default_int, label.try_cast("bigint")))
    default_val = F.coalesce(F.try_element_at(default_str, label), by_int, label)
    if not conventions:
        return default_val
    per_origin = F.create_map(*[x for o, m in conventions.items()
                                for x in (F.lit(o), _str_map(m))])
    override = F.try_element_at(per_origin, origin)
    return F.when(override.isNotNull(),
                  F.coalesce(F.try_element_at(override, label), label)
                  ).otherwise(default_val)


def normalize_label(raw: Column, origin: Column,
                    conventions: Mapping[str, Mapping[str, str]] | None = None) -> Column:
    """strip -> numeric map -> capitalise (the order of the loader)."""
    return capitalize(map_numeric_label(strip_ws(raw), origin, conventions))


def label_id(name: Column) -> Column:
    """P6 name -> id; null for names outside the label set."""
    m = F.create_map(*[x for k, v in LABEL2ID.items() for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(m, name)


def label_name(idc: Column) -> Column:
    """P6 id -> name."""
    return F.try_element_at(F.array(*[F.lit(x) for x in LABELS]), idc.cast("int") + 1)


def is_known_label(name: Column) -> Column:
    """F3 allow-list."""
    return name.isin(*LABELS)
