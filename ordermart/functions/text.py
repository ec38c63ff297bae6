"""String expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalise_city(c: Column | str, aliases: Mapping[str, str] | None = None) -> Column:
    """``upper(trim(city))``; optional alias map (e.g. a misspelling -> fix).

    The alias map is a literal ``map`` expression, so it costs nothing at
    runtime and needs no join.
    """
    c = F.col(c) if isinstance(c, str) else c
    norm = F.upper(F.trim(c))
    if not aliases:
        return norm
    pairs = []
    for k, v in aliases.items():
        pairs += [F.lit(k.strip().upper()), F.lit(v.strip().upper())]
    return F.coalesce(F.create_map(*pairs)[norm], norm)
