"""Severity of a finding line."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from exposure.schemas import SEVERITIES


def severity_of(line: Column) -> Column:
    """The highest severity whose ``[tag]`` occurs anywhere in the line, in any letter case."""
    lowered = F.lower(line)
    first, *others = SEVERITIES
    tag = F.when(lowered.contains(f"[{first}]"), first)
    for name in others:
        tag = tag.when(lowered.contains(f"[{name}]"), name)
    return tag


def severity_rank(severity: Column) -> Column:
    pairs = chain.from_iterable((F.lit(s), F.lit(i)) for i, s in enumerate(SEVERITIES, start=1))
    return F.element_at(F.create_map(*pairs), severity)


def known_severities(requested: Column) -> Column:
    """True when every requested level is known; letter case matters.

    An empty or missing request names no unknown level.
    """
    known = F.array(*[F.lit(s) for s in SEVERITIES])
    return F.coalesce(
        F.forall(requested, lambda level: F.array_contains(known, level)), F.lit(True)
    )


def severity_wanted(severity: Column, requested: Column) -> Column:
    """A missing or empty request keeps everything."""
    return F.coalesce(
        F.coalesce(F.size(requested), F.lit(0)).isin(0, -1)
        | F.array_contains(requested, severity),
        F.lit(False),
    )
