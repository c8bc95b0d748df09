"""Pluggable sources: a function from a specification to candidates."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.landing import union_sources
from ..operators.links import DATA_SUFFIX


@dataclass(frozen=True)
class SourceSpec:
    """What a source is given: its URL rows ``(pos, url)`` and where its files go.

    ``carry`` names further columns of ``urls``, kept in the candidates: rows that agree in
    them are one list. The destination may then be one of them.
    """

    urls: DataFrame
    destination: str | Column
    pages: DataFrame | None = None
    suffix: str = DATA_SUFFIX
    select: str = "all"
    carry: tuple[str, ...] = ()

    @property
    def folder(self) -> Column:
        return self.destination if isinstance(self.destination, Column) else F.lit(self.destination)


Source = Callable[[SourceSpec], DataFrame]

SOURCES: dict[str, Source] = {}


def source(name: str) -> Callable[[Source], Source]:
    """Register a source under a name."""

    def add(function: Source) -> Source:
        SOURCES[name] = function
        return function

    return add


def candidates(specs: Iterable[tuple[str, SourceSpec]]) -> DataFrame:
    """The candidates of all sources, in the given order of sources."""
    return union_sources(*(SOURCES[name](spec) for name, spec in specs))
