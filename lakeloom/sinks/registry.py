"""Pluggable sinks: a function that lands candidates and returns outcome counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

Sink = Callable[..., DataFrame]

SINKS: dict[str, Sink] = {}


def sink(name: str) -> Callable[[Sink], Sink]:
    """Register a sink ``(candidates, objects, layer, load_id=None) -> outcomes``."""

    def add(function: Sink) -> Sink:
        SINKS[name] = function
        return function

    return add
