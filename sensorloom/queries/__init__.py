"""Registered queries: each operator bound to the given tables, next to its SQL twin."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame

from ..sources.bindings import Tables

AREAS = ("signal", "scoring", "intervals", "events", "rollups", "ensembles", "components", "detectors",
         "catalogue", "lineage", "spatial", "statistics", "transforms", "incremental", "storage")


class Query(NamedTuple):
    run: Callable[[Tables], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(fn, sql)
        return fn

    return register


def load() -> dict[str, Query]:
    from pyspark import cloudpickle

    from ..functions import kernels

    cloudpickle.register_pickle_by_value(kernels)
    for area in AREAS:
        importlib.import_module(f"{__name__}.{area}")
    return REGISTRY
