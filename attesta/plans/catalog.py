"""Catalogue of queries over the given tables, each with its independent SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from attesta.session import configure

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Bound:
    name: str
    covers: str
    run: Query
    oracle: str | None


CATALOG: dict[str, Bound] = {}


def bind(name: str, covers: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``; ``covers`` names the blueprint rows it exercises."""

    def register(function: Query) -> Query:
        if name in CATALOG:
            raise ValueError(f"query {name} is bound twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(configure(spark), sf_dir)

        CATALOG[name] = Bound(name, covers, run, oracle)
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
