"""A registry of queries and oracle SQL, and the tables both run on."""

from __future__ import annotations

import functools
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.stand_ins import STAND_INS
from tablekit.operators.sql import cte_chain
from tablekit.storage import work_dir

BASE = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

TABLE = re.compile(rf"(?<=\bfrom |\bjoin )({'|'.join(BASE)})\b")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Given tables and stand-in views as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name in STAND_INS:
            # no views by these names: the caller and calls in other threads share them, and may read other tables
            named = set(TABLE.findall(STAND_INS[name]))
            return cte_chain({table: getattr(self, table) for table in named}, TABLE.sub(r"{\1}", STAND_INS[name]))
        raise AttributeError(name)

    def dir(self, label: str) -> str:
        return work_dir(self.spark, label)


def fixed(sql: str, digits: int) -> str:
    """Half-up rounding of a double's shortest decimal, once; sums and means of doubles are compensated."""
    exact = re.sub(r"\bsum\(", "fsum(", re.sub(r"\bavg\(([^()]*)\)", r"(sum(\1) / count(\1))", sql))
    return f"round(cast(cast(({exact})::double as varchar) as decimal(38,15)), {digits})::double"


def with_views(sql: str, views: tuple[str, ...]) -> str:
    """Put the stand-ins before the query as common table expressions."""
    if not views:
        return sql
    heads = ", ".join(f"{v} as ({STAND_INS[v]})" for v in views)
    body = sql.strip()
    if body.lower().startswith("with "):
        return f"with {heads}, {body[5:]}"
    return f"with {heads} {body}"


def check(key: str, oracle: str | None = None, views: str = ""):
    """Register a query; ``views`` names the stand-ins its oracle SQL uses."""

    def register(fn: Callable[[Tables], DataFrame]):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = run
        if oracle:
            ORACLES[key] = with_views(oracle, tuple(views.split()))
        return fn

    return register
