"""Named plans over the study tables, each with the SQL that states its result."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from cohortwave.plans.views import Tables


@dataclass(frozen=True)
class Plan:
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Tables(spark, sf_dir))


PLANS: dict[str, Plan] = {}


def plan(sql: str | None = None):
    """Register a function under its own name."""

    def add(fn: Callable[[Tables], DataFrame]):
        PLANS[fn.__name__] = Plan(fn, sql)
        return fn

    return add
