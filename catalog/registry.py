"""Registry of queries: a Spark callable per inventory entry, with its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import Future
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.raw_views import raw
from catalog.views_sql import with_ctes
from outorga.schemas import stage_schema
from outorga.session import CODEC, begun, new_folder, spread, tune
from outorga.sources.stage import clean_stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


#: Extracts that give the fact its order of rows. Spark's k-means draws its seeds from the rows in that order, so
#: another one would be another model; their whole rows are shuffled to find copies.
IN_ORDER = {"propostas", "convenios", "proponentes"}


class Staged(dict):
    """Staged tables by name. Like a run, a query stages each table it needs once, to Parquet, and
    builds on what it reads back. Tables named in ``begin`` are staged beside other work, the first one first.
    Without ``in_order`` no extract has its whole rows shuffled."""

    def __init__(self, inputs: Inputs, in_order: bool = True) -> None:
        super().__init__()
        self.inputs, self.folder = inputs, inputs.scratch()
        self.in_order = IN_ORDER if in_order else set()
        self.begun: dict[str, Future] = {}

    def begin(self, *names: str) -> Staged:
        self.begun = dict(zip(names, begun(self.inputs.spark, [partial(self._stage, name) for name in names])))
        return self

    def _stage(self, name: str) -> DataFrame:
        def keep(rows: DataFrame) -> DataFrame:
            path = f"{self.folder}/stage/{name}"
            rows.write.option("compression", CODEC).parquet(path)
            return self.inputs.spark.read.schema(stage_schema(name)).parquet(path)

        rows = raw(lambda t: spread(self.inputs.table(t)), name)
        return keep(clean_stage(rows, name)) if name in self.in_order else clean_stage(rows, name, keep)

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self.begun[name].result() if name in self.begun else self._stage(name)
        return self[name]


class Inputs:
    """Tables of one data directory: typed (``i.orders``), raw-shaped and staged."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    def __getattr__(self, name: str) -> DataFrame:
        return self.table(name)

    def raw(self, name: str) -> DataFrame:
        return raw(self.table, name)

    def staged(self, in_order: bool = True) -> Staged:
        return Staged(self, in_order)

    def scratch(self) -> str:
        return new_folder(self.spark)


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the form both engines agree on."""

    def plain(f: T.StructField):
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f.name).cast("double").alias(f.name)
        return F.col(f.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[Inputs], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(fn(Inputs(tune(spark), sf_dir.rstrip("/"))))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = with_ctes(sql)
        return fn

    return register
