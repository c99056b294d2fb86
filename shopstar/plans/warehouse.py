"""One built warehouse per (session, data folder): sources -> staging ->
star, as plans (``LazyStore``) or written tables (``ParquetStore``).

Building writes tables (the numbered ones in any store), so they are kept per
session and reused by every query instead of being built each time. With a
store that builds on demand a query builds the tables it reads and what those
derive from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstar.plans.staging import stage_all, stage_on_demand
from shopstar.plans.star import build_dimensions, build_star, dimensions_on_demand, facts_on_demand
from shopstar.session import size_tasks
from shopstar.sources.fixture import TPCH_TABLES, load_sources
from shopstar.sources.store import CachedStore, LazyStore


class Warehouse:
    def __init__(self, spark: SparkSession, sf_dir: str, store: LazyStore | None = None,
                 source_store: LazyStore | None = None, input_bytes: int = 0):
        self.spark = spark
        self.sf_dir = sf_dir
        self.input_bytes = input_bytes
        self.store = store or LazyStore()
        # where the landed source tables go (default: with the rest)
        self.source_store = source_store or self.store
        self._sources: dict[str, DataFrame] | None = None
        self._staged: dict[str, DataFrame] | None = None
        self._dimensions: dict[str, DataFrame] | None = None
        self._star: dict[str, DataFrame] | None = None

    @property
    def sources(self) -> dict[str, DataFrame]:
        if self._sources is None:
            self._sources = load_sources(self.spark, self.sf_dir, self.source_store)
        return self._sources

    @property
    def staged(self) -> dict[str, DataFrame]:
        if self._staged is None and self.store.on_demand:
            self._staged = stage_on_demand(self.sources, self.store)
        elif self._staged is None:
            plans = stage_all(self.sources)
            self._staged = self.store.put_all({name: (lambda d=df: d) for name, df in plans.items()})
        return self._staged

    @property
    def dimensions(self) -> dict[str, DataFrame]:
        """The star's dimensions, for what needs no fact: numbering a fact writes it."""
        if self._dimensions is None:
            build = dimensions_on_demand if self.store.on_demand else build_dimensions
            self._dimensions = build(self.staged, self.store)
        return self._dimensions

    @property
    def star(self) -> dict[str, DataFrame]:
        if self._star is None and self.store.on_demand:
            self._star = facts_on_demand(self.staged, self.store, self.dimensions, self.input_bytes)
        elif self._star is None:
            self._star = build_star(self.staged, self.store, self.dimensions)
        return self._star


_CACHE: dict[tuple[int, str], tuple[Warehouse, tuple]] = {}


def _stamp(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of the folder's files, summed up (a listing
    job), and the bytes of those that the warehouse reads."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "*.parquet").load(sf_dir))
    return tuple(files.agg(F.count("*"), F.bit_xor(F.xxhash64("path", "length", "modificationTime")),
                           F.sum(F.when(F.col("path").rlike(f"/({'|'.join(TPCH_TABLES)})[.]parquet(/|$)"), F.col("length")))
                           ).first())


def release(spark: SparkSession, sf_dir: str) -> None:
    """Forget the folder's tables."""
    _CACHE.pop((id(spark), sf_dir.rstrip("/")), None)


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse for this session and folder: staged and star tables are
    built on first use and shared by every query, until the folder's files
    change or :func:`release` is called."""
    sf_dir = sf_dir.rstrip("/")
    key, stamp = (id(spark), sf_dir), _stamp(spark, sf_dir)
    size_tasks(spark, stamp[-1] or 0)
    wh, seen = _CACHE.get(key, (None, None))
    if wh is None or wh.spark is not spark or seen != stamp:
        release(spark, sf_dir)
        wh = Warehouse(spark, sf_dir, CachedStore(), input_bytes=stamp[-1] or 0)
        _CACHE[key] = wh, stamp
    return wh
