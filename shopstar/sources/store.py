"""Where built tables live between steps.

``LazyStore`` keeps every table as a plan (tests, the correctness gate).
``ParquetStore`` writes each table under a root folder and reads it back,
which cuts lineage: a lost executor recomputes from the written files, not
from the sources, and later steps get column pruning and footer counts.
``CachedStore`` writes the session's tables to scratch, each when it is asked
for (``Tables``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from threading import RLock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstar.session import kept_scratch, scratch_folder


#: Scratch tables hold many numbers in order, which this codec takes to a third of the default's bytes.
SCRATCH_CODEC = "zstd"


def written(df: DataFrame, name: str, *parts: DataFrame) -> DataFrame:
    """``df``, and further ``parts`` of the same columns one after another, as a
    table in the shared scratch folder: computed once, its lineage cut, its size
    known to later joins."""
    path = scratch_folder(df.sparkSession, name)
    for part in (df, *parts):
        part.write.mode("append").option("compression", SCRATCH_CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Tables(Mapping):
    """Named tables, each built when it is first asked for: a question builds,
    shuffles and writes what it reads and no more."""

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]]):
        self._builders, self._built, self._lock = dict(builders), {}, RLock()

    def __getitem__(self, name: str) -> DataFrame:
        with self._lock:
            if name not in self._built:
                with kept_scratch():
                    self._built[name] = self._builders[name]()
            return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def over(self, **others: Callable[[], DataFrame]) -> Tables:
        """These tables, some replaced."""
        return Tables({**{n: (lambda n=n: self[n]) for n in self}, **others})


#: Rows in one clustered file, a few hundred MB of a fact.
ROWS_PER_FILE = 8_000_000


def cluster_by(df: DataFrame, *cols: str) -> DataFrame:
    """Lay a fact out in range-clustered files on ``cols`` (sorted inside
    each): scans run in parallel and a date filter skips whole files and row
    groups through their min/max stats. The number of files follows the rows
    (a count of the written numbering), ``spark.sql.shuffle.partitions`` at
    least. The last column is unique, so one hot date is still split over files."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = max(least, -(-df.count() // ROWS_PER_FILE))
    return df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)


class LazyStore:
    parallel = 1
    #: Whether a session's tables are built one by one as they are asked for.
    on_demand = False

    def put(self, name: str, df: DataFrame, months: tuple[str, str] | None = None,
            unique: str | None = None) -> DataFrame:
        """Keep a table. ``months``: (column, date key); a store that writes
        files writes a folder for each month of the key, in that column, its
        files clustered by the key and the ``unique`` column. Only files gain
        by that layout, so only a store that writes them pays its shuffle."""
        return df

    def view(self, name: str, df: DataFrame) -> DataFrame:
        """Keep a table that reads a written or kept one row by row."""
        return self.put(name, df)

    def put_all(self, builders: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
        """Build and put independent tables. A writing store runs them as
        concurrent Spark jobs from a few driver threads, so small jobs
        overlap instead of queueing behind each other."""
        if self.parallel <= 1 or len(builders) <= 1:
            return {name: self.put(name, build()) for name, build in builders.items()}
        with ThreadPoolExecutor(max_workers=min(self.parallel, len(builders))) as pool:
            futures = {name: pool.submit(lambda n=name, b=build: self.put(n, b()))
                       for name, build in builders.items()}
            return {name: f.result() for name, f in futures.items()}


class ParquetStore(LazyStore):
    def __init__(self, spark: SparkSession, root: str, parallel: int = 4):
        self.spark = spark
        self.root = root.rstrip("/")
        self.parallel = parallel

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def put(self, name: str, df: DataFrame, months: tuple[str, str] | None = None,
            unique: str | None = None) -> DataFrame:
        write = df.write
        if months:
            column, key = months
            df = cluster_by(df, key, unique) if unique else df
            write = df.withColumn(column, F.floor(F.col(key) / 100).cast("int")).write.partitionBy(column)
        write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.parquet(self.path(name))

    def get(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))


class CachedStore(LazyStore):
    """Writes each table to the shared scratch folder when it is first asked
    for: some bytes a row, where rows cached in memory would fill it and spill
    several times that to the executors' disks. Facts and other views of written
    tables (``global_order`` writes what it numbers) are read from those."""

    on_demand = True

    def put(self, name: str, df: DataFrame, months: tuple[str, str] | None = None,
            unique: str | None = None) -> DataFrame:
        return df if months else written(df, name)

    def view(self, name: str, df: DataFrame) -> DataFrame:
        return df
