"""Helpers shared by the corpus operators."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import functools
import mmap
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but these six characters. ``bytes.split()`` cuts at exactly the same six.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. A local session (tests) may leave it unset."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="tidemark-")
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir() or named


_written: list = []


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again; removed when the session ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tidemark-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not _written:
        atexit.register(drop, spark)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of a worker's memory from which a task gives back what it held; small tasks are many, and this takes a while.
TIDY_FROM = 256 << 20


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over Arrow batches that at its end gives the memory it held back to the system: a Python worker lives on
    after its task, and what its allocators keep counts against the executor."""

    @functools.wraps(run)
    def held(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            with contextlib.suppress(OSError, AttributeError):  # another system has no such file or call
                with open("/proc/self/statm") as sizes:
                    resident = int(sizes.read().split()[1]) * mmap.PAGESIZE
                if resident > TIDY_FROM:
                    pa.default_memory_pool().release_unused()
                    ctypes.CDLL("libc.so.6").malloc_trim(0)

    return held


def mark() -> int:
    """How many tables :func:`written` has made: a place in their order."""
    return len(_written)


def drop(spark: SparkSession, since: int = 0, until: int | None = None) -> None:
    """Remove the tables made from one mark to another; only for who made all of them and needs them no more."""
    if spark.sparkContext._jsc is None:
        return
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for k in range(since, len(_written) if until is None else until):
        if _written[k]:
            at = jvm.org.apache.hadoop.fs.Path(_written[k])
            at.getFileSystem(conf).delete(at, True)
            _written[k] = None


def settled(df: DataFrame, since: int) -> DataFrame:
    """``df`` written, and the tables that it was made of since a mark removed."""
    until = mark()
    out = written(df)
    drop(df.sparkSession, since, until)
    return out


class Chain:
    """Steps in which each reads what the last one gave, and the tables that they make on the way.

    A step that writes its whole input first no longer needs what earlier steps made, so these tables go, and no others:
    neither those of another chain nor those of anyone else in the session.
    """

    def __init__(self) -> None:
        self.made: list[tuple[int, int]] = []

    def step(self, f: Callable[[DataFrame], DataFrame], whole: bool) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
        def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            since = mark()
            out = f(docs)
            if whole:
                for tables in self.made:
                    drop(spark, *tables)
                self.made = []
            self.made.append((since, mark()))
            return out

        return run


def with_rows(docs: DataFrame) -> DataFrame:
    """(doc, row): each row of ``docs`` whole in one struct, so that no column of its can clash, and a number of its own."""
    return docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("row"))


def field(name: str) -> Column:
    return F.col("doc").getField(name)


#: Left rows from which a key is hot, and hot keys that are broadcast at most.
HOT, MOST_HOT = 1 << 16, 1 << 16


def join_by_key(left: DataFrame, right: DataFrame, on: str, many: str, how: str = "inner", hot: int = HOT) -> DataFrame:
    """``left`` with the one row that ``right`` has for each key; ``many`` of ``right`` counts the left rows of a key.

    Hot keys are broadcast, so that no task gets all left rows of one: the hottest, and no more than ``MOST_HOT``, whose
    size is bounded. A key of a table with over ``hot * MOST_HOT`` left rows may be hot and not among them; those go
    through the shuffle join, where Spark splits skewed partitions.
    """
    right = right.withColumn(many, F.coalesce(many, F.lit(0)))
    big = right.where(F.col(many) > hot).orderBy(F.desc(many), on).limit(MOST_HOT)
    keys = F.broadcast(big.select(on))
    rest = left.join(keys, on, "left_anti").join(right.join(keys, on, "left_anti").drop(many), on, how)
    return rest.unionByName(left.join(F.broadcast(big.drop(many)), on))


def in_fold(key: str, modulus: int, fold: int) -> Column:
    """Whether crc32 of the id's text leaves ``fold``; a null id leaves crc32 of the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus == fold


def py_in_fold(key, modulus: int, fold: int) -> bool:
    return zlib.crc32(b"" if key is None else str(key).encode()) % modulus == fold
