"""A table of another store, read in ranges of a unique key: a data source that any database module with cursors serves.

``spark.read.format("keyed")`` with options ``module`` (a Python database module: its ``connect(database)`` gives what has
``execute``), ``database``, ``table``, ``key`` and ``parts``. The store is asked for the keys at the boundaries of equal
parts, so that each task reads about as many rows; ranges by key, unlike pages by offset, neither overlap nor miss rows
while the table grows. A key that repeats or may be null can't order the table and is refused before anything is read.
Comparisons with constants are passed on to the store, and only the rows they leave are cut into parts.

An empty table is one part without rows. Types are those of the first rows, a column without a value there being a string;
``schema`` says otherwise.
"""

from __future__ import annotations

import datetime as dt
import decimal
from collections.abc import Iterator
from importlib import import_module

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StructType

COMPARED = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
#: Rows that a task fetches at a time, and those that types are taken from.
ROWS, LOOKED_AT = 10_000, 1_000


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


class NotUnique(ValueError):
    """The key doesn't tell all rows apart."""


class Store:
    """Questions to the other store, with the values as parameters."""

    def __init__(self, options: dict[str, str]):
        self.table, self.key = options["table"], options["key"]
        self.connection = import_module(options.get("module", "sqlite3")).connect(options.get("database", ":memory:"))

    def rows(self, sql: str, values: tuple = ()) -> list[tuple]:
        return self.connection.execute(sql, values).fetchall()

    def check_key(self) -> None:
        k = quoted(self.key)
        if self.rows(f"select 1 from {self.table} where {k} is null limit 1") or self.rows(f"select {k} from {self.table} group by {k} having count(*) > 1 limit 1"):
            raise NotUnique(f"{self.table}: {self.key} is not unique, so ranges of it would repeat or skip rows")

    def boundaries(self, parts: int, where: str, values: tuple) -> list:
        """Keys that cut the rows into equal parts."""
        (n,) = self.rows(f"select count(*) from {self.table}{where}", values)[0]
        k = quoted(self.key)
        cuts = sorted({n * i // parts for i in range(1, parts)} - {0})
        return [self.rows(f"select {k} from {self.table}{where} order by {k} limit 1 offset {c}", values)[0][0] for c in cuts if c < n]

    def schema(self) -> StructType:
        cursor = self.connection.execute(f"select * from {self.table} limit {LOOKED_AT}")
        names = [d[0] for d in cursor.description]
        columns = list(zip(*cursor.fetchall())) or [()] * len(names)
        known = [pa.array(c) if any(v is not None for v in c) else pa.array([], pa.string()) for c in columns]
        return from_arrow_schema(pa.schema([(n, c.type) for n, c in zip(names, known)]))


class Range(InputPartition):
    """Keys from ``low`` (inclusive) to ``high`` (exclusive); none is open."""

    def __init__(self, low, high):
        self.low, self.high = low, high


class KeyedReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.options, self.schema = options, schema
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = ".".join(getattr(f, "attribute", ()))
            plain = lambda v: isinstance(v, (int, float, str, dt.date, decimal.Decimal))
            if type(f) in COMPARED and plain(f.value):
                self.tests.append((column, COMPARED[type(f)], f.value))
            elif isinstance(f, In) and f.value and all(map(plain, f.value)):
                self.tests.append((column, "in", tuple(f.value)))
            elif isinstance(f, IsNotNull):
                self.tests.append((column, "is not null", None))
            else:
                yield f

    def _where(self, low=None, high=None) -> tuple[str, tuple]:
        tests = self.tests + [(self.options["key"], op, v) for op, v in ((">=", low), ("<", high)) if v is not None]
        texts, values = [], []
        for column, op, v in tests:
            texts.append(f"{quoted(column)} {op}" + ("" if v is None else f" ({', '.join('?' * len(v))})" if op == "in" else " ?"))
            values += [] if v is None else v if op == "in" else [v]
        return (" where " + " and ".join(texts) if texts else ""), tuple(values)

    def partitions(self) -> list[Range]:
        store = Store(self.options)
        store.check_key()
        cuts = store.boundaries(int(self.options.get("parts", "8")), *self._where())
        return [Range(low, high) for low, high in zip([None, *cuts], [*cuts, None])]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        store = Store(self.options)
        where, values = self._where(partition.low, partition.high)
        names = ", ".join(quoted(f.name) for f in self.schema.fields)
        cursor = store.connection.execute(f"select {names} from {store.table}{where}", values)
        kinds = to_arrow_schema(self.schema)
        while rows := cursor.fetchmany(ROWS):
            yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows), kinds)], schema=kinds)


class Keyed(DataSource):
    @classmethod
    def name(cls) -> str:
        return "keyed"

    def schema(self) -> StructType:
        return Store(dict(self.options)).schema()

    def reader(self, schema: StructType) -> KeyedReader:
        return KeyedReader(dict(self.options), schema)


def register(spark: SparkSession) -> None:
    """Make ``format("keyed")`` known to the session, with filters passed on."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Keyed)
