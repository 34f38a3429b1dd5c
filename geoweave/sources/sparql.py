"""Paged query endpoints as a data source; the fetcher is given, so tests run offline."""

from __future__ import annotations

import json
import re
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

Fetch = Callable[[str, str], dict]


def http_fetch(endpoint: str, statement: str) -> dict:
    """Query results of an endpoint in the standard JSON format."""
    url = endpoint + "?" + urllib.parse.urlencode({"query": statement, "format": "json"})
    with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": "geoweave"}), timeout=300) as r:  # noqa: S310
        return json.load(r)


class _Page(InputPartition):
    def __init__(self, offset: int):
        self.offset = offset


def source(fetch: Fetch = http_fetch) -> type[DataSource]:
    """A data source class ``sparql``: options endpoint, query, page, pages; columns by the schema given.

    Each partition reads one page with LIMIT and OFFSET and follows on with
    every ``pages``-th page until one is short.  Pages only fit together in a
    fixed order, so the query has to end in an ORDER BY over a key.
    """

    class Reader(DataSourceReader):
        def __init__(self, options: dict, schema):
            self.o, self.names = options, schema.fieldNames()

        def partitions(self) -> list[InputPartition]:
            if not re.search(r"\border\s+by\b", self.o["query"], re.I):
                raise ValueError("a paged query needs an ORDER BY")
            return [_Page(i) for i in range(int(self.o.get("pages", 1)))]

        def read(self, part: _Page) -> Iterator[tuple]:
            size, n = int(self.o.get("page", 10_000)), part.offset
            while True:
                got = fetch(self.o.get("endpoint", ""), f"{self.o['query']} LIMIT {size} OFFSET {n * size}")["results"]["bindings"]
                for b in got:
                    yield tuple(b.get(v, {}).get("value") for v in self.names)
                if len(got) < size:
                    return
                n += int(self.o.get("pages", 1))

    class Sparql(DataSource):
        @classmethod
        def name(cls) -> str:
            return "sparql"

        def reader(self, schema) -> DataSourceReader:
            return Reader(self.options, schema)

    return Sparql


def _rows(got: dict, names: list[str]) -> list[tuple]:
    return [tuple(b.get(v, {}).get("value") for v in names) for b in got["results"]["bindings"]]


def by_ids(idents: DataFrame, statement: str, schema: str, fetch: Fetch = http_fetch, endpoint: str = "", batch: int = 100) -> DataFrame:
    """Bindings for the ids of a one-column frame, fetched in the tasks.

    ``{values}`` in the statement is replaced by at most ``batch`` ids at a time.
    """
    names = [c.split()[0] for c in schema.split(",")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            wanted = [i for i in df.iloc[:, 0] if i]
            for a in range(0, len(wanted), batch):
                got = fetch(endpoint, statement.replace("{values}", " ".join(f"wd:{i}" for i in wanted[a : a + batch])))
                yield pd.DataFrame(_rows(got, names), columns=names)

    return idents.mapInPandas(run, schema)


def by_key(keys: DataFrame, statement: str, schema: str, cache: str, fetch: Fetch = http_fetch, endpoint: str = "") -> DataFrame:
    """Bindings for every key (a country, a type), one query each, kept under ``cache``.

    ``{key}`` in the statement is replaced.  Keys that the cache holds are not
    fetched again, so a broken run goes on where it stopped; a key without
    results is kept as one row of nulls and left out here.
    """
    spark = keys.sparkSession
    names = [c.split()[0] for c in schema.split(",")]
    full = f"key string, found boolean, {schema}"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(cache)
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    known = spark.read.schema(full).parquet(cache) if there else spark.createDataFrame([], full)
    todo = keys.toDF("key").distinct().join(known.select("key").distinct(), "key", "left_anti")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in frames:
            for key in df["key"]:
                got = [(key, True, *r) for r in _rows(fetch(endpoint, statement.replace("{key}", key)), names)] or [(key, False, *[None] * len(names))]
                yield pd.DataFrame(got, columns=["key", "found", *names])

    todo.mapInPandas(run, full).write.mode("append").parquet(cache)
    return spark.read.schema(full).parquet(cache).where("found").drop("found")


def register(spark: SparkSession, fetch: Fetch = http_fetch) -> None:
    spark.dataSource.register(source(fetch))
