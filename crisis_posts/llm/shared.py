"""What several operators need: shared scratch tables, batches of rows, word hashes, small caches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


_ROWS_AT_ONCE = 256
_BATCH_ROWS = 4096
_BATCH_BYTES = 1 << 20


def scratch_path(spark: SparkSession) -> str:
    """A new path below spark.checkpoint.dir, or below the warehouse where that is unset."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    root = shared or spark.conf.get("spark.sql.warehouse.dir") + "/scratch"
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def written(table: DataFrame) -> DataFrame:
    """The table, written once to the shared folder and read again, so that its lineage ends there.

    The files go when the session ends.
    """
    spark = table.sparkSession
    path = scratch_path(spark)
    table.write.parquet(path)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(table.schema).parquet(path)


def map_rows(
    table: DataFrame, schema: str, rows: Callable[[Iterator[tuple]], Iterable[tuple]]
) -> DataFrame:
    """Pass each partition's rows, as tuples, through a generator of tuples; strings come as bytes.

    Rows leave in batches of bounded number and size, whatever the generator makes of each. A worker
    serves many tasks, so what Arrow keeps for a next batch goes back when a partition ends.
    """
    columns = StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(columns)

        def incoming():
            for batch in batches:
                for at in range(0, batch.num_rows, _ROWS_AT_ONCE):
                    columns = [
                        column.cast(pa.binary() if pa.types.is_string(column.type) else column.type)
                        for column in batch.slice(at, _ROWS_AT_ONCE).columns
                    ]
                    yield from zip(*(column.to_pylist() for column in columns), strict=True)

        held, weight = [], 0
        for row in rows(incoming()):
            held.append(row)
            weight += sum(
                x.nbytes if isinstance(x, np.ndarray) else len(x)
                for x in row if isinstance(x, (str, bytes, list, np.ndarray))
            )
            if len(held) >= _BATCH_ROWS or weight >= _BATCH_BYTES:
                yield _batch(held, arrow)
                held, weight = [], 0
        if held:
            yield _batch(held, arrow)
            held = []
        pa.default_memory_pool().release_unused()

    return table.mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, field.type) for c, field in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


class Memo(dict):
    """A dictionary that computes missing entries, and starts anew when it has grown full."""

    def __init__(self, compute: Callable, limit: int = 1_000_000):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, key):
        value = self.compute(key)
        if len(self) >= self.limit:
            self.clear()
        self[key] = value
        return value


# Hashes of words and of runs of words, over the bytes of a text

SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


@cache
def _byte_codes() -> np.ndarray:
    return np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]), 1 << 16)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads each bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word, words being what ASCII white space separates."""
    data = np.frombuffer(text, np.uint8)
    if not len(data):
        return np.empty(0, np.uint64)
    space = SPACES[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    edge = np.concatenate([[0] * (not space[0]), edge, [len(data)] * (not space[-1])])
    starts, ends = edge[0::2].astype(np.int64), edge[1::2].astype(np.int64)
    power, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_byte_codes()[data] * power[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverse[starts])


def run_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each run of k words."""
    if len(words) < k:
        return np.empty(0, np.uint64)
    n = len(words) - k + 1
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total += words[j : j + n] * np.uint64(pow(_BASE, 2 * j + 1, 1 << 64))
    return mixed(total)


def bpe_merge(symbols: list[str], rank: Callable[[str, str], int | None]) -> list[str]:
    """Merge the pair of lowest rank, the leftmost of equals, until no pair has a rank."""
    symbols = list(symbols)
    while len(symbols) > 1:
        ranked = [
            (r, i) for i in range(len(symbols) - 1)
            if (r := rank(symbols[i], symbols[i + 1])) is not None
        ]
        if not ranked:
            break
        at = min(ranked)[1]
        symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
    return symbols
