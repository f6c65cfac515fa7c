"""Shared pieces: the word pattern, written tables that cut lineage, Arrow slices, hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"

SMALL = 1_000_000  # ids of 8 bytes

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: later jobs start from the files,
    which outlive a lost executor, and don't compute it again. What was shuffled for it goes as
    soon as it is written, not when the driver happens to collect its garbage."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path, compression=codec)
    finally:
        spark.conf.set(CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.scratch = path
    return table


def drop(*tables: DataFrame) -> None:
    """Delete tables as ``cut`` returned them, of which nothing is read any more."""
    for gone in tables:
        spark = gone.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(gone.scratch)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small(ids: DataFrame, most: int = SMALL) -> DataFrame:
    """A written table of single ids, to be broadcast if it is small when counted; if not, the
    planner joins by a shuffle."""
    ids = cut(ids, "ids")
    if ids.count() > most:
        return ids
    sent = F.broadcast(ids)
    sent.scratch = ids.scratch
    return sent


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that a text column holds about ``most`` bytes in each; one longer
    text stays whole."""
    for batch in batches:
        sizes = np.cumsum(_lengths(batch.column(column)))
        at = 0
        while at < batch.num_rows:
            base = sizes[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, base + most, "right")))
            # A copy: some Arrow functions go wrong on slices of strings.
            yield batch.take(pa.array(np.arange(at, to)))
            at = to


def _lengths(texts: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, one after the other (a null adds none), and where each starts."""
    lengths = _lengths(texts)
    data = b"".join(x for x in texts.cast(pa.large_binary()).to_pylist() if x)
    return np.frombuffer(data, np.uint8), np.concatenate([[0], np.cumsum(lengths)])


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = (x ^ (x >> _S30)) * _MIX1
    x = (x ^ (x >> _S27)) * _MIX2
    return x ^ (x >> _S31)


def random_words(n: int, seed: int) -> np.ndarray:
    start = seed * 0x9E3779B97F4A7C15 % 2**64
    return mixed(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(start))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)
