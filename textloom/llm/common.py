"""What the operators of this subpackage share: text access, Arrow batches as byte arrays, word hashes, tables in the shared folder."""

from __future__ import annotations

import ctypes
import os
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = str(Path(__file__).resolve().parents[2])


def ready(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, if their path does not hold it yet."""
    env = spark.sparkContext.environment
    if ROOT not in os.environ.get("PYTHONPATH", "").split(":") and ROOT not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(filter(None, [ROOT, env.get("PYTHONPATH", "")]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text of every row; a null text counts as empty. Other columns, whatever their names, are left out."""
    return docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def fold(n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % n


def shared_folder(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir, which the driver and all executors see. Where the setting is missing, one machine uses a folder of the warehouse, a cluster raises an error."""
    base = spark.conf.get("spark.checkpoint.dir", "")
    if not base:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors see")
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    return f"{base.rstrip('/')}/textloom-{uuid.uuid4().hex}"


#: With this setting Spark deletes a query's shuffle files when the query is done.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def _settings(spark: SparkSession, batch: int | None = None) -> Iterator[None]:
    """Shuffle files of what runs in it go when it is done, and Arrow batches have so many rows at most; the session's own settings are put back."""
    values = {_CLEANUP: "true"}
    if batch and not 0 < int(spark.conf.get(_BATCH)) < batch:
        values[_BATCH] = str(batch)
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def written(df: DataFrame, path: str, options: dict[str, str] | None = None, batch: int | None = None) -> DataFrame:
    """df as a Parquet table at path, read again: a cut of the lineage that survives lost executors. Nothing needs the shuffles behind the table any more, so their files go at once. batch: the rows of an Arrow batch, where rows are large."""
    with _settings(df.sparkSession, batch):
        df.write.options(**(options or {})).mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, path: str, key: str, n: int, options: dict[str, str] | None = None) -> DataFrame:
    """As written(), dealt by the key into n buckets, so that joins by the key don't shuffle the table again. Its name is in the session's catalog only until the table is found."""
    spark, name = df.sparkSession, f"textloom_{uuid.uuid4().hex}"
    with _settings(spark):
        df.repartition(n, key).write.options(**(options or {})).option("path", path).format("parquet").bucketBy(n, key).saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay, as the path is our own
    return out


def removed(spark: SparkSession, path: str) -> None:
    """Delete a table that written() made and nothing reads any more, wherever its file system is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


_given_back = 0.0


def give_back(pause: float = 1.0) -> None:
    """Give free memory of this Python worker back to the system, at most once in so many seconds: an idle worker else keeps the most that it ever held."""
    global _given_back
    if time.monotonic() - _given_back < pause:
        return
    _given_back = time.monotonic()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (AttributeError, OSError):  # another C library; it frees as it likes
        pass


def tidy(run: Callable) -> Callable:
    """run, a function of Arrow batches, giving memory back when the last batch is done."""

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back(0)

    return inner


def slices(batches: Iterator[pa.RecordBatch], column: str | None = "text", limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the column's (with None the last one's) texts have about limit bytes; one longer text stays whole."""
    for b in batches:
        if not b.num_rows:
            continue
        _, off = utf8(b.column(b.num_columns - 1 if column is None else column))
        at = 0
        while at < b.num_rows:
            to = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
            yield b.slice(at, to - at)
            at = to


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of an Arrow column without nulls, one after the other, and where each begins (one more entry than texts)."""
    a = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if not len(a):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1]
    data = np.frombuffer(a.buffers()[2], np.uint8) if a.buffers()[2] else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_RANDOM = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of SplitMix64 on unsigned 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(kind: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        step = np.full(max(n, 1 << 20), base, np.uint64)
        step[0] = 1
        have = np.multiply.accumulate(step)
        if n <= 1 << 24:
            _powers[kind] = have
    return have[:n]


def lower(buf: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, all other bytes as they are."""
    return _LOWER[buf]


def word_spans(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words ``[^\\x20\\x09-\\x0D]+`` of texts laid end to end begin and end, and the index of each text's first word (one more entry than texts)."""
    n = len(buf)
    solid = ~_SPACE[buf]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    before = np.empty(n, bool)
    before[:1] = False
    before[1:] = solid[:-1]
    after = np.empty(n, bool)
    after[-1:] = False
    after[:-1] = solid[1:]
    starts = np.flatnonzero(solid & (~before | edge[:-1]))
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, off)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; it depends on the bytes and their number only."""
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_RANDOM[buf] * _power("up", _BASE, len(buf)), out=total[1:])
    return mix((total[ends] - total[starts]) * _power("down", _INVERSE, len(buf) + 1)[starts] ^ (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """How many entries two sorted sets share."""
    if len(a) < len(b):
        a, b = b, a
    return int(np.count_nonzero(a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b)) if len(b) else 0


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices starts[i], starts[i] + 1, ... of lens[i] entries each, one after the other."""
    to = np.cumsum(lens)
    out = np.ones(int(to[-1]) if len(to) else 0, np.int64)
    if not len(out):
        return out
    keep = lens > 0
    s, ln, first = starts[keep], lens[keep], (to - lens)[keep]
    out[first[0]] = s[0]
    out[first[1:]] = s[1:] - (s[:-1] + ln[:-1] - 1)
    return np.cumsum(out)
