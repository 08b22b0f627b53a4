"""What the text operators share: tables, the shared work folder, byte-level word scanning and hashing."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Hashable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

# --- tables and intermediate results ---------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in spark.checkpoint.dir; a temporary one only in a local session."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None) or _local_dir.get(spark.sparkContext.applicationId)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = _local_dir[spark.sparkContext.applicationId] = "file://" + tempfile.mkdtemp(prefix="sluice-")
    return named.rstrip("/")


_local_dir: dict[str, str] = {}


def stored(df: DataFrame) -> DataFrame:
    """Cut lineage: write df as Parquet in the shared folder and read it back."""
    path = f"{work_dir(df.sparkSession)}/sluice-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete stored results that nothing will read again, and let shuffle files go."""
    delete(*frames)
    release(frames[0].sparkSession)


def delete(*frames: DataFrame) -> None:
    """Delete stored results that nothing will read again."""
    for df in frames:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


class Scratch:
    """Stored results of one run, deleted when it ends."""

    def __init__(self, spark: SparkSession):
        self.spark, self.frames = spark, []

    def __enter__(self) -> Scratch:
        return self

    def stored(self, df: DataFrame) -> DataFrame:
        out = stored(df)
        self.frames.append(out)
        release(self.spark)
        return out

    def discard(self, *frames: DataFrame) -> None:
        self.frames = [f for f in self.frames if all(f is not g for g in frames)]
        discard(*frames)

    def __exit__(self, *_) -> None:
        if self.frames:
            discard(*self.frames)
            self.frames = []


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


# --- what workers remember -------------------------------------------------------------------


class Remembered:
    """Results by key, `most` of them at the most: when the newer half is full the older one goes, and what is asked of it again moves up."""

    def __init__(self, most: int):
        self.half = max(1, most // 2)
        self.newer: dict = {}
        self.older: dict = {}

    def get(self, key):
        if (got := self.newer.get(key)) is None and (got := self.older.get(key)) is not None:
            self.put(key, got)
        return got

    def put(self, key, value) -> None:
        if len(self.newer) >= self.half:
            self.newer, self.older = {}, self.newer
        self.newer[key] = value

    def __len__(self) -> int:
        return len(self.newer) + len(self.older)


_kept: dict[Hashable, object] = {}


def kept[T](key: Hashable, make: Callable[[], T]) -> T:
    """What a worker keeps between the tasks of one operator. What it kept of another goes, so that their tables never add up."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


# --- hashing ---------------------------------------------------------------------------------

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


#: A random-looking 64-bit value for every byte.
BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
#: The same with A-Z valued as a-z.
LOWER_VALUE = BYTE_VALUE.copy()
LOWER_VALUE[65:91] = BYTE_VALUE[97:123]

_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE**i and its inverse for i up to n."""
    if len(_powers.get("up", ())) < n + 1:
        size = max(1 << 20, n + 1)
        for key, step in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, step, dtype=np.uint64)
            steps[0] = 1
            _powers[key] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


class Prefix:
    """Polynomial hashes of any substring of one buffer, from its prefix sums."""

    def __init__(self, buf: np.ndarray, value: np.ndarray = BYTE_VALUE):
        up, self.down = powers(len(buf))
        self.sums = np.zeros(len(buf) + 1, dtype=np.uint64)
        np.cumsum(value[buf] * up[: len(buf)], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64) * _BASE)

    def runs(self, width: int) -> np.ndarray:
        """The hashes of all runs of `width` bytes."""
        out = self.sums[width:] - self.sums[: len(self.sums) - width]
        out *= self.down[: len(out)]
        out += np.uint64(width) * _BASE
        return mix(out)


# --- texts as bytes --------------------------------------------------------------------------

CHUNK = 1 << 20  # bytes of text handled at once; a longer text is handled alone


def chunks(column: pa.Array, most: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices (first row, last row, bytes, offsets) of a string column of about `most` bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, pa.scalar("", column.type)) if column.null_count else column
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n, at = len(column), column.offset
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[at : at + n + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        yield row, last, data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row]
        row = last


IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def words(buf: np.ndarray, offsets: np.ndarray, is_break: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` of all texts, and each text's first word (and one past).

    Another table of breaking bytes gives other words.
    """
    if not len(buf):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~is_break[buf]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    first, last = offsets[:-1][offsets[:-1] < offsets[1:]], offsets[1:][offsets[:-1] < offsets[1:]] - 1
    begins[first] = inside[first]
    ends[last] = inside[last]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k consecutive word hashes (across texts too; the caller picks those inside one)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * _BASE + hashes[i : i + n]
    return mix(out + _U(k))


def inside(firsts: np.ndarray, k: int, total: int) -> np.ndarray:
    """Which of the runs of k consecutive words lie in one text."""
    ok = np.zeros(max(0, total - k + 1), dtype=bool)
    if not len(ok):
        return ok
    counts = np.diff(firsts)
    limit = np.repeat(firsts[1:], counts)[: len(ok)]
    return np.arange(len(ok)) + k <= limit
