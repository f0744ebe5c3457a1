"""What the text operators share: arrow mapping, shared storage and vectorised hashing of byte ranges."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: glibc, where this is it.
_LIBC = ctypes.CDLL(None) if hasattr(ctypes.CDLL(None), "malloc_trim") else None

#: The words of the contracts: runs without space and the controls 09-0D. bytes.split() splits at exactly these.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir or the context's checkpoint folder. One of our own only in local mode, where there are no other machines: on a cluster a setting is asked for."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))
        at = spark.sparkContext.getCheckpointDir()
    return at.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet in the shared folder and read again: lineage ends there, and a lost executor costs nothing but its own tasks."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/waymark-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Deletes tables that stored() has made and nothing will read any more. Hadoop's file system does it, as Spark has no call for that."""
    for t in tables:
        spark = t.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(t.stored_at)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def let_go(spark: SparkSession) -> None:
    """Shuffle files of finished steps go as soon as nothing refers to them, rather than when the driver's heap happens to fill. Spark's queues of events refer to the last query until its end is seen and another event has come, so a query of one row follows it and the queues are waited for."""
    gc.collect()
    spark.range(0, 1, 1, 1).collect()
    with contextlib.suppress(Py4JJavaError):  # listeners that lag for longer than that
        spark._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    spark._jvm.System.gc()


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Batches that go to Python hold fewer rows than Spark's default, since rows are whole texts. A setting of the session; a smaller one of the user's stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, rows)


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just id and text, under fixed names, so that other columns can't clash."""
    small_batches(df.sparkSession)
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def map_text(df: DataFrame, make: Callable[[], Callable[[list], dict]], schema: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns made from the column text, beside the columns to keep. make() runs once a task and returns a function from a list of texts to lists of values by column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = None
        for batch in batches:
            if made is None:
                made = make()
            col = batch.column(batch.schema.get_field_index("text"))
            for lo, n in slices(col):
                out = made(col.slice(lo, n).to_pylist())
                kept = [batch.column(batch.schema.get_field_index(k)).slice(lo, n) for k in keep]
                arrays = kept + [pa.array(v, type=types[k]) if not isinstance(v, pa.Array) else v for k, v in out.items()]
                yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *out])

    from pyspark.sql.pandas.types import to_arrow_type

    kinds = df.select(*keep).schema
    from pyspark.sql.types import StructType

    made_schema = StructType.fromDDL(schema)
    types = {f.name: to_arrow_type(f.dataType) for f in made_schema}
    return df.select(*keep, "text").mapInArrow(run, StructType([*kinds.fields, *made_schema.fields]))


def slices(col: pa.Array, rows: int = 512, size: int = 500_000) -> Iterator[tuple[int, int]]:
    """Offsets and lengths of stretches of at most so many rows and, but for a single longer text, bytes."""
    lengths = np.nan_to_num(np.asarray(pc.binary_length(col).to_numpy(zero_copy_only=False), float)).astype(np.int64)
    lo, n, total = 0, 0, 0
    for k in lengths.tolist():
        if n and (n >= rows or total + k > size):
            yield lo, n
            lo, n, total = lo + n, 0, 0
        n, total = n + 1, total + k
    if n:
        yield lo, n
    trim()


def trim() -> None:
    """Freed memory back to the system after a batch, so that what one step used is not held when the next runs in the same worker."""
    pa.default_memory_pool().release_unused()
    if _LIBC is not None:
        _LIBC.malloc_trim(0)


# --- names of ranges: functions of content alone, so tasks agree on them without a dictionary --------------------------

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads every bit (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _S30)) * _M1
        x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


def powers(base: int, n: int, modulus: int = 0) -> np.ndarray:
    """The first n powers of base, modulo 2^64 or a modulus below 2^32. What was asked for before is kept, up to a million of each."""
    key = (base, modulus)
    have = _POWERS.get(key, np.ones(1, np.uint64))
    while len(have) < n:
        with np.errstate(over="ignore"):
            step = np.uint64(pow(base, len(have), modulus or 1 << 64))
            more = have * step
        have = np.concatenate([have, more % np.uint64(modulus) if modulus else more])
    if len(have) <= 1 << 20:
        _POWERS[key] = have
    return have[:n]


_POWERS: dict[tuple[int, int], np.ndarray] = {}


class Names:
    """64-bit names of the ranges of an array of items that are names themselves: a polynomial modulo 2^64 with an odd base, mixed. For short ranges and for choices that needn't be injective: long patterned ranges of two items can be made to collide, so whatever decides equality of long ranges uses PrimeNames or names of recompression."""

    def __init__(self, items: np.ndarray, base: int = 0x9E3779B97F4A7C15) -> None:
        n, base = len(items), base | 1
        with np.errstate(over="ignore"):
            self.inverse = powers(pow(base, -1, 1 << 64), n + 1)
            self.sums = np.zeros(n + 1, np.uint64)
            np.cumsum(items * powers(base, n + 1)[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[stop] - self.sums[start]) * self.inverse[start] + (stop - start).astype(np.uint64) * _M2)


    def of_length(self, q: int) -> np.ndarray:
        """The names of all ranges of q items, by start."""
        n = max(0, len(self.sums) - q)
        with np.errstate(over="ignore"):
            return mix((self.sums[q:] - self.sums[:n]) * self.inverse[:n] + np.uint64(q) * _M2)


#: Four primes below 2^31, each with a base.
FIELDS = ((2147483647, 1203798337), (2147483629, 708425113), (2147483587, 1918726363), (2147483579, 331998527))


class PrimeNames:
    """Two names of 62 bits of the ranges of a byte array: polynomials over four prime fields, in which patterned strings don't cancel out."""

    def __init__(self, buf: np.ndarray) -> None:
        n = len(buf)
        items = buf.astype(np.uint64) + np.uint64(1)
        self.fields = []
        for p, base in FIELDS:
            sums = np.empty(n + 1, np.uint64)
            sums[0] = 0
            power, modulus = powers(base, n + 1, p), np.uint64(p)
            for lo in range(0, n, 1 << 24):  # sums of so many products stay below 2^64
                hi = min(n, lo + (1 << 24))
                np.cumsum(items[lo:hi] * power[lo:hi], out=sums[lo + 1 : hi + 1])
                sums[lo + 1 : hi + 1] += sums[lo] % modulus
            self.fields.append((modulus, sums, powers(pow(base, -1, p), n + 1, p)))

    def of(self, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        part = [(sums[stop] % p + p - sums[start] % p) % p * inverse[start] % p for p, sums, inverse in self.fields]
        return mix(part[0] << np.uint64(31) | part[1]), mix(part[2] << np.uint64(31) | part[3])


def pair(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """A name for the pair of two names, in this order."""
    with np.errstate(over="ignore"):
        return mix(mix(x) * _M2 + y)


#: Values of single bytes for Names.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64))
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


class Words:
    """The words of a list of texts (None: none) as byte ranges of one buffer: start, stop and doc of each word; first[d] is the number of the first word of text d."""

    def __init__(self, batch: list, table: bytes | None = None) -> None:
        raw = [t.encode() if t else b"" for t in batch]
        data = b" ".join(raw) + b" "
        if table is not None:
            data = data.translate(table)
        self.data = data
        self.buf = np.frombuffer(data, np.uint8)
        space = SPACE[self.buf]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if not space[0]:
            edge = np.concatenate([[0], edge])
        self.start, self.stop = edge[0::2], edge[1::2]
        self.at = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])]).astype(np.int64)
        self.first = np.searchsorted(self.start, self.at)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(raw)), self.count)

    def names(self) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit names of each word, the halves of its 128-bit xxh3: each distinct word of the batch is hashed once."""
        offsets = np.zeros(len(self.start) + 1, np.int64)
        np.cumsum(self.stop - self.start, out=offsets[1:])
        solid = self.buf[~SPACE[self.buf]]
        coded = pa.Array.from_buffers(pa.large_binary(), len(self.start), [None, pa.py_buffer(offsets), pa.py_buffer(solid)]).dictionary_encode()
        digest = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, coded.dictionary.to_pylist())), np.uint64).reshape(-1, 2)
        code = coded.indices.to_numpy()
        return digest[code, 0], digest[code, 1]
