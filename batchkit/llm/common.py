"""Small helpers shared by the operators: tables, scratch tables, word hashes, fixed-size sketches."""

from __future__ import annotations

import ctypes
import gc
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from batchkit.session import shared_dir

#: ASCII white space; a word is a run of other characters.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: A-Z to a-z, all other bytes as they are.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Counters per row when a sketch travels through a shuffle.
CHUNK = 1 << 14
_U = np.uint64


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of the folder, by Spark's own reader."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark, name)}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column | str) -> Column:
    """True where crc32 of the id as text leaves 1 when divided by 3 (a null id: false)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(F.encode(c.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words with good avalanche (the splitmix finaliser)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def slices(batches, rows: int = 512):
    """Arrow batches cut into small ones, so that only few rows are Python objects at a time."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def tidy(*broadcasts) -> None:
    """Gives a worker's free memory back, as idle workers stay alive; also what it has unpacked of ``broadcasts``."""
    for x in broadcasts:
        vars(x).pop("_value", None)  # read again by the next task that uses it
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


#: Bytes hashed at a time.
PIECE = 1 << 20
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: A random word for each byte.
BYTE_WORDS = mix(np.arange(1, 257, dtype=_U) * _U(0xD1342543DE82EF95))
_BASE = 0x9E3779B97F4A7C15


def tidied(run):
    """A kernel over Arrow batches after which the worker's free memory goes back."""
    def wrapped(batches):
        yield from run(batches)
        tidy()

    return wrapped


#: Rows in an Arrow batch at most: texts are long, and a batch is held several times over.
TEXT_ROWS = 1000


def mapped(df: DataFrame, run, schema) -> DataFrame:
    """``df`` through a kernel over Arrow batches; the session's batch size is lowered to TEXT_ROWS if it is larger."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(key)) <= TEXT_ROWS:
        conf.set(key, str(TEXT_ROWS))
    return df.mapInArrow(tidied(run), schema)


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, as far as the longest piece so far needs."""

    def __init__(self):
        self.up = self.down = np.ones(1, _U)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 1 << 16)
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                x = np.full(n, base, _U)
                x[0] = 1
                setattr(self, name, np.cumprod(x))
        return self.up, self.down

    def sums(self, data: np.ndarray) -> np.ndarray:
        """Sums before each byte, so that (sums[b] - sums[a]) * down[a] is a rolling hash of bytes a to b."""
        up, _ = self(len(data) + 1)
        out = np.zeros(len(data) + 1, _U)
        np.cumsum(BYTE_WORDS[data] * up[:len(data)], out=out[1:])
        return out


class WordHashes:
    """64-bit hashes of the words of texts, A-Z lower-cased unless ``lower`` is false; vectorised over many texts."""

    def __init__(self, lower: bool = True):
        self.lower, self.powers = lower, Powers()

    def _of(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, start, length) of each word of a piece."""
        data = np.frombuffer(raw.translate(LOWER) if self.lower else raw, np.uint8)
        edge = np.diff(np.concatenate([[False], ~_IS_SPACE[data], [False]]).view(np.int8))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sums = self.powers.sums(data)
        return mix((sums[ends] - sums[starts]) * self.powers.down[starts] + (ends - starts).astype(_U)), starts, ends - starts

    def _long(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(hash, length) of each word of one text, in pieces that end at white space."""
        parts, at = [], 0
        while at < len(raw):
            end = min(len(raw), at + PIECE)
            while end < len(raw) and not _IS_SPACE[raw[end]]:
                end += 1
            parts.append(self._of(raw[at:end])[::2])
            at = end
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, _U), np.zeros(0, np.int64))

    def many(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(hashes, lengths in bytes) of the words of each text."""
        out, group, size = [], [], 0

        def flush():
            if group:
                h, starts, lengths = self._of(b"\n".join(group))
                cuts = np.searchsorted(starts, np.cumsum([len(g) + 1 for g in group])[:-1])
                out.extend(zip(np.split(h, cuts), np.split(lengths, cuts), strict=True))
                group.clear()

        for t in texts:
            raw = (t or "").encode("utf-8", "surrogatepass")
            if len(raw) > PIECE // 2:
                flush()
                size = 0
                out.append(self._long(raw))
                continue
            if size + len(raw) > PIECE:
                flush()
                size = 0
            group.append(raw)
            size += len(raw) + 1
        flush()
        return out

    def __call__(self, text: str | None) -> np.ndarray:
        return self.many([text])[0][0]


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Distinct hashes of the runs of k words; of fewer words, one for the whole sequence."""
    n = len(h)
    if n == 0:
        return np.zeros(0, np.uint64)
    width = min(k, n)
    out = np.zeros(n - width + 1, np.uint64)
    for j in range(width):
        out = (out ^ h[j:n - width + 1 + j]) * _U(0x9E3779B97F4A7C15)
        out = out ^ (out >> _U(29))
    return np.unique(mix(out + _U(width)))


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


# --- fixed-size sketches: an array of 2**bits counters, summed over all tasks

def sketch_rows(counts: np.ndarray) -> pa.RecordBatch:
    """The chunks of a task's counters that aren't all zero, compressed, as (chunk, counts)."""
    chunks = counts.reshape(-1, CHUNK)
    used = np.flatnonzero(chunks.any(axis=1))
    return pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32)), pa.array([zlib.compress(chunks[i].astype(np.uint32).tobytes(), 1) for i in used], pa.binary())],
        names=["chunk", "counts"])


SKETCH = "chunk int, counts binary"


def _sum_chunk(batches):
    total, chunk = np.zeros(CHUNK, np.uint64), None
    for b in batches:
        for c, blob in zip(b.column("chunk").to_pylist(), b.column("counts").to_pylist(), strict=True):
            chunk = c
            total += np.frombuffer(zlib.decompress(blob), np.uint32)
    # a counter travels to the driver as its rounded logarithm: one byte
    level = np.minimum(255, np.round(4 * np.log2(total.astype(np.float64) + 1))).astype(np.uint8)
    yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([level.tobytes()], pa.binary())], names=["chunk", "level"])


def sketch_levels(rows: DataFrame, bits: int) -> np.ndarray:
    """round(4 log2(count + 1)) of each of the 2**bits counters, as bytes: at most 2**bits bytes reach the driver."""
    got = rows.groupBy("chunk").applyInArrow(_sum_chunk_group, "chunk int, level binary").collect()
    out = np.zeros(1 << bits, np.uint8)
    for r in got:
        out[r["chunk"] * CHUNK:(r["chunk"] + 1) * CHUNK] = np.frombuffer(r["level"], np.uint8)
    return out


def _sum_chunk_group(table: pa.Table) -> pa.Table:
    return pa.Table.from_batches(_sum_chunk(table.to_batches()))


#: Slots of an id filter for each id, and how many there are at least and at most.
SLOTS_PER_ID, LEAST_SLOTS, MOST_SLOTS = 16, 1 << 16, 1 << 27


class IdFilter:
    """Which rows may have one of some ids: a bit for each slot of their hashes, as many slots as the ids ask for.

    One row in SLOTS_PER_ID that has none of the ids passes (an exact join follows).  The
    bits are broadcast in words of 64: fewer than the ids, and at most MOST_SLOTS / 64 rows,
    some 50 MB; beyond 8 million ids the share that passes grows, never the broadcast.
    """

    def __init__(self, hashes: DataFrame):
        """``hashes``: one column of longs, hashes of the ids; counted, so best a written table's."""
        h = hashes.columns[0]
        n = hashes.agg(F.count("*")).first()[0]
        self.slots = max(LEAST_SLOTS, min(MOST_SLOTS, 1 << (SLOTS_PER_ID * n).bit_length()))
        slot = F.pmod(F.col(h), F.lit(self.slots))
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int"))
        self.words = F.broadcast(hashes.groupBy(F.shiftright(slot, 6).alias("_word")).agg(F.bit_or(bit).alias("_bits")))

    def _join(self, df: DataFrame, h: Column, how: str) -> DataFrame:
        held = df.withColumn("_slot", F.pmod(h, F.lit(self.slots)))
        hit = F.call_function("shiftrightunsigned", F.col("_bits"), (F.col("_slot") % 64).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1
        return held.join(self.words, (F.shiftright("_slot", 6) == F.col("_word")) & hit, how).drop("_slot")

    def maybe(self, df: DataFrame, h: Column) -> DataFrame:
        """Rows of ``df`` whose hash ``h`` has its bit."""
        return self._join(df, h, "left_semi")

    def without(self, df: DataFrame, h: Column) -> DataFrame:
        """All other rows of ``df``, those with a null hash among them."""
        return self._join(df, h, "left_anti")


def bounded_sample(df: DataFrame, rows: int, seed: int, *by: str) -> DataFrame:
    """About ``rows`` rows, chosen by a hash of the columns ``by``: the same at every run.

    A count first gives the share; a row stays where its hash falls under it.
    """
    n = df.count()
    if n <= rows:
        return df
    share = int(rows / n * (1 << 53))
    return df.where(F.shiftrightunsigned(F.xxhash64(F.lit(seed), *by), 11) < F.lit(share))


def component_min(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of the undirected ``edges`` (a, b): root is the smallest node of its component.

    Alternating large-star and small-star steps; each is one grouped minimum and
    one join, and their number grows with the logarithm of the longest path.
    Nulls and loops are left out; an empty input gives an empty result.
    """
    e = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    before = None
    while True:
        # large star: larger neighbours link to the smallest of the neighbourhood
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        e = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: a node and its smaller neighbours link to the smallest of them
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        e = e.join(low, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("x")) \
             .select(F.col("x.v").alias("u"), F.col("x.m").alias("v")).where("u <> v").distinct()
        e = written(e, name)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")) \
                    .union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now
