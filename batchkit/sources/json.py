"""JSON sources, SQL directly on files, and DDL views over files."""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from batchkit._util import sql_ident, sql_string
from batchkit.operators.partitions import map_partitions
from batchkit.session import shared_dir


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None,
              multi_line: bool = False, sampling_ratio: float | None = None) -> DataFrame:
    """JSON lines -> DataFrame; with ``multi_line`` each file is one array or object, read by one task (:func:`read_json_array` splits it).

    Without ``schema`` the schema is inferred by an extra pass over the input
    (columns in alphabetical order, integers as bigint).  The pass reads all
    rows unless ``sampling_ratio`` is given – a sample is faster but can miss
    fields that only rare rows carry.  Pass ``schema`` on large inputs.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    elif sampling_ratio is not None:
        reader = reader.option("samplingRatio", sampling_ratio)
    return reader.option("multiLine", multi_line).json(path)


def sql_on_file(spark: SparkSession, fmt: str, path: str, where: str | None = None) -> DataFrame:
    """``SELECT * FROM fmt.`path```: query a file or folder without registering it."""
    if fmt not in ("json", "parquet", "csv", "text", "orc"):
        raise ValueError(f"unsupported format {fmt!r}")
    q = f"SELECT * FROM {fmt}.{sql_ident(path)}"
    if where:
        q += f" WHERE {where}"
    return spark.sql(q)


def create_file_view(spark: SparkSession, name: str, fmt: str, path: str) -> DataFrame:
    """``CREATE OR REPLACE TEMPORARY VIEW name USING fmt OPTIONS (path ...)``."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {sql_ident(name)} USING {fmt} OPTIONS (path {sql_string(path)})")
    return spark.table(sql_ident(name))


# ------------------------------------------------------------------ arrays of any size
_QUOTE, _BACKSLASH, _OPEN, _CLOSE = b'"\\{}'


def _marks(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each byte: whether an odd number of string quotes lie before it, and +1 / -1 where it is a brace; and the brace bytes.

    A quote after an odd run of backslashes is none.  ``raw`` begins after a brace, so no escape reaches into it.
    """
    data = np.frombuffer(raw, np.uint8)
    quote = data == _QUOTE
    back = data == _BACKSLASH
    if back.any():
        at = np.arange(len(data))
        last_other = np.maximum.accumulate(np.where(back, -1, at))
        run = np.zeros(len(data), np.int64)
        run[1:] = (at - last_other)[:-1]
        quote &= run % 2 == 0
    odd = (np.cumsum(quote) - quote) % 2 == 1
    step = (data == _OPEN).astype(np.int8) - (data == _CLOSE).astype(np.int8)
    return odd, step, quote


def _fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch, bytes]]:
    """The byte ranges' rows in order, as (range, rows, bytes with the braces that part them)."""
    for b in batches:
        files, starts = b.column("file").to_pylist(), b.column("start").to_pylist()
        cuts = [0, *(i for i in range(1, b.num_rows) if starts[i] != starts[i - 1] or files[i] != files[i - 1]), b.num_rows]
        for a, z in zip(cuts, cuts[1:]):
            if z > a:
                rows = b.slice(a, z - a)
                yield (files[a], starts[a]), rows, b"".join(x + b"}" for x in rows.column("value").cast(pa.binary()).to_pylist())


def _summaries(batches):
    """Per byte range and for either state of its beginning (outside, inside a string): the change of depth, its minimum; and the parity of its quotes."""
    held: dict[tuple[str, int], list] = {}
    for key, _, raw in _fragments(batches):
        s = held.setdefault(key, [0, [0, 0], [0, 0]])
        odd, step, quote = _marks(raw)
        for begin in (0, 1):
            inside = odd if (s[0] + begin) % 2 == 0 else ~odd
            depth = s[1][begin] + np.cumsum(np.where(inside, 0, step), dtype=np.int64)
            s[2][begin] = min(s[2][begin], int(depth.min()))
            s[1][begin] = int(depth[-1])
        s[0] = (s[0] + int(quote.sum())) % 2
    keys = list(held)
    column = lambda f, kind: pa.array([f(held[k]) for k in keys], kind)
    yield pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()), column(lambda s: s[0], pa.int32()),
         column(lambda s: s[1][0], pa.int64()), column(lambda s: s[1][1], pa.int64()), column(lambda s: s[2][0], pa.int64()), column(lambda s: s[2][1], pa.int64())],
        names=["file", "start", "parity", "delta0", "delta1", "low0", "low1"])


def _elements(batches):
    """(file, owner, start, text): whole elements, owner null, and parts of elements that reach over a byte range's border.

    ``owner`` is the start of the range in which the element begins; it and the state at a range's
    beginning come with the rows.
    """
    out: list[tuple] = []
    here, inside0, depth0, owner, parts = None, False, 0, None, []

    def batch():
        rows = [pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), [pa.string(), pa.int64(), pa.int64(), pa.string()], strict=True)]
        out.clear()
        return pa.RecordBatch.from_arrays(rows, names=["file", "owner", "start", "text"])

    def close():  # what is open where a range ends
        if parts:
            out.append((here[0], owner, here[1], b"".join(parts).decode("utf-8")))
            parts.clear()

    for key, rows, raw in _fragments(batches):
        if key != here:
            close()
            first = rows.slice(0, 1).select(["inside", "depth", "owner"]).to_pylist()[0]
            if first["inside"] is None:
                raise RuntimeError(f"read_json_array: no state for the byte range of {key[0]} at {key[1]}; the file has changed")
            here, inside0, depth0, owner = key, first["inside"], first["depth"], first["owner"]
        odd, step, quote = _marks(raw)
        step = np.where(~odd if inside0 else odd, 0, step)
        depth = depth0 + np.cumsum(step, dtype=np.int64)
        begins = np.flatnonzero((step > 0) & (depth == 1)).tolist()
        ends = (np.flatnonzero((step < 0) & (depth == 0)) + 1).tolist()
        if depth0 > 0:
            end = ends.pop(0) if ends and (len(ends) > len(begins) or not begins or ends[0] <= begins[0]) else len(raw)
            parts.append(raw[:end])
            if end < len(raw) or depth[-1] == 0:
                if owner == here[1]:
                    out.append((here[0], None, here[1], b"".join(parts).decode("utf-8")))
                    parts.clear()
                else:
                    close()
        for a, z in zip(begins, ends):
            out.append((here[0], None, here[1], raw[a:z].decode("utf-8")))
        if len(begins) > len(ends):
            owner = here[1]
            parts.append(raw[begins[-1]:])
        inside0, depth0 = bool((int(quote.sum()) + inside0) % 2), int(depth[-1])
        if out:
            yield batch()
    close()
    if out:
        yield batch()


def json_array_elements(spark: SparkSession, path: str) -> DataFrame:
    """The objects of JSON arrays as text, column ``value``: files are split by byte ranges like any text, whatever their lines.

    Spark's text scan cuts the files at closing braces (``lineSep``), and so into its usual
    ranges.  Whether a brace is structure or text depends on all quotes before it, so a first
    pass sums up each range for both cases; sums over the ranges of a file, one row each,
    give the state in which each begins; the second pass cuts out the elements.
    An element over a range's border is put together from its parts.  The table of ranges is
    broadcast: some 100 bytes for each ``spark.sql.files.maxPartitionBytes`` of input.

    Objects that stand outside an array, one after the other, are elements as well;
    elements that are no objects (numbers, texts, arrays of them) are left out.
    """
    rows = spark.read.option("lineSep", "}").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    found = map_partitions(rows, _summaries, "file string, start bigint, parity int, delta0 bigint, delta1 bigint, low0 bigint, low1 bigint")
    order = Window.partitionBy("file").orderBy("start")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    begun = found.withColumn("inside", F.coalesce(F.sum("parity").over(before), F.lit(0)) % 2 == 1)
    begun = begun.withColumn("delta", F.when(F.col("inside"), F.col("delta1")).otherwise(F.col("delta0"))).withColumn("low", F.when(F.col("inside"), F.col("low1")).otherwise(F.col("low0")))
    begun = begun.withColumn("depth", F.coalesce(F.sum("delta").over(before), F.lit(0)))
    opens = (F.col("depth") + F.col("low") <= 0) & (F.col("depth") + F.col("delta") > 0)  # an element that begins here is open at the end
    states = begun.withColumn("owner", F.last(F.when(opens, F.col("start")), ignorenulls=True).over(before)).select("file", "start", "inside", "depth", "owner")
    held = map_partitions(rows.join(F.broadcast(states), ["file", "start"], "left"), _elements, "file string, owner bigint, start bigint, text string")
    parts = held.where("owner is not null").groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("start", "text"))).alias("p"))  # the ranges of one element
    return held.where("owner is null").select(F.col("text").alias("value")) \
               .unionByName(parts.select(F.array_join(F.transform("p", lambda x: x["text"]), "").alias("value")))


def read_json_array(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """JSON arrays of objects, of any size and on any number of lines, read by as many tasks as their bytes ask for.

    With ``schema`` elements are parsed as they are found (an element that doesn't fit gives
    nulls, as in Spark's permissive mode).  Without, they are written as JSON lines to the shared scratch folder and
    read by Spark's own reader, which infers the schema from all of them.
    """
    elements = json_array_elements(spark, path)
    if schema is not None:
        return elements.select(F.from_json("value", schema if isinstance(schema, StructType) else StructType.fromDDL(schema)).alias("r")).select("r.*")
    lines = shared_dir(spark, "json_lines")
    elements.select(F.regexp_replace("value", r"[\r\n]+", " ")).write.text(lines)  # line ends lie between tokens only
    return spark.read.json(lines)
