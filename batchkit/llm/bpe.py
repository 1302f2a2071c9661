"""BPE encoding and decoding through a table of distinct words.

Words are cut at ASCII white space, which the vocabulary's normaliser and its
pre-tokeniser both treat as a break, so the ids of a text are the ids of its
words in order.  Every distinct word of the corpus is encoded once
(:func:`word_table`), and ids return to the words' positions in two exact ways:

* the most frequent words, at most LOOKUP_WORDS with LOOKUP_IDS ids in all, by a
  broadcast lookup of that bounded size while a text is read;
* all other words, if there are any, through a join on the word, after which the
  parts of a text are put together by position.

Decoding joins ids with the vocabulary's pieces (a table of fixed size) and puts a
space between pieces, as the vocabulary names no decoder.

Edge cases: null and empty texts have no ids and decode to an empty string;
repeated rows are encoded each on its own; all input columns but those named are
ignored, so clashing names do no harm; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchkit.llm.common import mapped, slices, tidy, written

#: Bounds of the broadcast lookup: 12 bytes a word and 2 an id (4 if the vocabulary is larger than 65,536).
LOOKUP_WORDS = 6_000_000
LOOKUP_IDS = 30_000_000
#: Words whose ids a task keeps at hand; the memo starts anew beyond this.
MEMO_WORDS = 150_000
#: Distinct words that a task counts before it passes them on.
COUNTED_WORDS = 600_000


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def split_words(text: str | None) -> list[bytes]:
    """Runs of anything but ASCII white space, as UTF-8."""
    return (text or "").encode("utf-8").split()


def _count_words(batches):
    counts: Counter = Counter()

    def out():
        words = list(counts)
        for i in range(0, len(words), 50_000):
            part = words[i:i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array([counts[w] for w in part], pa.int64())], names=["word", "n"])
        counts.clear()

    for b in slices(batches):
        for text in b.column(0).to_pylist():
            counts.update(split_words(text))
            if len(counts) > COUNTED_WORDS:
                yield from out()
    yield from out()


def word_table(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """(word binary, n long, ids binary): each distinct word with its count and its ids as little-endian 32-bit integers."""
    counts = docs.select(F.col(text).alias("text")).transform(mapped, _count_words, "word binary, n long") \
                 .groupBy("word").agg(F.sum("n").alias("n"))

    def encode(batches):
        t = _tokenizer(vocabulary)
        for b in slices(batches, 10_000):
            ids = []
            words = b.column(0).to_pylist()
            for i in range(0, len(words), 2000):
                got = t.encode_batch_fast([w.decode("utf-8") for w in words[i:i + 2000]], add_special_tokens=False)
                ids += [np.array(e.ids, "<u4").tobytes() for e in got]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ids, pa.binary())], names=["word", "n", "ids"])

    return written(counts.transform(mapped, encode, "word binary, n long, ids binary"), "bpe-words")


def most_frequent(table: DataFrame, words: int = LOOKUP_WORDS, ids: int = LOOKUP_IDS) -> tuple[DataFrame, bool]:
    """The most frequent words, as many steps of the logarithm of the count as keep to the bounds, and whether these are all."""
    step = F.floor(8 * F.log2("n"))
    least, rows, held, whole = 1 << 30, 0, 0, True
    for r in sorted(table.groupBy(step.alias("step")).agg(F.count("*").alias("rows"), F.sum(F.length("ids") / 4).alias("ids")).collect(), key=lambda r: -r["step"]):  # some hundred steps at most
        rows, held = rows + r["rows"], held + r["ids"]
        if rows > words or held > ids:
            whole = False
            break
        least = r["step"]
    return table.where(step >= least), whole


_DIGEST = np.dtype([("key", "<u8"), ("check", "<u4"), ("rest", "<u4")])


def word_keys(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit key of each word and 32 more bits to check it."""
    digests = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), _DIGEST)
    return digests["key"].copy(), digests["check"].copy()


class Lookup:
    """Words by their keys, sorted, with their ids in one array of 16 (or 32) bits each."""

    def __init__(self, keys: np.ndarray, checks: np.ndarray, sizes: np.ndarray, ids: np.ndarray):
        order = np.argsort(keys)
        begin = (np.cumsum(sizes, dtype=np.int64) - sizes)[order]
        sizes = sizes[order].astype(np.int64)
        self.keys, self.checks = keys[order], checks[order]
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.uint32)
        self.ids = np.empty(len(ids), ids.dtype)
        for i in range(0, len(order), 1 << 18):  # the ids in the order of the keys, some words at a time
            n = sizes[i:i + (1 << 18)]
            at = np.repeat(begin[i:i + (1 << 18)] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            self.ids[self.starts[i]:self.starts[i] + len(at)] = ids[at]

    @classmethod
    def load(cls, arrays: dict) -> Lookup:
        out = cls.__new__(cls)
        vars(out).update(arrays)
        return out

    @classmethod
    def of(cls, table: DataFrame) -> Lookup:
        """From rows (word, ids), packed in the tasks."""
        def pack(batches):
            for b in slices(batches, 50_000):
                keys, checks = word_keys(b.column("word").to_pylist())
                ids = [np.frombuffer(x, "<u4") for x in b.column("ids").to_pylist()]
                flat = np.concatenate(ids) if ids else np.zeros(0, "<u4")
                parts = (keys, checks, np.array([len(x) for x in ids], np.uint32), flat.astype(np.uint16) if flat.max(initial=0) < 1 << 16 else flat)
                yield pa.RecordBatch.from_arrays([*(pa.array([x.tobytes()], pa.binary()) for x in parts), pa.array([parts[3].itemsize], pa.int32())], names=["k", "c", "s", "i", "width"])

        got = table.select("word", "ids").transform(mapped, pack, "k binary, c binary, s binary, i binary, width int").toArrow()
        join = lambda name, kind: np.concatenate([np.zeros(0, kind), *(np.frombuffer(x.as_buffer(), kind) for x in got.column(name))])
        ids = np.concatenate([np.zeros(0, np.uint16), *(np.frombuffer(x.as_buffer(), np.uint16 if w.as_py() == 2 else "<u4") for x, w in zip(got.column("i"), got.column("width"), strict=True))])
        parts = join("k", np.uint64), join("c", np.uint32), join("s", np.uint32)
        del got
        return cls(*parts, ids)

    def find(self, words: list[bytes]) -> list[bytes | None]:
        """The ids of each word as bytes of the array's own width, or None."""
        if not len(self.keys) or not words:
            return [None] * len(words)
        keys, checks = word_keys(words)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        good = (self.keys[at] == keys) & (self.checks[at] == checks)
        width, data = self.ids.itemsize, memoryview(self.ids).cast("B")
        starts, ends = self.starts[at].astype(np.int64) * width, self.starts[at + 1].astype(np.int64) * width
        return [bytes(data[a:z]) if g else None for g, a, z in zip(good.tolist(), starts.tolist(), ends.tolist(), strict=True)]

    def widen(self, parts: list[bytes]) -> bytes:
        """Ids found as little-endian 32-bit integers."""
        return np.frombuffer(b"".join(parts), self.ids.dtype).astype("<u4").tobytes()


class Places:
    """Ids of the words of texts from a lookup, memoised per task."""

    def __init__(self, lookup: Lookup):
        self.lookup, self.memo = lookup, {}

    def __call__(self, texts: list[str | None]) -> list[tuple[list[bytes], list[bytes]]]:
        """(gaps, missing) per text: the words that aren't in the lookup, and the ids before, between and after them."""
        out = []
        for at in range(0, len(texts), 256):
            listed = [split_words(t) for t in texts[at:at + 256]]
            new = list(set().union(*listed).difference(self.memo)) if listed else []
            if len(self.memo) + len(new) > MEMO_WORDS:
                self.memo.clear()
                new = list(set().union(*listed))
            self.memo.update(zip(new, self.lookup.find(new), strict=True))
            for words in listed:
                ids = list(map(self.memo.__getitem__, words))
                if None not in ids:
                    out.append(([self.lookup.widen(ids)], []))
                    continue
                holes = [k for k, x in enumerate(ids) if x is None]
                gaps = [self.lookup.widen(ids[a + 1:b]) for a, b in zip([-1, *holes], [*holes, len(ids)], strict=True)]
                out.append((gaps, [words[k] for k in holes]))
        return out


Finish = Callable[[], Callable[[bytes], tuple]]


def _ids_only() -> Callable[[bytes], tuple]:
    return lambda ids: (ids,)


def encode(docs: DataFrame, vocabulary: str | None = None, doc_id: str = "doc_id", text: str = "text", lookup_words: int = LOOKUP_WORDS,
           finish: Finish = _ids_only, columns: str = "ids binary") -> DataFrame:
    """(doc_id, ids binary) per row of ``docs``: the ids of the whole text as little-endian unsigned 32-bit integers.

    ``finish()`` is called once per task; what it returns makes other ``columns`` of a text's ids.
    """
    vocabulary = vocabulary or default_vocabulary()
    table = word_table(docs, vocabulary, text)
    common, whole = most_frequent(table, lookup_words)
    lookup = docs.sparkSession.sparkContext.broadcast(vars(Lookup.of(common)))  # plain arrays: no class travels
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = pa.schema([(x.split()[0], {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[x.split()[1]]) for x in columns.split(", ")])

    def finished(id_, ids: list[bytes], done) -> pa.RecordBatch:
        rows = [done(x) for x in ids]
        return pa.RecordBatch.from_arrays([id_, *(pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema))], names=["id", *schema.names])

    source = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    if whole:
        def place(batches):
            places, done = Places(Lookup.load(lookup.value)), finish()
            for b in slices(batches):
                yield finished(b.column("id"), [gaps[0] for gaps, _ in places(b.column("text").to_pylist())], done)
            del places
            tidy(lookup)

        return source.transform(mapped, place, f"id {kind}, {columns}").withColumnRenamed("id", doc_id)

    def parts(batches):
        places = Places(Lookup.load(lookup.value))
        for b in slices(batches):
            got = places(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([g for g, _ in got], pa.list_(pa.binary())), pa.array([m for _, m in got], pa.list_(pa.binary()))], names=["id", "gaps", "missing"])
        del places
        tidy(lookup)

    def fill(batches):
        done = finish()
        for b in slices(batches):
            ids = [b"".join([x for pair in zip(gaps, [*(got or []), b""], strict=True) for x in pair]) for gaps, got in zip(b.column("gaps").to_pylist(), b.column("found").to_pylist(), strict=True)]
            yield finished(b.column("id"), ids, done)

    placed = written(source.transform(mapped, parts, f"id {kind}, gaps array<binary>, missing array<binary>").withColumn("row", F.monotonically_increasing_id()), "bpe-placed")
    found = placed.select("row", F.posexplode("missing").alias("pos", "word")).join(table.select("word", "ids"), "word") \
                  .groupBy("row").agg(F.array_sort(F.collect_list(F.struct("pos", "ids"))).alias("found"))  # the words of one text
    return placed.join(found, "row", "left").select("id", "gaps", F.transform("found", lambda x: x["ids"]).alias("found")) \
                 .transform(mapped, fill, f"id {kind}, {columns}").withColumnRenamed("id", doc_id)


def pieces(spark, vocabulary: str | None = None) -> DataFrame:
    """(id int, piece string): the vocabulary with its added tokens, a table of fixed size."""
    t = _tokenizer(vocabulary or default_vocabulary())
    rows = sorted((i, p) for p, i in t.get_vocab(with_added_tokens=True).items())
    return spark.createDataFrame(rows, "id int, piece string")


def piece_names(spark, vocabulary: str | None = None) -> np.ndarray:
    """The pieces by id."""
    table = pieces(spark, vocabulary).collect()  # the vocabulary, never the corpus
    names = np.full(max((r["id"] for r in table), default=-1) + 1, "", object)
    for r in table:
        names[r["id"]] = r["piece"]
    return names


def join_pieces(names: np.ndarray, ids: bytes | None) -> str:
    return " ".join(names[np.frombuffer(ids or b"", "<u4")])


def decode(encoded: DataFrame, vocabulary: str | None = None, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its ids: the piece of each id, a space between pieces, special tokens kept.

    The join of ids with pieces is a lookup in a broadcast table, whose size is that of the vocabulary.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(piece_names(encoded.sparkSession, vocabulary))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema) + f", `{out}` string"

    def join(batches):
        for b in batches:
            texts = [join_pieces(shared.value, x) for x in b.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*b.schema.names, out])

    return encoded.transform(mapped, join, schema)


def digest(docs: DataFrame, vocabulary: str | None = None, **options) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(piece_names(docs.sparkSession, vocabulary))

    def finish():
        names = shared.value
        return lambda ids: (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(join_pieces(names, ids).encode()).hexdigest())

    return encode(docs, vocabulary, finish=finish, columns="n_tokens long, ids_sha256 string, decoded_sha256 string", **options)


def tokens(docs: DataFrame, vocabulary: str | None = None, **options) -> DataFrame:
    """(doc_id, n_tokens, ids binary, decoded_sha256) per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(piece_names(docs.sparkSession, vocabulary))

    def finish():
        names = shared.value
        return lambda ids: (len(ids) // 4, ids, hashlib.sha256(join_pieces(names, ids).encode()).hexdigest())

    return encode(docs, vocabulary, finish=finish, columns="n_tokens long, ids binary, decoded_sha256 string", **options)


def reference_digest(text: str | None, vocabulary: str | None = None) -> tuple[int, str, str]:
    """The same for one text, straight from the tokenizers library (tests)."""
    t = _tokenizer(vocabulary or default_vocabulary())
    ids = t.encode(text or "", add_special_tokens=False).ids
    return (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
            hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest())
