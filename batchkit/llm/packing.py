"""Packing of documents' tokens into sequences of a fixed window: minimum bin slack.

1. Every whole text is encoded (:class:`Encoder`: the ids of the tokenizers library), an end id follows, and the ids are
   cut into full windows, each a sequence of its own, and one rest shorter than that.
2. What is left to pack is a multiset of rests.  Its histogram has at most ``window``
   rows at any corpus size.  On it :func:`plan` takes the longest rest left, finds
   by a bitset subset-sum dynamic programme the multiset of other rests that comes
   closest to filling the window, backtracks the counts, and repeats the sequence as
   often as the counts allow.  Where no multiset fills the window, the slack is filled
   by a piece cut from the longest rest left, whose other part goes back to the
   multiset; only the very last sequence may stay short.
3. A rest gets its number among the rests of its length (its number in its task, and
   the counts of the tasks before, by a join); the plan is a function of
   (length, number), applied as a bounded lookup.

Texts and ids never move: a shuffle carries (task, length, count) and one slim row a
document.  Ids of rests are kept in the scratch table, as those that are cut need the
checksums of their parts.

Edge cases: a null or empty text is the end id alone; repeated rows and rows of one or
of no id are packed each on its own; other columns are ignored, so clashing names do
no harm; an empty table gives an empty result.  Sequences of full windows have ids
from 2**40 on (by task), all others count from 0.
"""

from __future__ import annotations

import json
import os
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from batchkit.llm.common import mapped, slices, written

WINDOW = 2048
#: The id that ends a document.
END_ID = 1
#: Sequence ids of full windows start at (task + 1) << FULL_BITS.
FULL_BITS = 40


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


#: Fixed value: the byte-level pre-tokeniser's pattern.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the others for 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """Ids of texts as the tokenizers library gives them for a vocabulary file.

    A plain byte-level file (no normaliser, merges in the order of their ids, special
    tokens as written) is encoded by tiktoken from the file's own vocabulary: the same ids, three
    to five times as fast.  Any other file goes through the tokenizers library.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        with open(vocabulary, encoding="utf-8") as f:
            spec = json.load(f)
        self.file, self.slow, self.fast = vocabulary, None, self._byte_level(spec)
        self.dtype = "<u2" if (self.fast.n_vocab if self.fast else self._library().get_vocab_size()) <= 1 << 16 else "<u4"

    def _library(self):
        if self.slow is None:
            from tokenizers import Tokenizer
            self.slow = Tokenizer.from_file(self.file)
            self.slow.no_truncation()
            self.slow.no_padding()
        return self.slow

    @staticmethod
    def _byte_level(spec: dict):
        model, before, added = spec["model"], spec["pre_tokenizer"] or {}, spec["added_tokens"]
        plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        plain = plain and spec["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
        plain = plain and all(t["special"] and not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in added)
        if not plain:
            return None
        vocab, special, bytes_ = model["vocab"], {t["content"]: t["id"] for t in added}, byte_of()
        made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        pieces = {p: i for p, i in vocab.items() if p not in special}
        if made != sorted(made) or any(c not in bytes_ for p in pieces for c in p) or len(pieces) != 256 + len(made):
            return None
        import tiktoken
        return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks={bytes(map(bytes_.__getitem__, p)): i for p, i in pieces.items()}, special_tokens=special)

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        return [self._one(t or "") for t in texts]

    def _one(self, text: str) -> np.ndarray:
        if self.fast:
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all").astype(self.dtype)
            except ValueError:  # its pattern engine gives up on white space of some 100,000 characters on end
                pass
        return np.array(self._library().encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)


def checksum(ids: np.ndarray) -> int:
    """crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


TOKENIZED = "at long, task int, doc_id {kind}, doc_tokens long, first_full long, length int, nth long, checks array<long>, kept int, ids array<binary>"


def tokenized(docs: DataFrame, vocabulary: str | None = None, window: int = WINDOW, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text", keep_ids: bool = False) -> DataFrame:
    """A scratch table, one row a document: its tokens, the checksums of its full windows and its rest, and the ids of the rest.

    (task, at) names the row, ``first_full`` counts the task's full windows before it,
    ``length`` is that of the rest and ``nth`` counts the task's rests of that length
    before it.  ``ids`` are those of the rest, with ``keep_ids`` of every window, window
    ``kept`` first.
    """
    vocabulary = vocabulary or default_vocabulary()
    kind = docs.schema[doc_id].dataType

    def run(batches):
        encode, task = Encoder(vocabulary), TaskContext.get().partitionId()
        seen = np.zeros(window, np.int64)
        at = full = 0
        for b in slices(batches, 128):
            rows = []
            for ids in encode(b.column("text").to_pylist()):
                ids = np.append(ids, np.array([end_id], ids.dtype))
                rest = len(ids) % window
                cut = [ids[i:i + window] for i in range(0, len(ids), window)]
                kept = 0 if keep_ids else len(ids) // window
                rows.append((at, task, len(ids), full, rest, int(seen[rest]), [checksum(x) for x in cut], kept, [x.tobytes() for x in cut[kept:]]))
                at, full = at + 1, full + len(ids) // window
                seen[rest] += 1
            at_, task_, *others = zip(*rows, strict=True)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.list_(pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array(at_, pa.int64()), pa.array(task_, pa.int32()), b.column("id"), *(pa.array(x, k) for x, k in zip(others, kinds, strict=True))],
                                             names=["at", "task", "doc_id", "doc_tokens", "first_full", "length", "nth", "checks", "kept", "ids"])

    source = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    return written(source.transform(mapped, run, TOKENIZED.format(kind=kind.simpleString())), "packing-tokens")


def fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset out of ``counts`` whose sum comes closest to ``room`` from below.

    ``reach`` has bit s set if some multiset of the lengths so far sums to s; lengths
    go in from the longest, a count in powers of two, until ``room`` is reached.
    Backwards, a step is taken where the sum isn't reached without it.
    """
    reach, steps, mask = 1, [], (1 << (room + 1)) - 1
    for length in sorted((n for n, c in counts.items() if c > 0 and n <= room), reverse=True):
        left, some = min(counts[length], room // length), 1
        while left:
            some = min(some, left)
            steps.append((reach, length, some))
            reach |= (reach << (length * some)) & mask
            left, some = left - some, some * 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for before, length, some in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + some
            total -= length * some
    return chosen


class Rule(NamedTuple):
    """Rests of ``length`` numbered ``first`` to ``last`` (exclusive): ``each`` of them to every sequence from ``sequence`` on, the first at ``offset``.

    Where ``taken`` is less than the length, only that many ids go there, and the others are the rest of
    length - taken whose number is ``onward`` plus the place within the rule.
    """

    length: int
    first: int
    last: int
    each: int
    sequence: int
    offset: int
    taken: int
    onward: int


def plan(histogram: dict[int, int], window: int = WINDOW) -> tuple[list[Rule], int]:
    """The rules for a multiset of rests (lengths under ``window``) and the number of their sequences."""
    left = {n: c for n, c in histogram.items() if c > 0}
    made, used = dict(left), dict.fromkeys(left, 0)
    rules: list[Rule] = []
    sequences = 0
    while left:
        seed = max(left)
        others = left | {seed: left[seed] - 1}
        chosen = fill(others, window - seed)
        chosen[seed] = chosen.get(seed, 0) + 1
        slack = window - sum(n * k for n, k in chosen.items())
        cut = max((n for n, c in left.items() if n > slack > 0 and c > chosen.get(n, 0)), default=None)
        need = chosen if cut is None else chosen | {cut: chosen.get(cut, 0) + 1}
        times = min(left[n] // k for n, k in need.items())
        offset = 0
        for n, k in sorted(chosen.items(), reverse=True):
            rules.append(Rule(n, used[n], used[n] + k * times, k, sequences, offset, n, 0))
            used[n] += k * times
            offset += n * k
        if cut is not None:
            rest = cut - slack
            rules.append(Rule(cut, used[cut], used[cut] + times, 1, sequences, offset, slack, made.get(rest, 0)))
            used[cut] += times
            used.setdefault(rest, 0)
            made[rest] = made.get(rest, 0) + times
            left[rest] = left.get(rest, 0) + times
        for n, k in need.items():
            left[n] -= k * times
        left = {n: c for n, c in left.items() if c}
        sequences += times
    return rules, sequences


#: Numbers of rests are below this, so that (length, number) is one 64-bit key.
_NUMBERS = 44


def places(rules: dict[str, np.ndarray], length: np.ndarray, number: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """Where rests go: arrays (row, start within the rest, ids taken, sequence, offset), one tuple for each cut further on."""
    row, start = np.arange(len(length)), np.zeros(len(length), np.int64)
    length, number, out = length.astype(np.int64), number.astype(np.int64), []
    while len(row):
        at = np.searchsorted(rules["key"], (length << _NUMBERS) + number, side="right") - 1
        nth = number - rules["first"][at]
        each, taken = rules["each"][at], rules["taken"][at]
        out.append((row, start, taken, rules["sequence"][at] + nth // each, rules["offset"][at] + nth % each * taken))
        on = np.flatnonzero(taken < length)
        row, start, length, number = row[on], start[on] + taken[on], length[on] - taken[on], rules["onward"][at[on]] + nth[on]
    return out


PIECE = "task int, at long, doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, vocabulary: str | None = None, window: int = WINDOW, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) per piece of the documents' ids; ``with_ids`` adds them.

    ``ids`` is then the piece as little-endian unsigned integers, of 16 bits if the vocabulary fits, else of 32.
    """
    spark = docs.sparkSession
    vocabulary = vocabulary or default_vocabulary()
    table = tokenized(docs, vocabulary, window, end_id, doc_id, text, with_ids)
    kind = table.schema["doc_id"].dataType.simpleString()
    counts = table.where("length > 0").groupBy("task", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # fewer rows than the window
    listed, _ = plan(histogram, window)
    listed.sort(key=lambda r: (r.length, r.first))
    arrays = {name: np.array([getattr(r, name) for r in listed], np.int64) for name in Rule._fields}
    arrays["key"] = (arrays["length"] << _NUMBERS) + arrays["first"]
    shared = spark.sparkContext.broadcast(arrays)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    slim = table.drop("ids", "kept").join(offsets, ["task", "length"], "left") \
                .select("task", "at", "doc_id", "doc_tokens", "first_full", "length", (F.col("before") + F.col("nth")).alias("number"), "checks")

    def place(batches):
        rules = shared.value
        for b in slices(batches, 4096):
            take = lambda name: b.column(name).to_numpy(zero_copy_only=False)
            tasks, tokens, rest, full_before = take("task").astype(np.int64), take("doc_tokens"), take("length").astype(np.int64), take("first_full")
            full = tokens // window
            checks = b.column("checks")
            flat, check_at = checks.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(full + (rest > 0))])
            # full windows
            row = np.repeat(np.arange(len(full)), full)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(full) - full, full)
            parts = [(row, nth * window, np.full(len(row), window), flat[check_at[row] + nth], np.zeros(len(row), bool), ((tasks[row] + 1) << FULL_BITS) + full_before[row] + nth, np.zeros(len(row), np.int64))]
            # rests
            some = np.flatnonzero(rest)
            for row, start, taken, sequence, offset in places(rules, rest[some], take("number")[some]):
                row = some[row]
                parts.append((row, full[row] * window + start, taken, flat[check_at[row] + full[row]], taken < rest[row], sequence, offset))
            row, start, length, check, cut, sequence, offset = (np.concatenate(x) for x in zip(*parts, strict=True))
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [b.column("task").take(at), b.column("at").take(at), b.column("doc_id").take(at), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                 pa.array(check, pa.int64(), mask=cut), b.column("doc_tokens").take(at), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=["task", "at", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    pieces = written(slim.transform(mapped, place, PIECE.format(kind=kind)), "packing-pieces")
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    dtype = Encoder(vocabulary).dtype

    def finish(batches):
        for b in slices(batches, 1024):
            got = [np.frombuffer(x, dtype)[s % window:s % window + n] for x, s, n in zip(*(b.column(c).to_pylist() for c in ("ids", "start", "length")), strict=True)]
            checks = pa.array([checksum(x) for x in got], pa.int64())
            own = [checks if c == "ids_crc32" else b.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*own, *([pa.array([x.tobytes() for x in got], pa.binary())] if with_ids else [])], names=[*columns, *(["ids"] if with_ids else [])])

    schema = ", ".join(f"{f} {pieces.schema[f].dataType.simpleString()}" for f in columns)
    # a piece lies within one window of its document, so only that window's ids meet it
    ids = table.select("task", "at", "kept", F.posexplode("ids").alias("pos", "ids")).select("task", "at", (F.col("kept") + F.col("pos")).alias("nth"), "ids")
    of_window = F.call_function("div", F.col("start"), F.lit(window)).cast("int").alias("nth")
    looked_up = lambda some: some.select("*", of_window).join(ids, ["task", "at", "nth"]).select(*columns, "ids")
    if with_ids:
        return looked_up(pieces).transform(mapped, finish, schema + ", ids binary")
    # pieces of rests that were cut, a table of its own so that Spark knows its size: their ids are looked up for the checksum
    cut = written(pieces.where("ids_crc32 is null"), "packing-cut")
    return pieces.where("ids_crc32 is not null").select(*columns).unionByName(looked_up(cut).transform(mapped, finish, schema))


def padding(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row (sequences, tokens, padding): ids lacking to a full window, none where a sequence's length is a power of two."""
    filled = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    short = F.when(F.col("n").bitwiseAND(F.col("n") - 1) == 0, 0).otherwise(window - F.col("n"))
    return filled.agg(F.count("*").alias("sequences"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.coalesce(F.sum(short), F.lit(0)).alias("padding"))
