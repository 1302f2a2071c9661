"""Secret scans, in DataFrame functions only.

Three rules find the plain cases (:data:`RULES`).  Beyond them every long run of
key-like characters is judged by two character Markov models, one of random strings
and one of ordinary identifiers: the sum over neighbouring characters of the
difference of log-probabilities.  A run whose sum passes THRESHOLD, and that no
rule's span covers, is added under the kind ``random``.

The models are trained from labelled samples (token, label): counts of neighbouring
characters, smoothed, so a model is a table of fixed size that enters the plan as a
literal.  :func:`samples` makes such samples from the corpus: its words, and names,
numbers and paths built of them, are ordinary; digests of them are random.

Spans count code points, the end excluded.  Edge cases: a null text is empty and has
no spans; repeated rows are scanned each on its own; spans of one start are ordered
by kind as listed; a token of any length is scored whole; an empty table gives an
empty result (and, as training has no samples then, a table of zeros: nothing is added).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from batchkit.llm.common import bounded_sample

# The kinds with their patterns and least lengths, as the contract states them.
ASSIGN = r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{16,}"  # a run that follows AKIA is taken whole, so a run too short fails either way
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")

#: Runs that the models judge.
CANDIDATE = r"[A-Za-z0-9+/_=-]{16,}"
#: Least sum of log-likelihood ratios, in nats.
THRESHOLD = 18.0
#: Documents read for training samples, and distinct words kept of them.
SAMPLE_DOCS = 2000
SAMPLE_WORDS = 12_000
#: Characters of candidates lie between '+' and 'z'; place 0 stands for the start of a token.
_FIRST, _PLACES = 42, 81
SMOOTHING = 0.5
#: Lengths are summed in blocks of so many, to keep long lists near-linear.
_BLOCK = 64
#: Characters in a block of a text that is cut.
_CUT = 4096


def _with_running(df: DataFrame, values: Column, name: str, largest: bool = False) -> DataFrame:
    """``df`` with ``name``: sums (or maxima, 0 at least) of the elements before each one of ``values``; null for a null or empty array.

    In blocks, whose totals are added up first.  Each step is a column of its own that the next
    names twice, so that the optimizer doesn't compute it anew inside a lambda.
    """
    join = (lambda s, x: F.greatest(s, x)) if largest else (lambda s, x: s + x)
    add = lambda a: F.aggregate(a, F.lit(0).cast("long"), join)
    df = df.withColumn("_v", values)
    blocks = F.sequence(F.lit(0), F.ceil(F.size("_v") / _BLOCK).cast("int") - 1)
    df = df.withColumn("_p", F.when(F.size("_v") > 0, F.transform(blocks, lambda b: F.struct(b.alias("b"), F.slice("_v", b * _BLOCK + 1, _BLOCK).alias("a")))))
    df = df.withColumn("_q", F.when(F.size("_p") > 0, F.transform("_p", lambda s: add(s["a"]))))
    starts = F.transform("_p", lambda s: F.struct(s["a"].alias("a"), add(F.slice("_q", 1, s["b"])).alias("at")))
    within = F.flatten(F.transform(starts, lambda s: F.transform(s["a"], lambda x, i: join(s["at"], add(F.slice(s["a"], 1, i))))))
    return df.withColumn(name, F.when(F.size("_q") > 0, within)).drop("_v", "_p", "_q")


def _up_to(spans: Column, start: Column) -> Column:
    """How many of ``spans``, which are in order, start at or before ``start``: a binary search."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(spans) + 1)).cast("int"))

    def halve(s, _):
        middle = F.call_function("div", s["lo"] + s["hi"], F.lit(2)).cast("int")
        upper = F.get(spans, middle)["start"] <= start
        return F.struct(F.when((s["lo"] < s["hi"]) & upper, middle + 1).otherwise(s["lo"]).alias("lo"), F.when((s["lo"] < s["hi"]) & ~upper, middle).otherwise(s["hi"]).alias("hi"))

    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.size(spans).alias("hi")), halve, lambda s: s["lo"])


def _covered(x: Column, spans: Column) -> Column:
    """Whether one of ``spans``, which are in order and don't overlap, holds all of ``x``: only the last that starts by then can."""
    return (F.size(spans) > 0) & F.coalesce(F.get(spans, _up_to(spans, x["start"]) - 1)["end"] >= x["end"], F.lit(False))


def _located(df: DataFrame, text: str, pattern: str, name: str) -> DataFrame:
    """``df`` with ``name``: array of (start, end, found) of the pattern's matches; the text between matches gives their places."""
    empty = f"array<struct<start:bigint,end:bigint,found:string>>"  # noqa: F541
    df = df.withColumn("_m", F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    df = df.withColumn("_g", F.when(F.size("_m") > 0, F.transform(F.split(text, pattern, -1), lambda p: F.length(p).cast("long"))))
    df = _with_running(df, F.when(F.size("_m") > 0, F.transform("_m", lambda x, i: F.length(x) + F.get("_g", i))), "_b")
    found = F.transform("_m", lambda x, i: F.struct((F.get("_b", i) + F.get("_g", i)).alias("start"), (F.get("_b", i) + F.get("_g", i) + F.length(x)).alias("end"), x.alias("found")))
    return df.withColumn(name, F.when(F.size("_m") > 0, found).otherwise(F.array().cast(empty))).drop("_m", "_g", "_b")


def samples(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", rows: int = SAMPLE_DOCS, words: int = SAMPLE_WORDS) -> DataFrame:
    """(token, label): ordinary (0) and random (1) strings made of the words of about ``rows`` documents."""
    some = bounded_sample(docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t")), rows, 3, "id")
    word = some.select(F.explode(F.regexp_extract_all("t", F.lit("[A-Za-z]{2,}"), F.lit(0))).alias("w")).distinct()
    word = bounded_sample(word, words, 5, "w")
    d = F.sha2(F.encode("w", "UTF-8"), 256)
    other = F.substring(F.lower("w"), 1, 6)
    ordinary = [F.col("w"), F.upper("w"), F.concat(F.lower("w"), F.lit("_"), other, F.lit("_id")), F.concat(F.lower("w"), F.initcap("w"), F.lit("Count")),
                F.concat(F.lower("w"), F.lit("/"), other, F.lit("-"), F.lower("w")), F.conv(F.substring(d, 1, 12), 16, 10), F.concat(F.lower("w"), F.conv(F.substring(d, 1, 2), 16, 10)),
                F.concat(F.lit("20"), F.lpad((F.conv(F.substring(d, 1, 2), 16, 10) % 30).cast("int").cast("string"), 2, "0"), F.lit("-0"), (F.conv(F.substring(d, 3, 2), 16, 10) % 9 + 1).cast("int").cast("string"), F.lit("-1"), (F.conv(F.substring(d, 5, 2), 16, 10) % 10).cast("int").cast("string")),
                F.repeat(F.substring("w", 1, 1), 20), F.lit("-" * 24), F.lit("=" * 24), F.lit("_" * 24)]
    random = [F.substring(d, 1, 32), F.base64(F.unhex(d)), F.base64(F.unhex(F.substring(d, 17, 48))), F.conv(F.substring(d, 1, 15), 16, 36), F.lower(F.conv(F.substring(d, 20, 15), 16, 36)), F.substring(F.upper(d), 1, 24)]
    made = F.array(*[F.struct(x.cast("string").alias("token"), F.lit(0).alias("label")) for x in ordinary], *[F.struct(x.cast("string").alias("token"), F.lit(1).alias("label")) for x in random])
    return word.select(F.explode(made).alias("s")).select("s.token", "s.label")


def train(labelled: DataFrame) -> list[float]:
    """Log-likelihood ratios, random over ordinary, of each pair of neighbouring characters (place 0: the start), as a flat table."""
    place = lambda c: F.ascii(c) - _FIRST
    chars = labelled.where("label in (0, 1)").select("label", F.split(F.regexp_replace("token", "[^+\\-/0-9=A-Z_a-z]", ""), "").alias("c"))
    pairs = chars.select("label", F.explode(F.transform("c", lambda x, i: F.when(i == 0, F.struct(F.lit(0).alias("a"), place(x).alias("b"))).otherwise(F.struct(place(F.get("c", i - 1)).alias("a"), place(x).alias("b"))))).alias("p"))
    counts = pairs.where("p.b > 0").groupBy("label", "p.a", "p.b").count().collect()  # at most 2 x 81 x 81 rows
    n = [[0.0] * (_PLACES * _PLACES) for _ in range(2)]
    for r in counts:
        n[r["label"]][r["a"] * _PLACES + r["b"]] += r["count"]
    out = [0.0] * (_PLACES * _PLACES)
    if not counts:
        return out
    for a in range(_PLACES):
        row = [sum(n[y][a * _PLACES:(a + 1) * _PLACES]) + SMOOTHING * 64 for y in range(2)]
        for b in range(_PLACES):
            x = [math.log((n[y][a * _PLACES + b] + SMOOTHING) / row[y]) for y in range(2)]
            out[a * _PLACES + b] = x[1] - x[0]
    return out


def likelihood_ratio(token: Column, model: list[float]) -> Column:
    """The sum of the model's ratios over a token's characters; a double."""
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in model)), ",").cast("array<double>")  # folded to a literal
    chars = F.transform(F.split(token, ""), lambda c: F.ascii(c) - _FIRST)
    return F.aggregate(chars, F.struct(F.lit(0).alias("a"), F.lit(0.0).alias("s")),
                       lambda s, c: F.struct(F.when(c > 0, c).otherwise(F.lit(0)).alias("a"), (s["s"] + F.when(c > 0, F.get(table, s["a"] * _PLACES + c)).otherwise(F.lit(0.0))).alias("s")), lambda s: s["s"])


def scan(docs: DataFrame, model: list[float], text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with base and spans: arrays of (start, kind, end), kind counting :data:`KINDS`, in order of start, then kind."""
    df = docs.withColumn("_t", F.coalesce(F.col(text), F.lit("")))
    df = _located(df, "_t", ASSIGN, "_assign")
    value = lambda x: F.regexp_extract(x["found"], ASSIGN, 2)
    df = _located(df, "_t", ACCESS, "_access")
    df = _located(df, "_t", HEX, "_hex")
    df = _located(df, "_t", CANDIDATE, "_run")
    as_span = lambda k: (lambda x: F.struct(x["start"].alias("start"), F.lit(k).alias("kind"), x["end"].alias("end")))
    df = df.withColumn("_assign", F.filter("_assign", lambda x: F.length(value(x)) >= 6))
    df = df.withColumn("base", F.array_sort(F.concat(F.transform("_assign", as_span(0)), F.transform("_access", as_span(1)), F.transform("_hex", as_span(2)))))
    # the spans of one rule are in order and apart, so a run meets one span of each at most
    df = df.withColumn("_run", F.filter("_run", lambda x: likelihood_ratio(x["found"], model) > threshold))
    added = F.filter("_run", lambda x: ~(_covered(x, F.col("_assign")) | _covered(x, F.col("_access")) | _covered(x, F.col("_hex"))))
    df = df.withColumn("_added", F.transform(added, as_span(3)))
    return df.withColumn("spans", F.array_sort(F.concat("base", "_added"))).drop("_t", "_assign", "_access", "_hex", "_run", "_added")


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) per row of ``docs``."""
    df = scan(docs.select("doc_id", "text"), train(samples(docs)))
    n = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return df.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"), F.sha2(F.encode(listed(F.col("base")), "UTF-8"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, model: list[float], text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of the scan replaced by ``mark``; overlapping spans become one mark."""
    # rows travel as one column, so that no name of theirs can clash
    df = scan(docs.select(F.struct("*").alias("_row"), F.col(text).alias("text")), model)
    # a span that starts beyond all ends before it opens a mark; the text from those ends to there is kept
    df = _with_running(df, F.transform("spans", lambda s: s["end"]), "_far", largest=True)
    # (named twice, so that the optimizer doesn't compute it anew for every span)
    gaps = F.transform("spans", lambda s, i: F.struct(F.get("_far", i).alias("a"), s["start"].alias("z"), ((i == 0) | (s["start"] > F.get("_far", i))).alias("opens")))
    df = df.withColumn("_gaps", F.filter(gaps, lambda g: g["opens"]))
    # blocks of text, so that cutting at a place doesn't count the characters from the beginning
    df = df.withColumn("_blocks", F.when(F.size("spans") > 0, F.regexp_extract_all("text", F.lit(f"(?s).{{1,{_CUT}}}"), F.lit(0))))
    block = lambda at: F.call_function("div", at, F.lit(_CUT)).cast("int")

    def piece(a, z):
        """Characters a to z; z null: to the end."""
        last = F.size("_blocks") - 1 if z is None else block(z)
        upto = F.lit(_CUT) if z is None else (z % _CUT).cast("int")
        begin = (a % _CUT).cast("int") + 1
        one = F.substring(F.coalesce(F.get("_blocks", block(a)), F.lit("")), begin, F.greatest(upto - begin + 1, F.lit(0)))
        more = F.concat(F.substring(F.get("_blocks", block(a)), begin, F.lit(_CUT)), F.array_join(F.slice("_blocks", block(a) + 2, F.greatest(last - block(a) - 1, F.lit(0))), ""),
                        F.substring(F.coalesce(F.get("_blocks", last), F.lit("")), F.lit(1), upto))
        return F.when(block(a) >= last, one).otherwise(more)

    kept = F.array_join(F.transform("_gaps", lambda g: F.concat(piece(g["a"], g["z"]), F.lit(mark))), "")
    end = F.aggregate("spans", F.lit(0).cast("long"), lambda m, s: F.greatest(m, s["end"]))
    out = F.when(F.size("spans") > 0, F.concat(kept, piece(end, None))).otherwise(F.col("text"))
    return df.select("_row", out.alias("text")).select(*[(F.col("text") if c == text else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])
