"""The pipeline's stages against brute force, and the oracle queries against DuckDB."""

import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from batchkit.llm import bpe, jaccard, mixing, queries, secrets

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    out.append(("documents", docs.collect()))
    for k, (name, f) in enumerate(P.STAGES):
        docs = f(spark, docs, SF)
        out.append((name, docs.collect()))
        if k < len(P.STAGES) - 1:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            docs = spark.createDataFrame(out[-1][1], docs.schema)
    return out


def test_stage_names():
    assert [n for n, _ in P.STAGES] == ["quality", "near_duplicates", "secrets", "mixture", "tokens"]


def test_quality_keeps_clean_documents(spark, steps):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before, after = ({r["doc_id"] for r in s[1]} for s in steps[:2])
    assert after < before and sum(labels[i] for i in before - after if i in labels) <= 1
    junk = [i for i, q in labels.items() if q == 0 and zlib.crc32(str(i).encode()) % 3 != 1]
    assert sum(i in after for i in junk) <= 0.1 * len(junk)


def test_one_document_of_each_group(spark, steps):
    before, after = steps[1][1], steps[2][1]
    sets = {r["doc_id"]: shingles(r["text"]) for r in before}
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if b < a and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    assert sorted(r["doc_id"] for r in after) == [i for i in ids if find(i) == i]


def shingles(text):
    w = (text or "").encode().translate(jaccard.WordHashes.__init__.__globals__["LOWER"]).split()
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_secrets_are_gone(spark, steps):
    import re
    before, after = steps[2][1], {r["doc_id"]: r for r in steps[3][1]}
    assert len(before) == len(after)
    for r in before:
        new = after[r["doc_id"]]
        found = any(len(m[2]) >= 6 for m in re.finditer(secrets.ASSIGN, r["text"])) or re.search(f"{secrets.ACCESS}|{secrets.HEX}", r["text"])
        assert new["n_chars"] == len(new["text"]) and (not found or "[SECRET]" in new["text"])
        assert found or new["text"] == r["text"] or "[SECRET]" in new["text"]


def test_mixture_repeats_documents(spark, steps):
    before, after = steps[3][1], [r["doc_id"] for r in steps[4][1]]
    plan = mixing.mix(spark.createDataFrame(before)).collect()
    for r in plan:
        assert after.count(r["doc_id"]) == (-(-r["taken"] // r["size"]) if r["taken"] else 0)


def test_tokens(steps):
    texts = {r["doc_id"]: r["text"] for r in steps[4][1]}
    assert len(steps[5][1]) == len(steps[4][1])
    for r in steps[5][1][:60]:
        assert (r["n_tokens"], r["decoded_sha256"]) == bpe.reference_digest(texts[r["doc_id"]])[::2]


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_oracles(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    got = queries.QUERIES[name](spark, SF)
    want = con.execute(queries.ORACLE_SQL[name])
    order = [d[0] for d in want.description]
    assert sorted(map(tuple, got.select(*order).collect())) == sorted(want.fetchall())


def odd_documents(spark):
    """Nulls in any column, empty and long texts, repeated rows, ties, and columns whose names the stages use themselves."""
    long_ = " ".join(f"word{i % 700} and" for i in range(20_000))
    rows = [(1, "A plain sentence about nothing much, twice. " * 4, "en", "web", 10), (1, "A plain sentence about nothing much, twice. " * 4, "en", "web", 10), (2, None, None, None, None), (3, "", "en", "web", 0),
            (None, "Another text whose id is missing, with token=abcdef123456 in it. " * 3, "de", None, 3), (None, None, None, "web", None), (4, long_, "fr", "books", len(long_)),
            (5, "A plain sentence about nothing much, twice. " * 4, "en", "books", 10), (6, " \t\n", "es", "\U0001F600", 3), (6, "same id, other text " * 9, "es", "web", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("id", "label", "size", "key", "base", "spans", "component_id", "row", "t", "copy", "taken", "_s", "slot", "word"):
        df = df.withColumn(name, F.lit("x"))
    return df


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_stages_take_odd_documents(spark, name):
    stage, docs = dict(P.STAGES)[name], odd_documents(spark)
    out = stage(spark, docs.repartition(3), SF)
    got = out.collect()
    ids = [r["doc_id"] for r in got]
    if name == "tokens":
        assert len(got) == docs.count() and sorted(map(str, ids)) == sorted(str(r["doc_id"]) for r in docs.collect())
        assert {r["n_tokens"] for r in got if r["doc_id"] in (2, 3)} == {0}
    else:
        assert out.columns == docs.columns and {r["label"] for r in got} <= {"x"}
    if name == "near_duplicates":
        assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 6, 6] and ids.count(None) == 2  # 5 links with 1, one of the two rows of 1 stays
    if name == "secrets":
        assert len(got) == docs.count() and not any("abcdef123456" in (r["text"] or "") for r in got)
        assert all(r["text"] is None or r["n_chars"] == len(r["text"]) for r in got)
    if name == "mixture":
        assert all((r["text"] or "").split() for r in got)
    none = stage(spark, docs.limit(0), SF)
    assert none.columns == out.columns and none.collect() == []
