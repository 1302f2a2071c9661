"""Same answers when every input table is split into 17 files."""

import os

import pytest

import __spark_entry__ as E
from conftest import SF001
from test_oracle import ORACLE, _canon

TABLES = ("region nation customer supplier part orders lineitem events documents labels conversations "
          "pages benchmark embeddings").split()


@pytest.fixture(scope="module")
def split_dir(spark, tmp_path_factory):
    out = tmp_path_factory.mktemp("sf001_split17")
    for t in TABLES:
        src = os.path.join(SF001, f"{t}.parquet")
        if os.path.exists(src):
            spark.read.parquet(src).repartition(17).write.parquet(str(out / f"{t}.parquet"))
    return str(out)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_same_on_17_files(spark, duck, split_dir, key):
    df = E.queries()[key](spark, split_dir)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[key])
    ocols = [d[0] for d in res.description]
    assert _canon(df.columns, rows) == _canon(ocols, res.fetchall())
