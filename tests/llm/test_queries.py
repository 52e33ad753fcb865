"""The registered queries on the smallest given tables."""

import duckdb
import pytest

import corpus_pipeline
from tallylake.llm import queries


def keyed(frame):
    columns = sorted(frame.columns)
    return sorted((tuple(map(str, row)) for row in frame[columns].itertuples(index=False)))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, sf_dir, name):
    db = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "embeddings"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    want = db.execute(queries.ORACLES[name]).df()
    got = queries.QUERIES[name](spark, sf_dir).toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    exact = [c for c in got.columns if got[c].dtype.kind != "f"]
    assert keyed(got[exact]) == keyed(want[exact].astype(got[exact].dtypes.to_dict()))


def test_stages(spark, sf_dir):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "decontamination", "private_data", "mixing",
    ]
    docs = queries.read(spark, sf_dir, "documents")
    kept = corpus_pipeline.run(spark, sf_dir)
    assert set(docs.columns) <= set(kept.columns)
    assert 0 < kept.count() < docs.count()
