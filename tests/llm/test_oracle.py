import pytest

from lamella.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_sql(spark, data, duck, name):
    got = queries.queries()[name](spark, data)
    want = duck.sql(queries.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    pick = lambda names, rows: sorted(([r[names.index(c)] for c in sorted(names)] for r in rows), key=repr)
    assert pick(got.columns, [tuple(r) for r in got.collect()]) == pick(want.columns, want.fetchall())


def test_pipeline(spark, data):
    import corpus_pipeline

    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns, kept = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, data)
        assert kept.columns == columns, name
        assert kept.schema == docs.schema or [f.dataType for f in kept.schema] == [f.dataType for f in docs.schema]
    out = corpus_pipeline.run(spark, data)
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(out.columns) and out.count() > 0
