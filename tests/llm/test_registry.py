import re

import pytest

import __spark_entry__ as E
import corpus_pipeline
from salesforge.llm import queries as Q
from salesforge.llm import packing, pii, quality_rules
from salesforge.llm.common import read_table
from tests.conftest import SMALL
from tests.llm import brute


def test_one_query_for_each_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in Q.QUERIES)
    assert numbers == list(range(1, 14))
    assert {*Q.QUERIES, "pipeline"} <= set(E.queries()) and set(Q.ORACLE) <= set(Q.QUERIES)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([r[i] for i in order]) for r in rows)


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_query_equals_its_sql(spark, duck, name):
    df = Q.QUERIES[name](spark, SMALL)
    want = duck.execute(Q.ORACLE[name])
    columns = [c[0] for c in want.description]
    assert sorted(df.columns) == sorted(columns)
    assert _rows(df.columns, df.collect()) == _rows(columns, want.fetchall())


def test_pipeline_equals_its_plain_stages(spark, monkeypatch):
    docs = {r["doc_id"]: r["text"] for r in read_table(spark, SMALL, "documents").collect()}
    frame = read_table(spark, SMALL, "documents")
    judged = quality_rules.judge(frame, quality_rules.fit(frame, read_table(spark, SMALL, "labels")))
    kept = {r["doc_id"] for r in judged.where("kept").collect()}
    assert all(not brute.base_failed(brute.quality_counts(docs[i])) for i in kept)
    docs = {i: t for i, t in docs.items() if i in kept}
    gone = brute.line_runs(docs, 20)
    docs = {i: brute.without_lines(t, gone[i]) if gone[i] else t for i, t in docs.items()}
    docs = {i: t for i, t in docs.items() if not gone[i] or brute.words(t)}
    root = brute.components(docs)
    docs = {i: t for i, t in docs.items() if root[i] == i}
    left = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    assert pii.entities(left).where("n_found > 0").count() == 0  # so base spans are all there is to mask
    docs = {i: brute.masked(t, brute.base_spans(t)) for i, t in docs.items()}
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    want = packing.pieces(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).select(*columns)
    got = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, want.collect()))


def test_stages_return_the_columns_of_documents(spark):
    docs = read_table(spark, SMALL, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near dedup", "personal data",
                                                      "packing"]
