import corpus_pipeline
import __spark_entry__ as entry
from tests.conftest import SF001, SF01
from tests.oracle import duck
from trendlake.llm import queries
from trendlake.llm.common import materialize, table


def test_stages_take_effect(spark):
    docs = table(spark, SF001, "documents")
    names = docs.columns
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF001), "test")
        counts.append(docs.count())
        if name != "byte_bpe":
            assert docs.columns == names
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line_dedup", "simhash_near_dedup", "mixing", "byte_bpe"]
    assert counts[1] == counts[2] > counts[3] < counts[4] == counts[5]


def test_queries_are_registered():
    found = entry.queries()
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in found) == 1
    assert "pipeline" in found and set(queries.SQL) <= set(entry.oracle_sql())


def test_queries_match_their_sql(spark):
    con = duck(SF01)
    for name, sql in queries.SQL.items():
        got = queries.QUERIES[name](spark, SF01).toPandas()
        want = con.sql(sql).df()
        columns = sorted(got.columns)
        assert columns == sorted(want.columns), name
        key = lambda df: sorted(map(tuple, df[columns].astype(object).where(df[columns].notna(), None).values.tolist()),
                                key=lambda row: [(v is not None, v) for v in row])     # a null sorts first
        assert key(got) == key(want), name
