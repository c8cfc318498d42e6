"""Every registered query of the subpackage: its oracle where it has one,
and the pipeline stage by stage."""
import pytest

from tidewater.llm.oracles import ORACLES
from tidewater.llm.queries import QUERIES
from tidewater.plans.check import digest, duck_connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf, name):
    df = QUERIES[name](spark, sf)
    rel = duck_connection(sf).execute(ORACLES[name])
    columns = [c[0] for c in rel.description]
    assert sorted(columns) == sorted(df.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(columns, rel.fetchall())


def test_entry_registers_one_query_per_operator():
    import __spark_entry__ as E
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in E.queries()) == 1
    assert "pipeline" in E.queries()


def test_pipeline(spark, sf):
    import corpus_pipeline as P
    from tidewater.llm.common import saved, table
    start = docs = table(spark, sf, "documents")
    counts = [docs.count()]
    for name, stage in P.STAGES:
        docs = saved(stage(spark, docs, sf), "test-stage")
        if name != P.STAGES[-1][0]:
            assert docs.columns == start.columns, name
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] >= counts[3] > 0
    assert docs.filter("octet_length(ids) <> 4 * length").count() == 0
    assert docs.groupBy("sequence_id").sum("length").agg({"sum(length)": "max"}).first()[0] <= 1024
    assert P.ORACLE_SQL is None


def test_pipeline_of_odd_rows(spark, tmp_path):
    """Nulls in every column, repeated rows, clashing columns, no rows."""
    import corpus_pipeline as P
    from tidewater.llm.common import saved
    schema = "doc_id long, text string, lang string, source string, n_chars long, digest string, twin int, id string, winner string"
    prose = [" ".join(f"w{(i * 31 + j * 7) % 997}" for j in range(60)) for i in range(30)]
    rows = [(i, t, None, f"s{i % 3}", None, "x", i, "y", None) for i, t in enumerate(prose)]
    rows += [rows[0]] * 3 + [(None, prose[1], None, None, None, None, None, None, None), (None, None, None, None, 1, "x", 1, "y", "z"),
                             (100, "", "en", "s0", 0, "x", 1, "y", "z"), (101, None, "en", None, 0, "x", 1, "y", "z"),
                             (102, prose[2] + " more", "en", "s1", 0, "x", 1, "y", "z"), (2, prose[2].upper(), "en", "s1", 0, "x", 1, "y", "z")]
    spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for own in (rows, []):
        docs = spark.createDataFrame(own, schema)
        for name, stage in P.STAGES:
            before = docs
            docs = saved(stage(spark, docs, str(tmp_path)), "test-odd")
            if name != P.STAGES[-1][0]:
                assert docs.columns == before.columns, name
            if name == "exact dedup":
                texts = [(r.text or "").lower() for r in docs.collect()]
                assert len(texts) == len(set(texts)) == len({(r.text or "").lower() for r in before.collect()})
        assert (docs.count() > 0) == bool(own)
