"""Every catalogue query against its SQL oracle."""

import duckdb
import pytest

from folio.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for n in "region nation customer supplier part orders lineitem events documents pages conversations".split():
        c.execute(f"create view {n} as select * from '{SF}/{n}.parquet'")
    return c


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, con, name):
    df = catalogue.queries()[name](spark, SF)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    sql = catalogue.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(df.columns)
    assert got == rows(names, want.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.queries()["passages_offsets"](spark, SF).count() > 0


def test_mentions_read_no_further(spark, tmp_path):
    """Third and fourth word of a text without taking all of its words."""
    from pyspark.sql import functions as F

    from folio.plans import catalogue

    texts = ["", None, "a", "a b", "a b c", " a-b,c d e", "a_1 b2 é日 x", "--- a  b\nc\td", "a b c ", "...", "𝒳 b c d"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = catalogue._mentions(spark, str(tmp_path))
    words = F.regexp_extract_all("text", F.lit(rf"{catalogue._W}+"), F.lit(0))
    want = got.select("pmid", words.alias("w")).collect()
    assert {r.pmid: (r.one, r.two) for r in got.collect()} == {r.pmid: (r.w[2] if len(r.w or []) > 2 else None, " ".join(r.w[2:4]) if len(r.w or []) > 3 else None) for r in want}
    assert "extract_all" not in got._jdf.queryExecution().executedPlan().toString()
