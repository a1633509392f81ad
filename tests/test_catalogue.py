"""Every catalogue query agrees with its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from planforge.plans import catalogue

DATA = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    if not os.path.isdir(DATA):
        pytest.skip("no test data")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def norm(v):
    if v is None or v != v:
        return "-"
    return repr(round(float(v), 6)) if isinstance(v, int | float) and not isinstance(v, bool) else str(v)


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query(spark, db, name):
    got = catalogue.QUERIES[name](spark, DATA)
    want = db.execute(catalogue.SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(names)
    rows = sorted(tuple(map(norm, r)) for r in want.fetchall())
    assert sorted(tuple(map(norm, r)) for r in got.select(*names).collect()) == rows


def test_entry(spark):
    if os.path.isdir(DATA):
        assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def same_as_sql(spark, db, name, folder):
    want = db.execute(catalogue.SQL[name])
    names = [d[0] for d in want.description]
    got = catalogue.QUERIES[name](spark, folder).select(*names).collect()
    rows = sorted(tuple(map(norm, r)) for r in want.fetchall())
    assert sorted(tuple(map(norm, r)) for r in got) == rows
    return rows


def test_ocr_quality_halves(spark, tmp_path):
    """Scores of 76.25 and 81.25: 19 and 15 short words of 32."""
    texts = [" ".join(["the"] * short + ["house"] * (n - short)) for short, n in ((19, 32), (15, 32), (17, 32), (17, 33), (2, 3), (3, 8), (0, 1))] + ["", None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    rows = same_as_sql(spark, con, "ocr_quality", str(tmp_path))
    assert [r for r in rows if r[0] in ("0.0", "1.0")] == [("0.0", "76.3", "True"), ("1.0", "81.3", "True")]


def test_fields_of_findings(spark):
    """Findings made of fewer fields are the same ones in these fields, with the same verdicts, and null in the others."""
    if not os.path.isdir(DATA):
        pytest.skip("no test data")
    from planforge.operators import audit

    subjects, library = catalogue._subjects(catalogue.Tables(spark, DATA))
    matched = audit.match(subjects, library)
    whole, few = audit.evaluate(matched), audit.evaluate(matched, fields=("reason", "message"))
    kept = [*audit.KEYS, "reason", "message"]
    key = lambda df: {(r.subject_key, r.ord): r for r in audit.field_findings(df).collect()}
    a, b = key(whole), key(few)
    assert a.keys() == b.keys()
    assert all(a[k][c] == b[k][c] for k in a for c in kept)
    assert any(r.evidence for r in a.values()) and all(r[c] is None for r in b.values() for c in audit.FIELDS if c not in kept)
    rows = lambda df: sorted(map(str, audit.results(df).collect()))
    assert rows(whole) == rows(few)
    dims = lambda df: sorted(map(str, audit.dimension_findings(df).collect()))
    assert dims(whole) == dims(audit.evaluate(matched, fields=("reason",)))
