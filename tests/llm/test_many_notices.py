"""Texts of very many licence notices: right labels, and time that grows with the text."""

import time

from isobar.llm.licences import TEMPLATES, licence_scan, licence_sql
from tests.oracle import rows

MIT = next(t.phrase for t in TEMPLATES if t.label == "mit" and t.keys)
BSD = next(t.phrase for t in TEMPLATES if t.label == "bsd" and t.keys)


def test_time_grows_with_the_text(spark):
    took = {}
    for n in (100, 3_000, 12_000):
        df = spark.createDataFrame([(1, f"some words before {MIT} and words after " * n, "clash", "clash")], "doc_id long, text string, base string, bodies string")
        began = time.time()
        (row,) = licence_scan(df).collect()
        took[n] = time.time() - began
        assert row.labels == "mit" and row.score == 1.0 and row.base == "clash"
    # Most of the time is the same for any text; what is left grows about as the text does.
    assert took[12_000] - took[100] < 8 * max(took[3_000] - took[100], 1.0)


def test_keys_count_within_their_bodies_only(spark, tmp_path):
    words = MIT.split()
    torn = " ".join({"without": "under", "restriction": "limits"}.get(w, w) for w in words)
    texts = [MIT, torn, f"{torn} {'x ' * 5} without restriction", f"{torn} {'x ' * 40} without restriction", f"without restriction {torn}", f"{torn} {MIT} {torn}", f"{BSD} {MIT}", f"{BSD} " * 40 + torn, "", " ".join(words[:20]), None]
    df = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    df.coalesce(1).write.parquet(str(tmp_path / "documents"))
    import duckdb

    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents/*.parquet'")
    got = licence_scan(df.select("doc_id", "text")).toPandas()
    assert rows(got) == rows(con.sql(licence_sql()).df())
    labels = dict(zip(got.doc_id, got.labels, strict=True))
    assert "mit" in labels[0] and labels[1] == "" and "mit" in labels[2] and labels[3] == "" and "mit" in labels[5]
