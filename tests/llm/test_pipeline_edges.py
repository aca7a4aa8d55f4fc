"""The pipeline's stages on empty tables and on nulls, repeated rows, very long texts and clashing columns."""

import corpus_pipeline as C


def walk(spark, docs, path):
    """Every stage over what the one before kept, each written and read again; the ids left after each."""
    left = []
    for k, (_, stage) in enumerate(C.STAGES):
        out = stage(spark, docs, path)
        if k < len(C.STAGES) - 1:
            assert out.columns == docs.columns
        out.write.parquet(f"{path}/{k}")
        docs = spark.read.parquet(f"{path}/{k}")
        left.append(sorted((r.doc_id for r in docs.select("doc_id").collect()), key=str))
    return left, docs


def test_empty_table(spark, empty, tmp_path):
    left, packed = walk(spark, empty, str(tmp_path))
    assert left == [[], [], [], []] and packed.columns[0] == "doc_id"


def test_odd_rows(spark, odd, tmp_path):
    left, packed = walk(spark, odd, str(tmp_path))
    # Only the very long text has 50 words and few runs that recur; its copies under another id are one with it.
    assert set(left[0]) <= {6, 7} and set(left[1]) <= set(left[0]) and set(left[2]) <= {6} and set(left[3]) == set(left[2])


def test_null_ids_and_repeated_rows(spark, docs, tmp_path):
    some = docs.limit(60)
    from pyspark.sql import functions as F

    null = some.limit(5).withColumn("doc_id", F.lit(None).cast("long"))
    given = some.unionByName(some.limit(10)).unionByName(null)
    left, packed = walk(spark, given, str(tmp_path))
    once, _ = walk(spark, some, str(tmp_path / "once"))
    # Repeated rows stay once from the third stage on; rows without an id are no copies of others.
    known = [i for i in left[2] if i is not None]
    assert len(set(known)) == len(known)
    assert set(left[0]) - {None} == set(once[0]) and left[2].count(None) == left[1].count(None)
    assert len([i for i in left[3] if i is None]) >= left[2].count(None)
