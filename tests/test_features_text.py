"""Feature preparation and text operators."""

import math

from pyspark.sql import functions as F

from scorecraft.operators import features as fe
from scorecraft.operators import text as tx
from conftest import SF_SMALL


def test_category_index_keeps_unseen(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",)], "c string")
    test = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    _, model = fe.category_index(train, ["c"])
    got = [r.c_index for r in model.transform(test).collect()]
    assert got == [0.0, 2.0, 2.0]


def test_mean_impute_replaces_null_and_nan(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "x double")
    got = [r.x for r in fe.mean_impute(df, ["x"]).collect()]
    assert got == [1.0, 2.0, 2.0, 3.0]


def test_l1_rows_sum_to_one(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (4.0, 0.0, 1.0)], "a double, b double, c double")
    out = fe.vector_columns(fe.l1_normalize(df, ["a", "b", "c"]), "normalized", ["a", "b", "c"],
                            digits=None)
    for r in out.collect():
        assert math.isclose(abs(r.a) + abs(r.b) + abs(r.c), 1.0)


def test_tokenize_whole_text_rules(spark):
    df = spark.createDataFrame([(1, "  The Quick brown fox's  jumps over the lazy dog\nagain "),
                                (2, None)], "doc_id int, text string")
    got = tx.tokenize(df).collect()
    assert len(got) == 1
    # 'the'/'over' are stop words; "fox's" is not alphabetic; 'dog\nagain' holds a newline
    assert got[0].tokens == ["quick", "brown", "jumps", "lazy"]


def test_svd_values_match_numpy(spark):
    import numpy as np
    rows = [(float(i), float(i % 3), float((i * 7) % 5)) for i in range(20)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = [r.singular_value for r in fe.svd_values(df, ["a", "b", "c"], 3).orderBy(
        "component").collect()]
    ref = np.linalg.svd(np.array(rows), compute_uv=False)
    assert np.allclose(got, ref)


def test_dataframe_vocabulary_matches_mllib(spark):
    """The DataFrame vocabulary/IDF equals CountVectorizer + IDF fits."""
    from scorecraft.operators import text as tx

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    toks = tx.tokenize(docs)
    _, cv, idf = tx.tfidf(toks, vocab_size=5000, min_df=3)
    ref = {t: round(float(v), 9) for t, v in zip(cv.vocabulary, idf.idf.toArray())}
    got = {r.term: round(r.idf, 9) for r in tx.vocabulary(toks, 5000, 3).collect()}
    assert got == ref
