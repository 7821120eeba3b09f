"""Text features: tokenising, term counts, IDF and LDA topics.

Tokenising is built-in string and array functions (JVM side); term
statistics are explode + grouped counts; vocabulary and IDF come from MLlib
(CountVectorizer, IDF) and LDA runs on MLlib's DataFrame API.
"""

from __future__ import annotations

from pyspark.ml.clustering import LDA
from pyspark.ml.feature import IDF, CountVectorizer, StopWordsRemover
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Spark's default English stop-word list (StopWordsRemover,
# "english"), 181 words, in its own order.
STOP_WORDS = """i me my myself we our ours ourselves you your yours yourself yourselves he
him his himself she her hers herself it its itself they them their theirs themselves what which
who whom this that these those am is are was were be been being have has had having do does did
doing a an the and but if or because as until while of at by for with about against between into
through during before after above below to from up down in out on off over under again further
then once here there when where why how all any both each few more most other some such no nor
not only own same so than too very s t can will just don should now i'll you'll he'll she'll
we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've
we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't
won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's let's ought
that's there's what's when's where's who's why's would""".split()


def tokenize(df: DataFrame, text: str = "text", out: str = "tokens",
             min_length: int = 4) -> DataFrame:
    """Drop NULL texts; trim, lower, split on single spaces; keep purely
    alphabetic (Unicode letters) tokens of >= min_length characters; remove
    stop words (duplicates kept). Whole texts are processed."""
    # A space-delimited token that is all letters and at least min_length long
    # is a letter run with a space (or the text edge) on both sides: one
    # regex pass per text instead of splitting and testing every token.
    token = rf"(?<![^ ])\p{{L}}{{{min_length},}}(?![^ ])"
    kept = F.regexp_extract_all(F.lower(F.trim(F.col(text))), F.lit(token), 0)
    res = df.filter(F.col(text).isNotNull()).withColumn("_raw_tokens", kept)
    res = StopWordsRemover(inputCol="_raw_tokens", outputCol=out, stopWords=STOP_WORDS,
                           caseSensitive=False).transform(res)
    return res.drop("_raw_tokens")


def doc_terms(tokens: DataFrame, doc: str = "doc_id", col: str = "tokens") -> DataFrame:
    """``doc, term, n``: occurrences of each term in each row's tokens. A row is a
    document, whether its id repeats or not (as in MLlib's vectors); its sorted tokens
    are counted as runs inside the row, so no token is shuffled."""
    rows = tokens.select(doc, F.sort_array(col).alias("_s")).filter(F.size("_s") > 0)
    rows = rows.withColumn("_end", F.expr(
        "filter(sequence(1, size(_s)), i -> i = size(_s) OR _s[i - 1] <> _s[i])"))  # last places of the runs
    runs = F.expr("transform(_end, (e, j) -> struct(_s[e - 1] AS term, "
                  "CAST(e - if(j = 0, 0, _end[j - 1]) AS BIGINT) AS n))")
    return rows.select(doc, F.explode(runs).alias("_r")).select(doc, "_r.term", "_r.n")


def term_stats(tokens: DataFrame, doc: str = "doc_id", col: str = "tokens") -> DataFrame:
    """``term, df, tf``: documents containing the term and total occurrences. Tasks add
    up their own documents first; one row per task and term is shuffled."""
    return doc_terms(tokens, doc, col).groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("n").alias("tf"))


def count_vectorize(tokens: DataFrame, vocab_size: int, min_df: float = 10,
                    col: str = "tokens", out: str = "tf"):
    """Count vectors for fits that need them. A vector's length is the caller's
    choice: ``vocab_size`` is the number of most frequent terms it holds."""
    model = CountVectorizer(inputCol=col, outputCol=out, vocabSize=vocab_size,
                            minDF=min_df).fit(tokens)
    return model.transform(tokens), model


def vocabulary(tokens: DataFrame, vocab_size: int | None = None, min_df: float = 10,
               doc: str = "doc_id", col: str = "tokens") -> DataFrame:
    """The CountVectorizer vocabulary as a DataFrame: ``term, df, tf, idf``.

    All terms in at least ``min_df`` documents (a fraction of the documents when
    below 1), or with ``vocab_size`` only the most frequent of them by total
    count (ties by term); idf = ln((m + 1) / (df + 1)) with m documents, as
    MLlib's IDF. Term statistics are grouped counts; m is a scalar subquery."""
    m = tokens.agg(F.count(F.lit(1)).cast("double")).scalar()
    keep = F.col("df") >= (F.lit(min_df) if min_df >= 1 else F.lit(min_df) * m)
    top = term_stats(tokens, doc, col).filter(keep)
    if vocab_size is not None:
        top = top.orderBy(F.col("tf").desc(), F.col("term")).limit(vocab_size)
    return top.withColumn("idf", F.log((m + 1.0) / (F.col("df") + 1.0)))


def vocabulary_table(tokens: DataFrame, vocab_size: int | None = None, min_df: float = 10,
                     doc: str = "doc_id") -> DataFrame:
    """Vocabulary terms with their document and total counts: ``term, df, tf``."""
    return vocabulary(tokens, vocab_size, min_df, doc).select("term", "df", "tf")


def tfidf(tokens: DataFrame, vocab_size: int, min_df: float = 10):
    """tokens -> tf -> tfidf (vectors), with the fitted CountVectorizer/IDF."""
    tf, cv = count_vectorize(tokens, vocab_size, min_df)
    idf_model = IDF(inputCol="tf", outputCol="tfidf").fit(tf)
    return idf_model.transform(tf), cv, idf_model


def idf_table(tokens: DataFrame, vocab_size: int | None = None, min_df: float = 10,
              doc: str = "doc_id", digits: int = 6) -> DataFrame:
    """``term, idf`` with idf = log((m + 1) / (df + 1))."""
    return vocabulary(tokens, vocab_size, min_df, doc).select(
        "term", F.round("idf", digits).alias("idf"))


def tfidf_terms(tokens: DataFrame, vocab_size: int | None = None, min_df: float = 10,
                doc: str = "doc_id", col: str = "tokens", digits: int = 6) -> DataFrame:
    """Long ``doc, term, tfidf`` table: per-document term counts
    (``doc_terms``) times the term's IDF; no vectors are built. The join with the
    vocabulary is left to adaptive execution, which measures it."""
    weights = vocabulary(tokens, vocab_size, min_df, doc, col).select("term", "idf")
    return doc_terms(tokens, doc, col).join(weights, "term").select(
        doc, "term", F.round(F.col("n") * F.col("idf"), digits).alias("tfidf"))


def lda_fit(tfidf_df: DataFrame, k: int = 10, max_iter: int = 100, seed: int = 12345):
    return LDA(k=k, maxIter=max_iter, featuresCol="tfidf", seed=seed).fit(tfidf_df)


def lda_topic_terms(model, cv_model, spark, n_terms: int = 5) -> DataFrame:
    """Top terms per topic: ``topic, rank, term, weight``."""
    topics = model.describeTopics(n_terms)
    vocab = spark.createDataFrame(list(enumerate(cv_model.vocabulary)), "idx int, term string")
    ex = topics.select("topic", F.posexplode(F.arrays_zip("termIndices", "termWeights"))
                       .alias("rank", "tw"))
    return (ex.select("topic", (F.col("rank") + 1).alias("rank"),
                      F.col("tw.termIndices").alias("idx"), F.col("tw.termWeights").alias("weight"))
            .join(F.broadcast(vocab), "idx").select("topic", "rank", "term", "weight"))
