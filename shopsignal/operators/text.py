"""Text and embedding features over user histories (TX1-TX10, J4).

Documents are users: a user's document is the multiset of tokens of one id
column over the user's history. Term statistics are aggregates over the log
-- no path strings, no driver-side matrices:

* term frequency: ``groupBy(user, token).count()`` (partial aggregate);
* document frequency: ``groupBy(token)`` over (user, token) rows;
* vocabulary (top-k by corpus frequency): a k-row TakeOrdered result,
  broadcast with a proven bound of k rows;
* L2 norm per user: a window over at most k rows per user.

The Spark ML forms (HashingTF, IDF, Word2Vec) run on per-chunk token arrays
built from ``history.user_paths``.
"""

from __future__ import annotations

import uuid

from pyspark.ml.feature import HashingTF, IDF, Word2Vec
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopsignal.operators.history import user_paths
from shopsignal.session import ensure_checkpoint_dir

# Word pattern of the vocabulary TF-IDF: maximal runs of two or more word
# characters (one-character tokens vanish, N8). Valid in Java regex and RE2.
# The stop words removed from prose, by language of the test documents.
STOP_WORDS = ["and", "the", "of", "to", "in", "und", "der", "die", "das", "le", "la", "les", "de", "et", "el", "los",
              "que", "y", "en"]
EVENTS_PER_PARTITION = 1_000_000
WORD2 = r"[\pL\pN_]{2,}"


def documents(tokens: DataFrame, user: str = "user_id") -> DataFrame:
    """The distinct documents of a token table (from its term-frequency aggregate)."""
    return term_frequencies(tokens, user).select(user).distinct()


def spark_tokens(log: DataFrame, col: str, user: str = "user_id") -> DataFrame:
    """TX1 on the log: the lower-cased id as the token (null -> 'nan', as in a path)."""
    return log.select(user, F.lower(F.coalesce(F.col(col).cast("string"), F.lit("nan"))).alias("token"))


def word_tokens(log: DataFrame, col: str, user: str = "user_id", pattern: str = WORD2,
                stop_words: list[str] | None = None) -> DataFrame:
    """Vocabulary-form tokenizer: lower-case, word runs of 2+ chars, stop words removed.

    ``explode_outer`` keeps one null-token row for a row without any word, so
    every document stays countable from the token table itself.
    """
    t = log.select(user, F.explode_outer(F.regexp_extract_all(F.lower(F.col(col).cast("string")),
                                                              F.lit(pattern), 0)).alias("token"))
    if stop_words:
        sw = t.sparkSession.createDataFrame([(w,) for w in stop_words], "token string")
        t = t.join(F.broadcast(sw), "token", "left_anti")  # null tokens never match: kept
    return t


def term_frequencies(tokens: DataFrame, user: str = "user_id") -> DataFrame:
    return tokens.groupBy(user, "token").agg(F.count(F.lit(1)).alias("tf"))


def tfidf_spark_relational(tokens: DataFrame, user: str = "user_id") -> DataFrame:
    """TX3 relational: tf * ln((n + 1) / (df + 1)) (Spark ML IDF), unnormalised."""
    tf = term_frequencies(tokens, user)
    n = tf.select(F.count_distinct(user)).scalar()  # from the aggregate, not another input pass
    df = tf.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    idf = df.select("token", F.ln((n + 1) / (F.col("df") + 1)).alias("idf"))
    return tf.join(idf, "token").withColumn("tfidf", F.col("tf") * F.col("idf"))


def top_vocabulary(tf: DataFrame, k: int = 100) -> DataFrame:
    """Top-k tokens by corpus term frequency (ties: token asc), with 0-based index in token order."""
    top = (tf.groupBy("token").agg(F.sum("tf").alias("ctf"))
           .orderBy(F.col("ctf").desc(), F.col("token").asc()).limit(k))
    # k rows: a single-task window is bounded by k
    return top.withColumn("vidx", (F.row_number().over(Window.orderBy("token")) - 1).cast("int"))


def tfidf_vocab(tokens: DataFrame, k: int = 100, user: str = "user_id",
                docs: DataFrame | None = None) -> DataFrame:
    """TX4: vocabulary TF-IDF -- smooth idf ln((1+n)/(1+df)) + 1, L2-normalised per user.

    Output long form (user, token, vidx, tfidf) for in-vocabulary tokens. The
    document count n comes from ``docs`` when given, else from the distinct
    users of the token table (null-token rows included, see ``word_tokens``),
    i.e. from the same term-frequency aggregate -- no second pass over the input.
    """
    tf_all = term_frequencies(tokens, user)
    tf = tf_all.where(F.col("token").isNotNull())
    vocab = top_vocabulary(tf, k)
    n = (docs.select(F.count(F.lit(1))) if docs is not None
         else tf_all.select(F.count_distinct(user))).scalar()
    vt = tf.join(F.broadcast(vocab.select("token", "vidx")), "token")
    df = vt.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    w = vt.join(F.broadcast(df), "token").withColumn(
        "raw", F.col("tf") * (F.ln((F.lit(1) + n) / (F.lit(1) + F.col("df"))) + 1))
    norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(user)))
    return w.select(user, "token", "vidx", (F.col("raw") / norm).alias("tfidf"))


def to_wide(long: DataFrame, users: DataFrame, width: int, prefix: str, idx: str = "vidx",
            value: str = "tfidf", user: str = "user_id") -> DataFrame:
    """TX6: long (user, idx, value) -> ``prefix0..prefix{width-1}``, zeros where absent."""
    piv = long.groupBy(user).pivot(idx, list(range(width))).agg(F.first(value))
    piv = piv.select(user, *[F.col(str(i)).alias(f"{prefix}{i}") for i in range(width)])
    out = users.join(piv, user, "left")
    return out.fillna(0.0, subset=[f"{prefix}{i}" for i in range(width)])


def hashed_tfidf(log: DataFrame, col: str = "seller_id", num_features: int = 100,
                 user: str = "user_id") -> DataFrame:
    """TX1-TX3 in ML form: HashingTF over each user's tokens, then Spark IDF.

    Term frequency does not depend on order, so no paths are built: counts
    per (user, token) are aggregated from the log, each distinct token is
    hashed once by the same ``HashingTF`` transformer (a one-token document
    per distinct token), and counts are summed per (user, bucket). Each user
    then holds at most ``num_features`` buckets, assembled into a vector with
    higher-order functions (no Python).

    Output: (user_id, tf, features) with vectors of ``num_features``.
    """
    toks = spark_tokens(log, col, user)
    tf = toks.groupBy(user, "token").agg(F.count(F.lit(1)).alias("n"))
    vocab = tf.select("token").distinct().withColumn("doc", F.array("token"))
    hashed = HashingTF(inputCol="doc", outputCol="h", numFeatures=num_features).transform(vocab)
    # a one-token document has exactly one non-zero bucket
    buckets = hashed.select("token", F.array_position(vector_to_array("h"), 1.0).cast("int").alias("b"))
    per_bucket = (tf.join(buckets, "token").groupBy(user, F.col("b") - 1)
                  .agg(F.sum("n").cast("double").alias("n")).withColumnRenamed("(b - 1)", "bucket"))
    dense = (per_bucket.groupBy(user)
             .agg(F.map_from_entries(F.collect_list(F.struct("bucket", "n"))).alias("m"))
             .select(user, array_to_vector(F.transform(F.sequence(F.lit(0), F.lit(num_features - 1)),
                                                       lambda i: F.coalesce(F.col("m")[i], F.lit(0.0))))
                     .alias("tf")))
    model = IDF(inputCol="tf", outputCol="features").fit(dense)
    return model.transform(dense).select(user, "tf", "features")


def mean_vectors(tokens: DataFrame, vectors: DataFrame, user: str = "user_id",
                 token: str = "token", key: str = "word", vec: str = "vector") -> DataFrame:
    """TX8/J4: mean of in-vocabulary token vectors per user (repeats counted).

    Repeats are counted first, so vectors are joined once per (user, token);
    the lookup is an equi-join on the token's own type (AQE broadcasts the
    vector table when its measured size allows) and the mean a partial
    aggregate weighted by the counts. Users without in-vocabulary tokens are
    absent here; callers left-join and fill zeros (N10).
    """
    n = tokens.groupBy(user, token).agg(F.count(F.lit(1)).cast("double").alias("_n"))
    j = n.join(vectors.withColumnRenamed(key, token), token)
    return j.groupBy(user).agg(Summarizer.mean(F.col(vec), F.col("_n")).alias("mean_vec"))


def embedding_table(spark_df: DataFrame, id_col: str = "vec_id", emb_col: str = "embedding") -> DataFrame:
    return spark_df.select(F.col(id_col).alias("word"), array_to_vector(F.col(emb_col)).alias("vector"))


def fit_word2vec(log: DataFrame, col: str = "seller_id", user: str = "user_id", vector_size: int = 100,
                 window: int = 5, min_count: int = 5, partitions: int | None = None, seed: int = 42,
                 max_iter: int = 1):
    """TX7: Word2Vec on the token sentences (user, chunk, n_events, sentence) of a path column.

    Without ``partitions`` there is one for every ``EVENTS_PER_PARTITION``
    events, and the reference's 4 at least. Spark keeps vocabulary and
    vectors on the driver: use it for columns with a bounded vocabulary
    (sellers, brands, categories), not for item ids.
    """
    paths = user_paths(log, user, columns={"p": col})
    ensure_checkpoint_dir(log.sparkSession)
    # the fit counts words, then reads the sentences, and callers score them: paths are built once
    sents = paths.select(user, "chunk", "n_events", F.split(F.col("p"), " ").alias("sentence")).checkpoint(eager=True)
    if partitions is None:
        partitions = max(4, -(-(sents.agg(F.sum("n_events")).first()[0] or 0) // EVENTS_PER_PARTITION))
    w2v = Word2Vec(inputCol="sentence", outputCol="w2v", vectorSize=vector_size, windowSize=window,
                   minCount=min_count, numPartitions=partitions, seed=seed, maxIter=max_iter)
    return w2v.fit(sents), sents


def w2v_table(model) -> DataFrame:
    """(word, vector) of a Word2Vec model as a table in the shared folder.

    ``getVectors`` is a local relation: a join with it keeps all vectors as rows on the driver, besides the model.
    """
    spark = SparkSession.getActiveSession()
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/w2v-{uuid.uuid4().hex}"
    model.save(path)
    saved = spark.read.schema("word string, vector array<float>").parquet(f"{path}/data")
    return saved.select("word", array_to_vector(F.col("vector").cast("array<double>")).alias("vector"))


def w2v_user_vectors(model, sents: DataFrame, user: str = "user_id") -> DataFrame:
    """TX9: one vector per user, the mean over all tokens (out-of-vocabulary ones count as zero).

    The model's transform gives such a mean for each chunk of a history; a
    user's vector is their mean weighted by the chunks' numbers of events.
    """
    t = model.transform(sents)
    return t.groupBy(user).agg(Summarizer.mean(F.col("w2v"), F.col("n_events").cast("double")).alias("w2v"),
                               F.sum("n_events").alias("n_events"))


def vector_columns(df: DataFrame, vec: str, prefix: str, width: int) -> list[Column]:
    arr = vector_to_array(F.col(vec))
    return [arr[i].alias(f"{prefix}{i}") for i in range(width)]
