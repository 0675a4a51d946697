"""Registered queries: TF-IDF (relational and ML forms), embeddings, Word2Vec."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from shopsignal.operators import text as tx
from shopsignal.operators import skipgram
from shopsignal.plans.registry import register, rounded
from shopsignal.sources import fixtures as fx
from shopsignal.sources.tables import read_table

W = fx.with_fixtures
VOCAB_K = 100
EMB_DIM = 64          # width of the `embeddings` test table
W2V_DIM = 100         # reference embedding width

TK_SPARK = "tk AS (SELECT user_id, lower(COALESCE(CAST(seller_id AS VARCHAR), 'nan')) AS token FROM user_log)"


def _tfidf_spark(spark, sf):
    return tx.tfidf_spark_relational(tx.spark_tokens(fx.user_log(spark, sf), "seller_id"))


@register("tfidf_spark", sql=W(
    "SELECT tf.user_id, tf.token, tf.tf, ROUND(tf.tf * ln((n + 1) / (df + 1)), 6) AS tfidf "
    "FROM tf JOIN dfq ON tf.token = dfq.token, nd",
    TK_SPARK + """,
tf AS (SELECT user_id, token, count(*) AS tf FROM tk GROUP BY user_id, token),
nd AS (SELECT count(DISTINCT user_id) AS n FROM tk),
dfq AS (SELECT token, count(*) AS df FROM tf GROUP BY token)"""))
def tfidf_spark(spark, sf):
    return rounded(_tfidf_spark(spark, sf).select("user_id", "token", "tf", "tfidf"))


def _vocab_ctes(col="seller_id", k=VOCAB_K):
    return f"""tkv AS (SELECT user_id, unnest(regexp_extract_all(lower(CAST({col} AS VARCHAR)), '{tx.WORD2}')) AS token
        FROM user_log),
tfv AS (SELECT user_id, token, count(*) AS tf FROM tkv GROUP BY user_id, token),
voc AS (SELECT token, CAST(row_number() OVER (ORDER BY token) - 1 AS INT) AS vidx
        FROM (SELECT token, sum(tf) AS ctf FROM tfv GROUP BY token ORDER BY ctf DESC, token LIMIT {k})),
ndv AS (SELECT count(DISTINCT user_id) AS n FROM user_log),
vt AS (SELECT tfv.*, voc.vidx FROM tfv JOIN voc ON tfv.token = voc.token),
dfv AS (SELECT token, count(*) AS df FROM vt GROUP BY token),
wv AS (SELECT vt.user_id, vt.token, vt.vidx, tf * (ln((1 + n) / (1 + df)) + 1) AS raw
       FROM vt JOIN dfv ON vt.token = dfv.token, ndv),
tfidf AS (SELECT user_id, token, vidx, raw / sqrt(sum(raw * raw) OVER (PARTITION BY user_id)) AS tfidf FROM wv)"""


def _tfidf_vocab(spark, sf, col="seller_id"):
    toks = tx.word_tokens(fx.user_log(spark, sf), col)
    return tx.tfidf_vocab(toks, VOCAB_K), tx.documents(toks)


@register("tfidf_topvocab", sql=W("SELECT user_id, token, vidx, ROUND(tfidf, 6) AS tfidf FROM tfidf",
                                  _vocab_ctes()))
def tfidf_topvocab(spark, sf):
    return rounded(_tfidf_vocab(spark, sf)[0])


@register("tfidf_wide", sql=W(
    "SELECT u.user_id, " + ", ".join(f"ROUND(COALESCE(p.t{i}, 0.0), 6) AS tfidf_{i}" for i in range(VOCAB_K))
    + " FROM (SELECT DISTINCT user_id FROM user_log) u LEFT JOIN (SELECT user_id, "
    + ", ".join(f"max(CASE WHEN vidx = {i} THEN tfidf END) AS t{i}" for i in range(VOCAB_K))
    + " FROM tfidf GROUP BY user_id) p ON u.user_id = p.user_id", _vocab_ctes()))
def tfidf_wide(spark, sf):
    long, docs = _tfidf_vocab(spark, sf)
    return rounded(tx.to_wide(long, docs, VOCAB_K, "tfidf_"))


MULTI = {"seller": "seller_id", "cat": "cat_id", "brand": "brand_id"}


def _multi_sql():
    parts = []
    for name, col in MULTI.items():
        ctes = _vocab_ctes(col).replace("tkv", f"tkv_{name}").replace("tfv", f"tfv_{name}") \
            .replace("voc", f"voc_{name}").replace("ndv", f"ndv_{name}").replace("vt", f"vt_{name}") \
            .replace("dfv", f"dfv_{name}").replace("wv", f"wv_{name}").replace("tfidf AS", f"tfidf_{name} AS")
        parts.append((name, ctes))
    body = " UNION ALL ".join(
        f"SELECT '{n}' AS col, user_id, token, vidx, ROUND(tfidf, 6) AS tfidf FROM tfidf_{n}" for n, _ in parts)
    return W(body, ",\n".join(c for _, c in parts))


@register("tfidf_multi", sql=_multi_sql())
def tfidf_multi(spark, sf):
    """TX5: one vocabulary TF-IDF block per path column, side by side (long form with `col`)."""
    log = fx.user_log(spark, sf)
    out = None
    for name, col in MULTI.items():
        b = tx.tfidf_vocab(tx.word_tokens(log, col), VOCAB_K).withColumn("col", F.lit(name))
        out = b if out is None else out.unionByName(b)
    return rounded(out)


# ---------------------------------------------------------------- embeddings (TX8 on the `embeddings` table)

def _emb_sql():
    avgs = ", ".join(f"avg(embedding[{i + 1}]) AS e{i}" for i in range(EMB_DIM))
    cols = ", ".join(f"ROUND(COALESCE(m.e{i}, 0.0), 6) AS embedding_{i}" for i in range(EMB_DIM))
    return W(f"SELECT u.user_id, {cols} FROM (SELECT DISTINCT user_id FROM user_log) u LEFT JOIN m "
             "ON u.user_id = m.user_id",
             "ej AS (SELECT l.user_id, e.embedding FROM user_log l JOIN embeddings e "
             "ON CAST(l.item_id AS VARCHAR) = CAST(e.vec_id AS VARCHAR)),\n"
             f"m AS (SELECT user_id, {avgs} FROM ej GROUP BY user_id)")


@register("mean_embedding", sql=_emb_sql())
def mean_embedding(spark, sf):
    log = fx.user_log(spark, sf)
    toks = log.select("user_id", F.col("item_id").alias("token"))
    vecs = tx.embedding_table(read_table(spark, sf, "embeddings", "vec_id", "embedding"))
    m = tx.mean_vectors(toks, vecs)
    wide = m.select("user_id", *tx.vector_columns(m, "mean_vec", "embedding_", EMB_DIM))
    users = log.select("user_id").distinct()
    out = users.join(wide, "user_id", "left").fillna(0.0)
    return rounded(out)


@register("features_by_key", sql=W(
    "SELECT p.user_id, p.merchant_id, CAST(p.label AS DOUBLE) AS label, "
    "ROUND(COALESCE(t.tfidf, 0.0), 6) AS tfidf_top, CAST(COALESCE(s.user_cnt, -1) AS BIGINT) AS user_cnt "
    "FROM all_pairs p LEFT JOIN (SELECT user_id, max(tfidf) AS tfidf FROM tfidf GROUP BY user_id) t "
    "ON p.user_id = t.user_id LEFT JOIN (SELECT user_id, count(*) AS user_cnt FROM user_log GROUP BY user_id) s "
    "ON p.user_id = s.user_id", _vocab_ctes()))
def features_by_key(spark, sf):
    """Feature blocks from different frames combined by key, never by position."""
    long, _ = _tfidf_vocab(spark, sf)
    t = long.groupBy("user_id").agg(F.max("tfidf").alias("tfidf_top"))
    s = fx.user_log(spark, sf).groupBy("user_id").agg(F.count(F.lit(1)).alias("user_cnt"))
    p = fx.all_pairs(spark, sf)
    out = (p.join(t, "user_id", "left").join(s, "user_id", "left")
           .select("user_id", "merchant_id", F.col("label").cast("double").alias("label"),
                   F.coalesce("tfidf_top", F.lit(0.0)).alias("tfidf_top"),
                   F.coalesce("user_cnt", F.lit(-1)).cast("long").alias("user_cnt")))
    return rounded(out)


# ---------------------------------------------------------------- ML forms (property-checked)

# Spark's HashingTF: murmur3 x86 32-bit, seed 42, of the token's UTF-8 bytes. For ASCII ids the
# recurrence is a fold over 4-byte words, then the remaining bytes one by one in one word.

def _mul32(a: str, c: int) -> str:
    return f"((({a}) * {c}::HUGEINT) % 4294967296)::UBIGINT"


def _rotl32(a: str, r: int) -> str:
    return f"(((({a})::HUGEINT * {1 << r}) % 4294967296)::UBIGINT | (({a}) >> {32 - r}))"


def _murmur_ctes(max_len: int = 12) -> str:
    """hash32(token, h): one CTE per word step over the distinct tokens (ids of at most ``max_len`` bytes)."""
    steps = ["mm0 AS (SELECT token, length(token)::UBIGINT AS n, 42::UBIGINT AS h FROM (SELECT DISTINCT token FROM tk))"]
    byte = lambda i: f"(ascii(substr(token, {i}, 1))::UBIGINT)"
    for w in range(max_len // 4):
        i = 4 * w + 1
        word = f"({byte(i)} + {byte(i + 1)} * 256 + {byte(i + 2)} * 65536 + {byte(i + 3)} * 16777216)"
        k = _mul32(_rotl32(_mul32(word, 0xCC9E2D51), 15), 0x1B873593)
        steps.append(f"mk{w} AS (SELECT token, n, h, CASE WHEN n >= {i + 3} THEN {k} END AS k FROM mm{w})")
        steps.append(f"mr{w} AS (SELECT token, n, h, k, {_rotl32('xor(h, k)', 13)} AS r FROM mk{w})")
        steps.append(f"mm{w + 1} AS (SELECT token, n, CASE WHEN k IS NULL THEN h ELSE ((r::HUGEINT * 5 + 3864292196) % 4294967296)"
                     f"::UBIGINT END AS h FROM mr{w})")
    last = max_len // 4
    tail = (f"(CASE WHEN n % 4 >= 1 THEN ascii(substr(token, CAST(n - n % 4 + 1 AS INT), 1)) ELSE 0 END"
            f" + CASE WHEN n % 4 >= 2 THEN ascii(substr(token, CAST(n - n % 4 + 2 AS INT), 1)) * 256 ELSE 0 END"
            f" + CASE WHEN n % 4 = 3 THEN ascii(substr(token, CAST(n - n % 4 + 3 AS INT), 1)) * 65536 ELSE 0 END)::UBIGINT")
    k = _mul32(_rotl32(_mul32(tail, 0xCC9E2D51), 15), 0x1B873593)
    steps += [f"mt AS (SELECT token, xor(xor(h, CASE WHEN n % 4 > 0 THEN {k} ELSE 0 END), n) AS h FROM mm{last})",
              f"f1 AS (SELECT token, {_mul32('xor(h, h >> 16)', 0x85EBCA6B)} AS h FROM mt)",
              f"f2 AS (SELECT token, {_mul32('xor(h, h >> 13)', 0xC2B2AE35)} AS h FROM f1)",
              "f3 AS (SELECT token, xor(h, h >> 16)::BIGINT AS h FROM f2)",
              "bk AS (SELECT token, CASE WHEN h >= 2147483648 THEN ((h - 4294967296) % 100 + 100) % 100 ELSE h % 100 END AS bucket"
              " FROM f3)"]
    return ",\n".join(steps)


@register("hashing_tf", sql=W(
    "SELECT user_id, CAST(bucket AS INT) AS bucket, tf, ROUND(tf * ln((n + 1) / (df + 1)), 6) AS tfidf FROM ub "
    "JOIN (SELECT bucket, count(*) AS df FROM ub GROUP BY bucket) USING (bucket), "
    "(SELECT count(DISTINCT user_id) AS n FROM tk) WHERE tf * ln((n + 1) / (df + 1)) <> 0",
    TK_SPARK + ",\n" + _murmur_ctes() + """,
ub AS (SELECT user_id, bucket, CAST(count(*) AS DOUBLE) AS tf FROM tk JOIN bk USING (token) GROUP BY user_id, bucket)"""))
def hashing_tf(spark, sf):
    """TX2/TX3: HashingTF(100) + Spark IDF; long form of non-zero buckets."""
    h = tx.hashed_tfidf(fx.user_log(spark, sf), "seller_id", 100)
    z = h.select("user_id", F.posexplode(vector_to_array("features")).alias("bucket", "tfidf"),
                 vector_to_array("tf").alias("tfa"))
    return rounded(z.where(F.col("tfidf") != 0).select("user_id", "bucket", F.col("tfa")[F.col("bucket")].alias("tf"),
                                                       "tfidf"))


def _w2v(spark, sf):
    log = fx.user_log(spark, sf)
    model, sents = tx.fit_word2vec(log, "seller_id")
    return log, model, sents


@register("w2v_vectors")
def w2v_vectors(spark, sf):
    """TX7/TX10: Word2Vec vocabulary vectors (word, vector)."""
    _, model, _ = _w2v(spark, sf)
    return model.getVectors().select("word", vector_to_array("vector").alias("vector"))


@register("w2v_mean")
def w2v_mean(spark, sf):
    """TX8 with trained vectors: in-vocabulary mean per user, zeros when none."""
    log, model, _ = _w2v(spark, sf)
    toks = log.select("user_id", F.col("seller_id").cast("string").alias("token"))
    # merged, not broadcast: the size of the vectors' file says little about that of their rows on the driver
    m = tx.mean_vectors(toks, tx.w2v_table(model).hint("merge"))
    wide = m.select("user_id", *tx.vector_columns(m, "mean_vec", "embedding_", W2V_DIM))
    return log.select("user_id").distinct().join(wide, "user_id", "left").fillna(0.0)


@register("w2v_transform")
def w2v_transform(spark, sf):
    """TX9: Word2VecModel.transform (averages over all tokens, out-of-vocabulary included), one row per user."""
    _, model, sents = _w2v(spark, sf)
    return tx.w2v_user_vectors(model, sents).select("user_id", "n_events", vector_to_array("w2v").alias("w2v"))


@register("w2v_transform_rows", sql=W("SELECT user_id, count(*) AS n_events, 100 AS width FROM user_log GROUP BY user_id"))
def w2v_transform_rows(spark, sf):
    """Companion of ``w2v_transform``: its rows, event counts and vector widths, checked by SQL."""
    return w2v_transform(spark, sf).select("user_id", "n_events", F.size("w2v").alias("width"))


@register("w2v_vocabulary", sql=W(
    "SELECT CAST(seller_id AS VARCHAR) AS word, 100 AS width FROM user_log GROUP BY seller_id HAVING count(*) >= 5"))
def w2v_vocabulary(spark, sf):
    """Companion of ``w2v_vectors``: the vocabulary is every seller with 5 events or more."""
    return w2v_vectors(spark, sf).select("word", F.size("vector").alias("width"))


# ---------------------------------------------------------------- the same operators on natural prose

STOP_SQL = ", ".join(f"'{w}'" for w in tx.STOP_WORDS)


@register("doc_tfidf_topvocab", sql=(
    f"""WITH tkv AS (SELECT * FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{tx.WORD2}')) AS token
        FROM documents) WHERE token NOT IN ({STOP_SQL})),
tfv AS (SELECT doc_id, token, count(*) AS tf FROM tkv GROUP BY doc_id, token),
voc AS (SELECT token, CAST(row_number() OVER (ORDER BY token) - 1 AS INT) AS vidx
        FROM (SELECT token, sum(tf) AS ctf FROM tfv GROUP BY token ORDER BY ctf DESC, token LIMIT {VOCAB_K})),
ndv AS (SELECT count(*) AS n FROM documents),
vt AS (SELECT tfv.*, voc.vidx FROM tfv JOIN voc ON tfv.token = voc.token),
dfv AS (SELECT token, count(*) AS df FROM vt GROUP BY token),
wv AS (SELECT vt.doc_id, vt.token, vt.vidx, tf * (ln((1 + n) / (1 + df)) + 1) AS raw
       FROM vt JOIN dfv ON vt.token = dfv.token, ndv)
SELECT doc_id, token, vidx, ROUND(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) AS tfidf FROM wv"""))
def doc_tfidf_topvocab(spark, sf):
    """TX4 over whole document texts without stop words (every document counts in n)."""
    docs = read_table(spark, sf, "documents", "doc_id", "text")
    toks = tx.word_tokens(docs, "text", user="doc_id", stop_words=tx.STOP_WORDS)
    # a document of stop words alone still counts in n, so n comes from the documents
    return rounded(tx.tfidf_vocab(toks, VOCAB_K, user="doc_id", docs=docs))


@register("skipgram_items")
def skipgram_items(spark, sf):
    """TX7 for item ids: vectors from block-partitioned skip-gram; (token, freq, vector)."""
    return skipgram.fit(fx.user_log(spark, sf), "item_id", dim=32, epochs=2)[0]


@register("skipgram_vocabulary", sql=fx.with_fixtures(
    "SELECT CAST(item_id AS VARCHAR) AS token, count(*)::DOUBLE AS freq FROM user_log WHERE item_id IS NOT NULL GROUP BY item_id HAVING count(*) >= 5"))
def skipgram_vocabulary(spark, sf):
    """Companion of ``skipgram_items``: the tokens that get a vector."""
    return skipgram_items(spark, sf).select("token", "freq")
