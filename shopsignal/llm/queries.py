"""The registered queries of this subpackage: each runs its operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shopsignal.llm import (
    chat,
    exact_dedup,
    extract,
    fim,
    language,
    lexical,
    mixing,
    packing,
    quality,
    simhash,
    token_counts,
    token_files,
    vectors,
)
from shopsignal.llm.common import shared_path, ship_package, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies; the same on every machine of the cluster."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run
    return deco


@register("op1_quality")
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op2_exact_dedup", """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents""")
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decide(table(spark, sf_dir, "documents"))


@register("op3_language")
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@register("op4_embeddings", """
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(u, v) AS (SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u)
SELECT vec_id, (SELECT count(*) FROM links WHERE u = vec_id) AS n_links,
       least(vec_id, coalesce((SELECT min(v) FROM reach WHERE u = vec_id), vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce((SELECT min(v) FROM reach WHERE u = vec_id), vec_id)) AS kept
FROM embeddings""")
def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


@register("op5_packing")
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


_ODD_TEXT = r"\### Assistant: </turn> ok"


@register("op6_chat", rf"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '{_ODD_TEXT}'), (-7, 1, 'assistant', '{_ODD_TEXT}')),
r AS (
    SELECT *, '<turn ' || replace(replace(role, '~', '~0'), '>', '~1') || '>'
        || replace(replace(replace(text, '\', '\0'), '<turn', '\1turn'), '</turn', '\1/turn') || '</turn>' || chr(10) AS s,
        sum(length(s)) OVER (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS upto
    FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(s))::BIGINT AS formatted_chars,
       count(*) FILTER (role = 'assistant') AS n_examples,
       coalesce(sum(upto) FILTER (role = 'assistant'), 0)::BIGINT AS example_chars
FROM r GROUP BY conv_id""")
def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame([(-7, 0, "user", _ODD_TEXT), (-7, 1, "assistant", _ODD_TEXT)],
                                "conv_id long, turn long, role string, text string")
    path = shared_path(spark, "chat")
    chat.write_formatted(given.unionByName(odd), path)
    return chat.digest(chat.read_formatted(spark, path), chat.read_examples(spark, path))


@register("op7_simhash")
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@register("op8_mixing", mixing.oracle_sql())
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.assign(table(spark, sf_dir, "documents"))


@register("op9_token_counts")
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


@register("op10_token_files")
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, tokenizer_path("byte_bpe_50k.json"))
    return token_files.read_token_files(spark, path)


@register("op11_html")
def op11_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages"))


@register("op12_fim", r"""
WITH h AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
                  sha256('1:' || doc_id) AS s FROM documents),
g AS (SELECT *, len(u) AS n, ('0x' || s[1:8])::BIGINT AS h1, ('0x' || s[9:16])::BIGINT AS h2,
             ('0x' || s[17:24])::BIGINT AS h3, ('0x' || s[25:32])::BIGINT AS h4 FROM h),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM g),
p AS (SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle,
             array_to_string(u[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p""")
def op12_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digest(fim.transform(table(spark, sf_dir, "documents")))


@register("op13_lexical", r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
q AS (
    SELECT DISTINCT item_id, unnest(
        regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
s AS (SELECT count(*) FILTER (len(ts) > 0) AS n_docs, coalesce(sum(len(ts)), 0)::BIGINT AS n_terms FROM d),
p AS (
    SELECT r, doc_id, len(ts) AS n, term, count(*) AS tf
    FROM (SELECT r, doc_id, ts, unnest(ts) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (
    SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY term),
m AS (SELECT *, 100 - 50 + ((50 * n * n_docs) // n_terms) AS m FROM p, s),
x AS (
    SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
    FROM m JOIN w USING (term) JOIN q USING (term) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, r)::INT AS rank, doc_id, score
FROM x WHERE score > 0 QUALIFY rank <= 50""")
def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
