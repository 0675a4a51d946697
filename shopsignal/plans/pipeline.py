"""End-to-end: raw tables -> feature table -> stacking -> selection -> ensemble -> submission.

Sinks (IO4-IO7) write with Spark writers: no row-index column (D12), no
driver-side frames.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsignal.functions.stats import sanitize
from shopsignal.session import ensure_checkpoint_dir
from shopsignal.operators import features as feat
from shopsignal.operators import text as tx
from shopsignal.operators.select import fit_importance_model, importance_table, select_features, top_k_features
from shopsignal.operators.ensemble import KEYS, StackedBagging, append_columns, oof_stacking
from shopsignal.sources import fixtures as fx
from shopsignal.sources.tables import read_table

EXCLUDE = {"label", "prob", "user_id", "merchant_id"}  # D7: ids are not features
# statistics that carry the -1 "no history" default
MISSING_MARKED = {"user_cnt", "seller_nunique", "cat_nunique", "brand_nunique", "item_nunique",
                  "time_stamp_nunique", "action_type_nunique", "time_stamp_max", "time_stamp_min",
                  "time_stamp_std", "seller_most_cnt_1", "cat_most_cnt_1", "brand_most_cnt_1",
                  "item_most_cnt_1", "action_type_most_cnt_1", "user_cnt_0", "cart_cnt", "buy_cnt",
                  "fav_seller_item_nunique"}
NUMERIC = {"bigint", "int", "double", "float", "smallint", "tinyint"}


def feature_table(spark: SparkSession, sf: str, text: bool = False, embedding: bool = False) -> DataFrame:
    """User features per pair, optionally with the vocabulary TF-IDF block and the embedding block
    (TX8: mean vector of a user's items from the ``embeddings`` table), joined by key (J3)."""
    lo = fx.shared_line_orders(spark, sf)  # pairs and log both need lineitem x orders: join once
    log = fx.user_log(spark, sf, lo)
    df = feat.user_features(fx.all_pairs(spark, sf, lo), fx.user_info(spark, sf), log, tasks=feat.task_count(log))
    if text:
        toks = tx.word_tokens(log, "seller_id")
        wide = tx.to_wide(tx.tfidf_vocab(toks, 100), tx.documents(toks), 100, "tfidf_")
        df = df.join(wide, "user_id", "left").fillna(0.0, subset=[f"tfidf_{i}" for i in range(100)])
    if embedding:
        vecs = tx.embedding_table(read_table(spark, sf, "embeddings", "vec_id", "embedding"))
        first = vecs.select(F.size(vector_to_array("vector")).alias("d")).first()
        width = first["d"] if first else 0
        m = tx.mean_vectors(log.select("user_id", F.col("item_id").alias("token")), vecs)
        m = m.select("user_id", *tx.vector_columns(m, "mean_vec", "embedding_", width))
        df = df.join(m, "user_id", "left").fillna(0.0, subset=[f"embedding_{i}" for i in range(width)])
    return df


def project(df: DataFrame, include: list[str] | None = None, exclude=tuple(EXCLUDE)) -> DataFrame:
    """PF1 / PF2: the listed columns in the given order, or all numeric ones but the excluded."""
    return df.select(*(include if include is not None else [c for c in feature_columns(df) if c not in exclude]))


def feature_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in NUMERIC and c not in EXCLUDE]


def assemble(df: DataFrame, cols: list[str], out: str = "features", missing_value: float | None = None):
    """PF1 + PF9: project the feature columns, NaN/inf/null -> 0, one vector column.

    With ``missing_value`` a ``has_history`` indicator is added (the -1
    defaults mark users without history). The marker itself becomes a median
    inside each fold, from its training rows (``missing_markers``).
    """
    clean = df.select(*KEYS, "label", *[F.col(c).cast("double").alias(c) for c in cols])
    if missing_value is not None:
        clean = clean.withColumn("has_history", (F.col("user_cnt") != missing_value).cast("double"))
        cols = cols + ["has_history"]
    clean = clean.select(*KEYS, "label", *[sanitize(F.col(c)).alias(c) for c in cols])
    return VectorAssembler(inputCols=cols, outputCol=out).transform(clean).select(*KEYS, "label", out)


def missing_markers(cols: list[str], missing_value: float = -1.0) -> tuple[float, tuple[int, ...]]:
    """M6: the marker that the reference's booster reads as missing, and the features that carry it."""
    return missing_value, tuple(i for i, c in enumerate(cols) if c in MISSING_MARKED)


def assert_keys_not_null(df: DataFrame, keys=tuple(KEYS)) -> DataFrame:
    """Join keys are declared non-null (Spark's = never matches null with null); one aggregate pass."""
    bad = df.agg(F.count_if(F.greatest(*[F.col(k).isNull() for k in keys]))).first()[0]
    if bad:
        raise ValueError(f"{bad} rows with a null key among {list(keys)}")
    return df


def model_frames(spark: SparkSession, sf: str, text: bool = False, missing_value: float | None = None,
                 embedding: bool = False):
    """(train, test, feature names): labelled and unlabelled rows with a feature vector."""
    ft = feature_table(spark, sf, text, embedding)
    cols = feature_columns(ft)
    # Fold assignment, range-bound sampling and every fit read this frame; one
    # checkpoint in the shared folder computes the feature table once and cuts
    # its lineage.
    ensure_checkpoint_dir(spark)
    a = assemble(ft, cols, missing_value=missing_value).checkpoint(eager=True)
    if missing_value is not None:
        cols = cols + ["has_history"]
    train = a.where(F.col("label").isNotNull()).withColumn("label", F.col("label").cast("double"))
    test = a.where(F.col("label").isNull())
    return train, test, cols


def run(spark: SparkSession, sf: str, preset: str = "reference", learners=("lgb", "xgb"), k: int = 5,
        top_k: int = 20, out_dir: str | None = None, text: bool = False,
        missing_value: float | None = -1.0, embedding: bool = True) -> DataFrame:
    """The reference's modelling path with corrected defects; returns (user_id, merchant_id, prob)."""
    assert_keys_not_null(fx.all_pairs(spark, sf))
    train, test, cols = model_frames(spark, sf, text, missing_value, embedding)
    marker = {"xgb": missing_markers(cols, missing_value)} if missing_value is not None else None
    tm, sm, _ = oof_stacking(train, test, list(learners), k=k, preset=preset, missing=marker)
    tr2 = append_columns(train.join(tm.drop("label"), KEYS), list(learners))
    te2 = append_columns(test.join(sm, KEYS), list(learners))
    imp_model, _ = fit_importance_model(tr2, preset)
    idx = top_k_features(importance_table(imp_model, cols + list(learners)), top_k)
    tr3 = select_features(tr2, idx).drop("features").withColumnRenamed("features_sel", "features")
    te3 = select_features(te2, idx).drop("features").withColumnRenamed("features_sel", "features")
    model = StackedBagging(stacking_num=2, bagging_num=1, bagging_test_size=0.33, preset=preset, parallelism=2).fit(tr3)
    sub = model.transform(te3).select(*KEYS, "prob")
    if out_dir:
        write_table(sub, out_dir, fmt="csv")
    return sub


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """IO4/IO5/IO6: header CSV or parquet, no index column."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "text":
        df.select(F.concat_ws(",", *[F.col(c).cast("string") for c in df.columns]).alias("value")).write \
            .mode(mode).text(path)
    else:
        w.parquet(path)


def read_csv(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """IO1/IO2: CSV scan with header; explicit schema when given, else inferred."""
    r = spark.read.option("header", True)
    return r.schema(schema).csv(path) if schema is not None else r.option("inferSchema", True).csv(path)


def drop_unnamed(df: DataFrame) -> DataFrame:
    """PF3: drop columns whose name starts with 'Unnamed' (a pandas index read back)."""
    return df.select(*[c for c in df.columns if not c.startswith("Unnamed")])


def main(argv=None):
    """python -m shopsignal.plans.pipeline --sf DIR --out DIR [--preset small|reference] [--text]"""
    import argparse
    from shopsignal.session import build_session
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--preset", default="reference")
    ap.add_argument("--text", action="store_true", help="add the vocabulary TF-IDF block to the features")
    a = ap.parse_args(argv)
    spark = SparkSession.getActiveSession() or build_session(master=None)
    run(spark, a.sf, preset=a.preset, out_dir=a.out, text=a.text)


if __name__ == "__main__":
    main()
