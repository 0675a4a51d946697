"""Evaluation metrics as aggregates over a (label, score, prediction[, fold]) table.

M11/M26 log loss, M14 accuracy, A13 fold summary, M15 macro F1, M16 R^2,
M17 confusion matrix, M18 classification report, M19 AUC (mid-ranks),
M12 population z-score, M23 variance filter, A11 ensemble mean, M8 class
statistics. Everything is a grouped aggregate; AUC ranks distinct scores
with the skew-safe prefix sum rather than a global window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsignal.plans.ranking import with_prefix_sum

EPS = 1e-15


def log_loss_expr(y: Column, p: Column, eps: float = EPS) -> Column:
    pc = F.least(F.greatest(p, F.lit(eps)), F.lit(1 - eps))
    return -(y * F.ln(pc) + (1 - y) * F.ln(1 - pc))


def log_loss(df: DataFrame, label="label", score="score", by: list[str] | None = None) -> DataFrame:
    e = log_loss_expr(F.col(label).cast("double"), F.col(score))
    return (df.groupBy(*by) if by else df.groupBy()).agg(F.avg(e).alias("log_loss"))


def accuracy(df: DataFrame, label="label", pred="prediction", by: list[str] | None = None) -> DataFrame:
    a = F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy")
    return (df.groupBy(*by) if by else df.groupBy()).agg(a)


def summary(scores: DataFrame, col: str) -> DataFrame:
    """Mean and population std of per-fold scores."""
    return scores.agg(F.avg(col).alias("mean"), F.stddev_pop(col).alias("std"))


def _class_counts(df, label, pred, by):
    """tp, fp, fn, support per (by..., class) for the classes seen in label or prediction."""
    keys = list(by or [])
    lab = df.select(*keys, F.col(label).cast("int").alias("cls"), F.lit(1).alias("is_lab"),
                    (F.col(label) == F.col(pred)).cast("int").alias("hit"), F.lit(0).alias("is_pred"))
    prd = df.select(*keys, F.col(pred).cast("int").alias("cls"), F.lit(0).alias("is_lab"),
                    F.lit(0).alias("hit"), F.lit(1).alias("is_pred"))
    u = lab.unionByName(prd)
    return u.groupBy(*keys, "cls").agg(
        F.sum("hit").alias("tp"), F.sum("is_lab").alias("support"), F.sum("is_pred").alias("npred"))


def _prf(c: DataFrame) -> DataFrame:
    prec = F.when(F.col("npred") > 0, F.col("tp") / F.col("npred")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    f1 = F.when(F.col("npred") + F.col("support") > 0,
                2 * F.col("tp") / (F.col("npred") + F.col("support"))).otherwise(0.0)
    return c.withColumn("precision", prec).withColumn("recall", rec).withColumn("f1", f1)


def f1_macro(df: DataFrame, label="label", pred="prediction", by: list[str] | None = None) -> DataFrame:
    """Unweighted mean of per-class F1 (Spark's evaluator "f1" is weighted)."""
    c = _prf(_class_counts(df, label, pred, by))
    return (c.groupBy(*by) if by else c.groupBy()).agg(F.avg("f1").alias("f1_macro"))


def classification_report(df: DataFrame, label="label", pred="prediction",
                          names: dict[int, str] | None = None) -> DataFrame:
    """Precision, recall, f1, support per class plus macro and weighted averages."""
    c = _prf(_class_counts(df, label, pred, None))
    cname = F.col("cls").cast("string")
    for k, v in (names or {}).items():
        cname = F.when(F.col("cls") == k, F.lit(v)).otherwise(cname)
    per = c.select(cname.alias("class"), "precision", "recall", "f1", F.col("support").cast("long"))
    macro = per.agg(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                    F.sum("support").cast("long").alias("support"))
    tot = F.sum("support")
    weighted = per.agg(F.lit("weighted avg").alias("class"),
                       (F.sum(F.col("precision") * F.col("support")) / tot).alias("precision"),
                       (F.sum(F.col("recall") * F.col("support")) / tot).alias("recall"),
                       (F.sum(F.col("f1") * F.col("support")) / tot).alias("f1"),
                       tot.cast("long").alias("support"))
    return per.unionByName(macro).unionByName(weighted)


def confusion_matrix(df: DataFrame, label="label", pred="prediction", normalize: bool = True) -> DataFrame:
    """(label, prediction, n[, row_share]) long form."""
    c = df.groupBy(F.col(label).cast("int").alias("label"), F.col(pred).cast("int").alias("prediction")) \
        .agg(F.count(F.lit(1)).alias("n"))
    if not normalize:
        return c
    rows = c.groupBy("label").agg(F.sum("n").alias("_row"))
    return c.join(rows, "label").withColumn("row_share", F.col("n") / F.col("_row")).drop("_row")


def r2_score(df: DataFrame, label="label", score="score") -> DataFrame:
    """1 - SSR / SST."""
    y = F.col(label).cast("double")
    mean_y = df.select(F.avg(y)).scalar()
    # constant labels (SST = 0) give NULL rather than a division error under ANSI mode
    return df.agg((1 - F.try_divide(F.sum((y - F.col(score)) ** 2), F.sum((y - mean_y) ** 2))).alias("r2"))


def auc(df: DataFrame, label="label", score="score") -> DataFrame:
    """ROC AUC with ties counted one half (Mann-Whitney with mid-ranks)."""
    y = F.col(label).cast("int")
    d = df.groupBy(F.col(score).alias("s")).agg(F.sum(y).alias("npos"), F.sum(1 - y).alias("nneg"))
    c = with_prefix_sum(d, [F.col("s").asc()], "nneg", "_negle", inclusive=True)
    below = F.col("_negle") - F.col("nneg")
    # a single class gives NULL (undefined), not a division error
    return c.agg(F.try_divide(F.sum(F.col("npos") * (below + 0.5 * F.col("nneg"))),
                              (F.sum("npos") * F.sum("nneg")).cast("double")).alias("auc"))


def zscore(df: DataFrame, cols: list[str], prefix: str = "z_") -> DataFrame:
    """(x - mean) / population std; all means and stds come from one aggregate row."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}")]
    st = df.agg(*aggs).first()
    # a constant column (std 0) gives NULL, not a division error
    return df.withColumns({f"{prefix}{c}": F.try_divide(F.col(c) - F.lit(st[f"m_{c}"]), F.lit(st[f"s_{c}"]))
                           for c in cols})


def variance_filter(df: DataFrame, cols: list[str], threshold: float = 0.8 * (1 - 0.8)) -> DataFrame:
    """Population variance per column, kept when above the threshold."""
    one = df.agg(*[F.var_pop(F.col(c).cast("double")).alias(c) for c in cols])
    long = one.unpivot([], cols, "column", "variance")
    return long.withColumn("kept", F.col("variance") > F.lit(threshold))


def ensemble_mean(df: DataFrame, cols: list[str], name: str = "prob") -> DataFrame:
    """Row-wise mean of model outputs."""
    return df.withColumn(name, sum((F.col(c) for c in cols), F.lit(0.0)) / len(cols))


def class_stats(df: DataFrame, label: str, cols: list[str]) -> DataFrame:
    """M8 (relational): per-class mean and population variance of each feature."""
    aggs = []
    for c in cols:
        aggs += [F.avg(F.col(c).cast("double")).alias(f"{c}__mean"),
                 F.var_pop(F.col(c).cast("double")).alias(f"{c}__var")]
    g = df.groupBy(label).agg(*aggs, F.count(F.lit(1)).alias("n"))
    st = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"{c}__mean").alias("mean"),
                                      F.col(f"{c}__var").alias("var")) for c in cols]))
    return g.select(label, "n", st.alias("s")).select(label, "n", "s.*")
