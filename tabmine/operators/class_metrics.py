"""Classification metrics. Everything derives from one distributed
``groupBy(y_true, y_pred).count`` (at most labels^2 rows); the rest is
arithmetic on that small table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ordered import running_sums


def _small():
    """Whole-table window for per-label tables (one row per label)."""
    return Window.partitionBy(F.lit(0))



def confusion_counts(pred: DataFrame, y: str = "y_true", yhat: str = "prediction") -> DataFrame:
    """Counts per (true, predicted) pair, only pairs that occur."""
    return pred.groupBy(F.col(y).alias("y_true"), F.col(yhat).alias("y_pred")).agg(F.count(F.lit(1)).alias("n"))


def _labels(cc: DataFrame) -> DataFrame:
    return cc.select(F.col("y_true").alias("label")).union(cc.select(F.col("y_pred").alias("label"))).distinct()


def confusion_matrix(pred: DataFrame, y: str = "y_true", yhat: str = "prediction") -> DataFrame:
    """All (true, predicted) label pairs over the sorted label union, zero-filled.
    The label x label grid is a product of the distinct labels with themselves."""
    cc = confusion_counts(pred, y, yhat).cache()
    labels = _labels(cc)
    grid = labels.select(F.col("label").alias("y_true")).crossJoin(labels.select(F.col("label").alias("y_pred")))
    return grid.withColumn("n", F.lit(0).cast("bigint")).unionByName(cc).groupBy("y_true", "y_pred").agg(F.sum("n").alias("n"))


def per_class_counts(pred: DataFrame, y: str = "y_true", yhat: str = "prediction") -> DataFrame:
    """TP/TN/FP/FN and support per label (one-vs-rest)."""
    cc = confusion_counts(pred, y, yhat).cache()
    t = cc.groupBy(F.col("y_true").alias("label")).agg(
        F.sum("n").alias("support"), F.sum(F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0)).alias("tp")
    )
    p = cc.groupBy(F.col("y_pred").alias("label")).agg(F.sum("n").alias("predicted"))
    j = t.join(p, "label", "full_outer").select(
        "label",
        F.coalesce("tp", F.lit(0)).alias("tp"),
        F.coalesce("support", F.lit(0)).alias("support"),
        F.coalesce("predicted", F.lit(0)).alias("predicted"),
    )
    j = j.withColumn("total", F.sum("support").over(_small()))
    return j.select(
        "label",
        F.col("tp").cast("bigint").alias("tp"),
        (F.col("total") - F.col("support") - F.col("predicted") + F.col("tp")).cast("bigint").alias("tn"),
        (F.col("predicted") - F.col("tp")).cast("bigint").alias("fp"),
        (F.col("support") - F.col("tp")).cast("bigint").alias("fn"),
        F.col("support").cast("bigint").alias("support"),
        F.col("predicted").cast("bigint").alias("predicted"),
        F.col("total").cast("bigint").alias("total"),
    )


def _ratio(a, b):
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _f1(p, r):
    return F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))


def per_class_metrics(pred: DataFrame, y: str = "y_true", yhat: str = "prediction", digits: int = 6) -> DataFrame:
    """TP TN FP FN precision recall f1 support per label."""
    k = per_class_counts(pred, y, yhat)
    prec = _ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = _ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return k.select(
        "label", "tp", "tn", "fp", "fn",
        F.round(prec, digits).alias("precision"),
        F.round(rec, digits).alias("recall"),
        F.round(_f1(prec, rec), digits).alias("f1"),
        "support",
    )


def overall_metrics(pred: DataFrame, y: str = "y_true", yhat: str = "prediction", digits: int = 6,
                    f1: str = "of_averages") -> DataFrame:
    """Accuracy; binary (exactly two labels seen, positive = larger
    label) precision/recall/f1, otherwise micro/macro/weighted and the plain
    names = weighted. F1 is the harmonic mean of the averaged precision and
    recall (``f1='of_averages'``) or the mean of class F1 (``'mean_of_classes'``)."""
    k = per_class_counts(pred, y, yhat)
    prec = _ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = _ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    k = k.select("*", prec.alias("p"), rec.alias("r"), _f1(prec, rec).alias("f"),
                 F.max("label").over(_small()).alias("__maxl"), F.count(F.lit(1)).over(_small()).alias("__nl"))
    a = k.agg(
        (F.sum("tp") / F.first("total")).alias("accuracy"),
        F.first("__nl").alias("n_labels"),
        F.max(F.when(F.col("label") == F.col("__maxl"), F.col("p"))).alias("p_bin"),
        F.max(F.when(F.col("label") == F.col("__maxl"), F.col("r"))).alias("r_bin"),
        (F.sum("tp") / F.sum(F.col("tp") + F.col("fp"))).alias("p_micro"),
        (F.sum("tp") / F.sum(F.col("tp") + F.col("fn"))).alias("r_micro"),
        F.avg("p").alias("p_macro"),
        F.avg("r").alias("r_macro"),
        F.avg("f").alias("f_macro_classes"),
        (F.sum(F.col("p") * F.col("support")) / F.sum("support")).alias("p_weighted"),
        (F.sum(F.col("r") * F.col("support")) / F.sum("support")).alias("r_weighted"),
        (F.sum(F.col("f") * F.col("support")) / F.sum("support")).alias("f_weighted_classes"),
    )
    binary = F.col("n_labels") == 2

    def fx(p, r, alt):
        return alt if f1 == "mean_of_classes" else _f1(p, r)

    f_micro = _f1(F.col("p_micro"), F.col("r_micro"))
    f_macro = fx(F.col("p_macro"), F.col("r_macro"), F.col("f_macro_classes"))
    f_weighted = fx(F.col("p_weighted"), F.col("r_weighted"), F.col("f_weighted_classes"))
    f_bin = _f1(F.col("p_bin"), F.col("r_bin"))
    r = lambda e: F.round(e, digits)
    return a.select(
        r(F.col("accuracy")).alias("accuracy"),
        r(F.when(binary, F.col("p_bin")).otherwise(F.col("p_weighted"))).alias("precision"),
        r(F.when(binary, F.col("r_bin")).otherwise(F.col("r_weighted"))).alias("recall"),
        r(F.when(binary, f_bin).otherwise(f_weighted)).alias("f1"),
        r(F.when(~binary, F.coalesce(F.col("p_micro"), F.lit(0.0)))).alias("precision_micro"),
        r(F.when(~binary, F.coalesce(F.col("r_micro"), F.lit(0.0)))).alias("recall_micro"),
        r(F.when(~binary, F.coalesce(f_micro, F.lit(0.0)))).alias("f1_micro"),
        r(F.when(~binary, F.col("p_macro"))).alias("precision_macro"),
        r(F.when(~binary, F.col("r_macro"))).alias("recall_macro"),
        r(F.when(~binary, f_macro)).alias("f1_macro"),
        r(F.when(~binary, F.col("p_weighted"))).alias("precision_weighted"),
        r(F.when(~binary, F.col("r_weighted"))).alias("recall_weighted"),
        r(F.when(~binary, f_weighted)).alias("f1_weighted"),
        F.col("n_labels").cast("bigint").alias("n_labels"),
    )


def f1_scores(pred: DataFrame, y: str = "y_true", yhat: str = "prediction", digits: int = 6) -> DataFrame:
    """Both F1 readings in one row: harmonic mean of the averaged P and R
    (reference default) and the mean of the class F1 values."""
    k = per_class_counts(pred, y, yhat)
    prec = _ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = _ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    k = k.select("*", prec.alias("p"), rec.alias("r"), _f1(prec, rec).alias("f"))
    a = k.agg(
        F.avg("p").alias("pm"), F.avg("r").alias("rm"), F.avg("f").alias("fm"),
        (F.sum(F.col("p") * F.col("support")) / F.sum("support")).alias("pw"),
        (F.sum(F.col("r") * F.col("support")) / F.sum("support")).alias("rw"),
        (F.sum(F.col("f") * F.col("support")) / F.sum("support")).alias("fw"),
    )
    return a.select(
        F.round(_f1(F.col("pw"), F.col("rw")), digits).alias("f1_weighted"),
        F.round(_f1(F.col("pm"), F.col("rm")), digits).alias("f1_macro"),
        F.round(F.col("fw"), digits).alias("f1_weighted_of_classes"),
        F.round(F.col("fm"), digits).alias("f1_macro_of_classes"),
    )


def classification_report(pred: DataFrame, y: str = "y_true", yhat: str = "prediction", digits: int = 6) -> DataFrame:
    """Per-class rows plus accuracy, macro avg and weighted avg rows
    (here macro and weighted F1 are means of the class F1)."""
    m = per_class_metrics(pred, y, yhat, digits=12)
    body = m.select(F.col("label").cast("string").alias("row"), "precision", "recall", "f1", "support",
                    F.lit(0).alias("__o"), F.col("label").cast("string").alias("__k"))
    tot = m.agg(
        F.sum("support").alias("s"), F.sum("tp").alias("tp"),
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"),
    )
    acc = tot.select(F.lit("accuracy").alias("row"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"), (F.col("tp") / F.col("s")).alias("f1"),
                     F.col("s").alias("support"), F.lit(1).alias("__o"), F.lit("").alias("__k"))
    mac = tot.select(F.lit("macro avg").alias("row"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                     F.col("mf").alias("f1"), F.col("s").alias("support"), F.lit(2).alias("__o"), F.lit("").alias("__k"))
    wei = tot.select(F.lit("weighted avg").alias("row"), F.col("wp").alias("precision"), F.col("wr").alias("recall"),
                     F.col("wf").alias("f1"), F.col("s").alias("support"), F.lit(3).alias("__o"), F.lit("").alias("__k"))
    out = body.unionByName(acc).unionByName(mac).unionByName(wei)
    return out.select(
        "row",
        F.round("precision", digits).alias("precision"),
        F.round("recall", digits).alias("recall"),
        F.round("f1", digits).alias("f1"),
        F.col("support").cast("bigint").alias("support"),
    )


def pr_curve(scored: DataFrame, score: str, y: str, pos_label, digits: int = 6) -> DataFrame:
    """One point per distinct score (descending threshold, predicted
    positive = score >= t) after the first point (P=1, R=0); running counts
    come from range buckets plus a carry table, never a global window."""
    g = scored.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.sum((F.col(y) == F.lit(pos_label)).cast("long")).alias("pos"),
        F.count(F.lit(1)).alias("cnt"),
    )
    cum = running_sums(g, "threshold", ["pos", "cnt"], descending=True)
    total_pos = scored.agg(F.sum((F.col(y) == F.lit(pos_label)).cast("long")).alias("tp")).first()["tp"] or 0
    pts = cum.select(
        "threshold",
        _ratio(F.col("cum_pos"), F.col("cum_cnt")).alias("precision"),
        (F.col("cum_pos") / F.lit(total_pos) if total_pos > 0 else F.lit(0.0)).alias("recall"),
        (F.col("pos") / F.lit(total_pos) if total_pos > 0 else F.lit(0.0)).alias("d_recall"),
    )
    return pts.select(
        F.round("threshold", digits).alias("threshold"),
        F.round("precision", digits).alias("precision"),
        F.round("recall", digits).alias("recall"),
        F.round(F.col("d_recall") * F.col("precision"), 12).alias("ap_term"),
    )


def average_precision(curve: DataFrame, digits: int = 6) -> DataFrame:
    """AP = sum over points of (R_i - R_{i-1}) * P_i."""
    return curve.agg(F.round(F.sum("ap_term"), digits).alias("average_precision"))


def _listed(order: Sequence | None):
    """Place of a model in the list; those not listed come after."""
    if not order:
        return F.lit(0)
    place = F.array_position(F.array(*[F.lit(m) for m in order]), F.col("model"))
    return F.when(place > 0, place).otherwise(F.lit(len(order) + 1))


def compare_metrics(preds: DataFrame, key: str = "algo", y: str = "y_true", yhat: str = "prediction",
                    digits: int = 4, order: Sequence | None = None) -> DataFrame:
    """Accuracy, precision, recall and F1 (as %) per model, with the rank
    of each model on accuracy. A model with exactly two labels (true or
    predicted) is scored on the greater one, any other by support-weighted
    means. Equal accuracies rank in the listed ``order``, then by model."""
    cc = preds.groupBy(F.col(key).alias("model"), F.col(y).alias("y_true"), F.col(yhat).alias("y_pred")).agg(
        F.count(F.lit(1)).alias("n"))
    t = cc.groupBy("model", F.col("y_true").alias("label")).agg(
        F.sum("n").alias("support"), F.sum(F.when(F.col("y_true") == F.col("y_pred"), F.col("n")).otherwise(0)).alias("tp"))
    p = cc.groupBy("model", F.col("y_pred").alias("label")).agg(F.sum("n").alias("predicted"))
    k = t.join(p, ["model", "label"], "full_outer").select(
        "model", "label", F.coalesce("tp", F.lit(0)).alias("tp"), F.coalesce("support", F.lit(0)).alias("support"),
        F.coalesce("predicted", F.lit(0)).alias("predicted"))
    prec = _ratio(F.col("tp"), F.col("predicted"))
    rec = _ratio(F.col("tp"), F.col("support"))
    k = k.select("*", prec.alias("p"), rec.alias("r"))
    a = k.groupBy("model").agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        (F.sum(F.col("p") * F.col("support")) / F.sum("support")).alias("precision"),
        (F.sum(F.col("r") * F.col("support")) / F.sum("support")).alias("recall"),
        F.count(F.lit(1)).alias("n_labels"),
        F.max_by("p", "label").alias("p_pos"),
        F.max_by("r", "label").alias("r_pos"),
    )
    two = F.col("n_labels") == 2
    a = a.withColumn("precision", F.when(two, F.col("p_pos")).otherwise(F.col("precision"))).withColumn(
        "recall", F.when(two, F.col("r_pos")).otherwise(F.col("recall")))
    a = a.withColumn("f1", _f1(F.col("precision"), F.col("recall")))
    w = Window.partitionBy(F.lit(0)).orderBy(F.desc("accuracy"), _listed(order), F.asc("model"))  # one row per model
    return a.select(
        F.col("model").alias(key),
        *[F.round(F.col(m) * 100, digits).alias(f"{m}_pct") for m in ("accuracy", "precision", "recall", "f1")],
        F.row_number().over(w).alias("rank"),
    )
