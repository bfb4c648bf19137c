"""Evaluation operators.

Every metric is a conditional aggregate (map-side partial aggregation).
ROC/AUC need a global order over scores: scores are first grouped to
(score, positives, negatives), then running sums use ``prefix_sums``, so no
task holds a whole score column and repeated scores cost nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import join_null_safe, prefix_sums, salted_row_number, shuffle_width


def _safe_div(a: Column, b: Column) -> Column:
    """a / b with zero division giving 0 (like zero_division=0)."""
    return F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))


def cell_counts(df: DataFrame, y: str, yhat: str, by: list[str] | None = None) -> DataFrame:
    """(by..., tp, fp, fn, tn) from one conditional aggregate."""
    by = by or []
    yy, pp = F.col(y) == 1, F.col(yhat) == 1
    g = df.groupBy(*by) if by else df.groupBy()
    return g.agg(F.count_if(yy & pp).alias("tp"), F.count_if(~yy & pp).alias("fp"),
                 F.count_if(yy & ~pp).alias("fn"), F.count_if(~yy & ~pp).alias("tn"))


def confusion(df: DataFrame, y: str, yhat: str, by: list[str] | None = None) -> DataFrame:
    """(by..., actual, predicted, n), all four cells present (zeros kept)."""
    by = by or []
    c = cell_counts(df, y, yhat, by)
    return c.select(*by, F.expr(
        "stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) AS (actual, predicted, n)"))


def metrics_from_cells(c: DataFrame, by: list[str]) -> DataFrame:
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    prec = _safe_div(tp, tp + fp)
    rec = _safe_div(tp, tp + fn)
    return c.select(*by, "tp", "fp", "fn", "tn",
                    _safe_div(tp + tn, tp + fp + fn + tn).alias("accuracy"),
                    prec.alias("precision"), rec.alias("recall"),
                    _safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"))


def binary_metrics(df: DataFrame, y: str, yhat: str, by: list[str] | None = None) -> DataFrame:
    """Accuracy, precision, recall, F1 (zero division -> 0)."""
    by = by or []
    return metrics_from_cells(cell_counts(df, y, yhat, by), by)


def class_report(df: DataFrame, y: str, yhat: str, by: list[str] | None = None) -> DataFrame:
    """Per class precision/recall/F1/support, accuracy, macro and
    weighted averages; (by..., row, precision, recall, f1, support)."""
    by = by or []
    c = cell_counts(df, y, yhat, by)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    p1, r1 = _safe_div(tp, tp + fp), _safe_div(tp, tp + fn)
    p0, r0 = _safe_div(tn, tn + fn), _safe_div(tn, tn + fp)
    f1_1, f1_0 = _safe_div(2 * tp, 2 * tp + fp + fn), _safe_div(2 * tn, 2 * tn + fn + fp)
    s1, s0 = tp + fn, tn + fp
    acc = _safe_div(tp + tn, n)
    rows = F.array(
        F.struct(F.lit("0").alias("row"), p0.alias("precision"), r0.alias("recall"), f1_0.alias("f1"), s0.alias("support")),
        F.struct(F.lit("1").alias("row"), p1.alias("precision"), r1.alias("recall"), f1_1.alias("f1"), s1.alias("support")),
        F.struct(F.lit("accuracy").alias("row"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), acc.alias("f1"), n.alias("support")),
        F.struct(F.lit("macro avg").alias("row"), ((p0 + p1) / 2).alias("precision"), ((r0 + r1) / 2).alias("recall"),
                 ((f1_0 + f1_1) / 2).alias("f1"), n.alias("support")),
        F.struct(F.lit("weighted avg").alias("row"), _safe_div(p0 * s0 + p1 * s1, n).alias("precision"),
                 _safe_div(r0 * s0 + r1 * s1, n).alias("recall"),
                 _safe_div(f1_0 * s0 + f1_1 * s1, n).alias("f1"), n.alias("support")),
    )
    return c.select(*by, F.inline(rows))


def score_groups(df: DataFrame, y: str, score: str, by: list[str], materialize: bool = True) -> DataFrame:
    """(by..., score, pos, neg): one row per distinct score. With
    ``materialize`` the (small) table is written to the shared folder once,
    since the running sums read it several times."""
    g = (df.where(F.col(score).isNotNull())
           .groupBy(*by, F.col(score).alias("score"))
           .agg(F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg")))
    if materialize:
        from ..sources.tables import checkpoint_table
        g = checkpoint_table(g, "score_groups")
    return g


def roc_points(df: DataFrame, y: str, score: str, by: list[str] | None = None) -> DataFrame:
    """One ROC point per distinct score (threshold), scores descending:
    (by..., threshold, tps, fps, tpr, fpr). Collinear points are kept."""
    by = by or []
    if not by:
        out = roc_points(df.withColumn("__g", F.lit(0)), y, score, ["__g"])
        return out.drop("__g")
    # scorers are few: the totals are as many rows as there are groups
    g = score_groups(df, y, score, by)
    cum = prefix_sums(g, by, "score", ["pos", "neg"], descending=True)
    tot = g.groupBy(*by).agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    j = join_null_safe(cum, tot, by)
    return j.select(*by, F.col("score").alias("threshold"), F.col("cum_pos").alias("tps"),
                    F.col("cum_neg").alias("fps"), _safe_div(F.col("cum_pos"), F.col("P")).alias("tpr"),
                    _safe_div(F.col("cum_neg"), F.col("N")).alias("fpr"))


def auc(df: DataFrame, y: str, score: str, by: list[str] | None = None, materialize: bool = True) -> DataFrame:
    """Exact ROC AUC with ties counted half (trapezoid rule):
    sum over scores of pos * (negatives below + neg / 2) / (P * N).
    ``materialize=False`` when ``df`` is already persisted."""
    by = by or []
    g = score_groups(df, y, score, by, materialize)
    cum = prefix_sums(g, by, "score", ["neg"])  # ascending: negatives <= score
    below = F.col("cum_neg") - F.col("neg")
    part = cum.select(*by, (F.col("pos") * (below + F.col("neg") / 2.0)).alias("w"), "pos", "neg")
    agg = (part.groupBy(*by) if by else part.groupBy()).agg(
        F.sum("w").alias("w"), F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return agg.select(*by, (F.col("w") / (F.col("P") * F.col("N"))).alias("auc"))


def best_by(df: DataFrame, group: list[str], metric: str, tiebreak: str) -> DataFrame:
    """The row with the largest ``metric`` per group; ties go to the
    smallest ``tiebreak``, null metrics come last. One aggregate with partial
    aggregation: no window, no join, no group held by one task."""
    others = [c for c in df.columns if c not in group]
    place = F.struct(F.col(metric).isNull(), -F.col(metric), F.col(tiebreak))
    win = df.groupBy(*group).agg(F.min_by(F.struct(*[F.col(c) for c in others]), place).alias("__b"))
    return win.select(*group, *[F.col(f"__b.{c}").alias(c) for c in others])


def metrics_long(df: DataFrame, ids: list[str], metrics: list[str], decimals: int = 4) -> DataFrame:
    """Metric table rounded half-even and unpivoted to (ids..., metric, value)."""
    d = df.select(*ids, *[F.bround(F.col(m).cast("double"), decimals).alias(m) for m in metrics])
    return d.unpivot(ids, metrics, "metric", "value")


# --------------------------------------------------------------- M7 / M8

def _md5_order(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))


def stratified_rank(df: DataFrame, label: str, key: str, seed: int = 42, total: str | None = None) -> DataFrame:
    """Exact rank within each label class by md5(key:seed). Each class is
    numbered in hash slices, about four for each shuffle partition; null is a
    class of its own, and rows without a key come first in theirs."""
    h = _md5_order(key, seed)
    digits = max(2, math.ceil(math.log(4 * shuffle_width(df), 16)))
    d = df.withColumn("__h", h)
    return salted_row_number(d, [label], [F.col("__h"), F.col(key)], F.substring("__h", 1, digits),
                             name="__rank", total=total).drop("__h")


def stratified_split(df: DataFrame, label: str, key: str, frac: float = 0.2, seed: int = 42,
                     name: str = "is_test") -> DataFrame:
    """M7: exactly ceil(frac * n_class) rows of each class go to the test
    side, chosen by md5 order (the same rows in any engine). The class sizes
    come with the ranks, so rows are never joined on the label."""
    r = stratified_rank(df, label, key, seed, total="__n")
    return r.withColumn(name, (F.col("__rank") <= F.ceil(F.col("__n") * frac)).cast("int")) \
        .drop("__rank", "__n")


def hash_split(df: DataFrame, key: str, frac: float = 0.2, seed: int = 42, name: str = "is_test") -> DataFrame:
    """M7 at scale: rows whose hash lies below ``frac`` go to the test side.
    Each class gets its share within sampling error, without any shuffle; a
    null key hashes like a value."""
    h = F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("null")), F.lit(f":{seed}")))
    place = F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / float(1 << 32)
    return df.withColumn(name, (place < frac).cast("int"))


def stratified_folds(df: DataFrame, label: str, key: str, k: int = 5, seed: int = 42,
                     name: str = "fold") -> DataFrame:
    """M8: fold = (rank - 1) mod k within each class: balanced folds that
    keep the class ratio."""
    r = stratified_rank(df, label, key, seed)
    return r.withColumn(name, F.pmod(F.col("__rank") - 1, F.lit(k)).cast("int")).drop("__rank")
