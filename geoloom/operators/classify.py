"""Tile classification results: probabilities, labels, summaries, normalised input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoloom.functions.columns import argmax, c, d, finite, softmax

#: Classes in the order of the network's outputs.
CLASSES = ("clear", "cloud", "shadow", "snow")


def predictions(tiles: DataFrame) -> DataFrame:
    """Probabilities and the likeliest class of each tile from its logits."""
    p = tiles.withColumn("p", softmax(c("logits")))
    p = p.withColumn("pred_id", argmax(c("p"))).withColumn("pred_label", F.element_at(F.array(*map(F.lit, CLASSES)), c("pred_id") + 1))
    return p.select("*", *[F.get("p", F.lit(i)).alias(f"prob_{k}") for i, k in enumerate(CLASSES)]).drop("p", "logits")


def class_summary(pred: DataFrame) -> DataFrame:
    """Count and share of every class, also of those that never come; in one pass over the predictions."""
    n = pred.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(c("pred_label") == k).alias(k) for k in CLASSES])
    rows = n.select("n", F.explode(F.array(*[F.struct(F.lit(k).alias("class"), c(k).alias("count")) for k in CLASSES])).alias("x"))
    return rows.select("x.class", "x.count", (c("x.count") / F.greatest(F.lit(1), c("n")).cast("double")).alias("fraction"))


def counts_by(pred: DataFrame, *keys: str) -> DataFrame:
    return pred.groupBy(*keys, "pred_label").agg(F.count(F.lit(1)).alias("count"))


def counts_by_dataset_and_scene(pred: DataFrame) -> DataFrame:
    """Both summaries in one pass: by dataset and label (scene null), and by dataset, scene and label."""
    return pred.groupingSets([[c("dataset"), c("pred_label")], [c("dataset"), c("scene"), c("pred_label")]], c("dataset"), c("scene"), c("pred_label")).agg(F.count(F.lit(1)).alias("count"))


def head_per_class(pred: DataFrame, n: int) -> DataFrame:
    """The first n tiles of each class in their order."""
    return pred.withColumn("rn", F.row_number().over(W.partitionBy("pred_label").orderBy("ord"))).where(c("rn") <= n)


def normalised(pixels: DataFrame, bands: tuple[str, ...], mean: tuple[float, ...], std: tuple[float, ...]) -> DataFrame:
    """Bands centred and scaled; a masked or non-finite value becomes the band's mean, that is 0."""
    if not len(bands) == len(mean) == len(std):
        raise ValueError("as many means and deviations as bands are needed")
    ok = c("valid")
    for b in bands:
        ok = ok & finite(b)
    return pixels.select(*[k for k in pixels.columns if k not in bands], *[F.when(ok, (c(b) - d(m)) / (d(s) + d(1e-6))).otherwise(d(0)).alias(b) for b, m, s in zip(bands, mean, std, strict=True)])
