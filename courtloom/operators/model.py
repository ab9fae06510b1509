"""Encoding, split, depth-limited decision tree and its explanation, on MLlib."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassificationModel, DecisionTreeClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtloom.session import durable, work_path

TRAIN_SHARE = 0.67


def text_columns(df: DataFrame, skip=()) -> list[str]:
    """Columns to encode, chosen by type."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in skip]


def fit_encoder(df: DataFrame, columns: list[str]):
    """Integer codes in sorted order of the values; all columns are counted in one pass."""
    out = [f"{c}_code" for c in columns]
    return StringIndexer(inputCols=columns, outputCols=out, stringOrderType="alphabetAsc").fit(df)


def label_encode(df: DataFrame, columns: list[str], encoder=None) -> DataFrame:
    """Replaces text columns by their integer codes.

    Codes leave without nominal metadata: the tree splits them by threshold.
    """
    encoded = (encoder or fit_encoder(df, columns)).transform(df)
    codes = {c: F.col(f"{c}_code").cast("int").alias(c, metadata={}) for c in columns}
    return encoded.select(*[codes.get(c, F.col(c)) for c in df.columns])


def split_column(*keys: str, share: float = TRAIN_SHARE):
    """`train` or `test` by digest of a key: repeatable, and rows of one key stay together."""
    digest = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))
    bucket = F.conv(F.left(digest, F.lit(4)), 16, 10).cast("int")
    return F.when(bucket < int(share * 65536), "train").otherwise("test")


def random_split(df: DataFrame, share: float = TRAIN_SHARE, seed: int = 0) -> list[DataFrame]:
    """Seeded random split."""
    return df.randomSplit([share, 1 - share], seed)


def prepare(rows: DataFrame, features: list[str], target: str, key: str) -> tuple[DataFrame, list[str], int]:
    """Encoded rows with `features`, `label` and `split`, written once; class names; widest code range.

    `features` is the caller's choice; personal attributes enter a model only by being listed there.
    """
    chosen = durable(rows.select(key, target, *features), "model-rows")
    columns = text_columns(chosen, skip=(key,))
    encoder = fit_encoder(chosen, columns)
    sizes = dict(zip(columns, (len(labels) for labels in encoder.labelsArray)))
    numbers = [f for f in features if f not in sizes]
    spans = chosen.agg(*[F.approx_count_distinct(c).alias(c) for c in numbers]).first() if numbers else {}
    widest = max([sizes[c] for c in columns if c != target] + [int(spans[c] * 1.1) for c in numbers] + [32])
    classes = list(encoder.labelsArray[columns.index(target)])
    encoded = label_encode(chosen, columns, encoder).withColumn("split", split_column(key))
    assembled = VectorAssembler(inputCols=features, outputCol="features").transform(encoded)
    return assembled.select("features", F.col(target).cast("double").alias("label"), "split"), classes, widest + 1


def fit_tree(train: DataFrame, bins: int, depth: int = 4) -> DecisionTreeClassificationModel:
    """Gini tree of limited depth; `bins` covers every code so that no split point is lost."""
    tree = DecisionTreeClassifier(maxDepth=depth, impurity="gini", seed=0, maxBins=bins)
    return Pipeline(stages=[tree]).fit(train).stages[-1]


def accuracy(model, prepared: DataFrame) -> DataFrame:
    """Share of right predictions per split."""
    hit = (F.col("prediction") == F.col("label")).cast("int")
    return (
        model.transform(prepared)
        .groupBy("split")
        .agg(F.count("*").alias("n_rows"), F.round(F.avg(hit), 6).alias("accuracy"))
    )


def save(model, path: str) -> None:
    """Persist a fitted tree."""
    model.write().overwrite().save(path)


def tree_nodes(model, spark, features: list[str], classes: list[str]) -> DataFrame:
    """Nodes of a fitted tree with feature and class names, read back from the saved model."""
    path = work_path(spark, "tree")
    save(model, path)
    feature_names, class_names = F.array(*map(F.lit, features)), F.array(*map(F.lit, classes))
    inner = F.col("leftChild") >= 0
    return spark.read.parquet(f"{path}/data").select(
        F.col("id").alias("node"),
        F.when(inner, F.get(feature_names, F.col("split.featureIndex"))).alias("feature"),
        F.when(inner, F.get(F.col("split.leftCategoriesOrThreshold"), F.lit(0))).alias("threshold"),
        F.when(inner, F.col("leftChild")).alias("left_node"),
        F.when(inner, F.col("rightChild")).alias("right_node"),
        F.get(class_names, F.col("prediction").cast("int")).alias("outcome"),
        F.round("impurity", 6).alias("impurity"),
        F.when(inner, F.round("gain", 6)).alias("gain"),
    )


def feature_importance(model, spark, features: list[str]) -> DataFrame:
    """Importance by feature name, largest first; one row per feature column."""
    scores = [(name, round(float(model.featureImportances[i]), 6)) for i, name in enumerate(features)]
    return spark.createDataFrame(scores, "feature string, importance double").orderBy(F.desc("importance"), "feature")
