"""Shared parts of the two forest models: encoding, splitting, importances."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderflow.functions.expr import in_test_split, key_hash
from orderflow.models import grower
from orderflow.models.encoding import CategoryEncoder, CategoryModel
from orderflow.operators.bridge import hash_bucket, number_within
from orderflow.session import branches, stage

SEED = 42
TEST_SHARE = 0.2
#: Spark bins continuous features; 128 bins stay close to trying every value.
MAX_BINS = 128
#: Settings of both forests. Cached node ids spare each pass the walk down every
#: finished level; more node memory per task means fewer passes.
FOREST_SETTINGS = {
    "featuresCol": "features",
    "maxBins": MAX_BINS,
    "cacheNodeIds": True,
    "maxMemoryInMB": 512,
}


#: Trees with so few nodes are walked in no time; with cached node ids a task would read its
#: rows twice, and their nodes.
FEW_NODES = 64

#: Bins that let Spark try every threshold: it squares them in 32 bits to size its sample.
EVERY_BIN = 46_340


#: Numbers that one training task keeps in memory: bin indexes, and draws and nodes by tree.
#: A task reads some 7 bytes for each, about 130 MB, whatever the size of the input.
TASK_NUMBERS = 20_000_000
#: Trees this deep have twice the nodes of the level above, and every task sends sums of all
#: of them: tasks hold twice the numbers for each level from here on.
DEEP = 12
#: The same for one tree. Every task sends sums of all nodes, which are few here, so that
#: more tasks cost little.
TREE_NUMBERS = 10_000_000
#: Spark's own forest fits up to so many rows; more are binned and grown by ``grower``.
SPARK_ROWS = 20_000
#: Between the seeds of a forest's parts; more than the tasks of a stage.
PART_SEEDS = 1_000_003


@dataclass(frozen=True)
class ForestSize:
    """``exhaustive`` trees see all rows and features, and try every threshold of a feature
    with fewer than ``EVERY_BIN`` values; they are fixed by the data alone."""

    trees: int
    depth: int
    exhaustive: bool = False

    @property
    def has_few_nodes(self) -> bool:
        return self.trees * 2**self.depth <= FEW_NODES

    def settings(self, features_per_split: str) -> dict:
        own = {"numTrees": self.trees, "maxDepth": self.depth}
        if self.exhaustive:
            fixed = {"maxBins": EVERY_BIN, "bootstrap": False, "featureSubsetStrategy": "all"}
            if self.has_few_nodes:
                fixed["cacheNodeIds"] = False
            return FOREST_SETTINGS | own | fixed
        return FOREST_SETTINGS | own | {"featureSubsetStrategy": features_per_split}


def one_hot_stages(columns: Sequence[str]) -> list[Estimator]:
    """One slot per value seen in training, in alphabetical order; other values are all zeros."""
    return [CategoryEncoder(columns)]


def assembler(categorical: Sequence[str], numeric: Sequence[str]) -> VectorAssembler:
    """One-hot slots first, then the numbers. A missing number is an error, not a guess."""
    return VectorAssembler(
        inputCols=[*[f"{c}_onehot" for c in categorical], *numeric],
        outputCol="features",
        handleInvalid="error",
    )


def forest_pipeline(
    categorical: Sequence[str], numeric: Sequence[str], forest: Estimator
) -> Pipeline:
    return Pipeline(
        stages=[*one_hot_stages(categorical), assembler(categorical, numeric), forest]
    )


def split(df: DataFrame, keys: Sequence[str], seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Train and test part, about 80/20, fixed by the row key."""
    marked = in_test_split(seed, *keys)
    return df.where(~marked), df.where(marked)


def with_stratum_test(
    df: DataFrame, keys: Sequence[str], label: str, name: str, seed: int = SEED
) -> DataFrame:
    """``df`` with the mark ``name`` of 20 % of the rows of every label, rounded.

    Rows are ordered inside their label by their hashed key, in even buckets of the hash. Most
    buckets lie wholly on one side of the cut, so their rows are marked where they are; only
    the rows of the bucket that is cut, one for each label, are numbered. ``df`` is read
    three times.
    """
    bucket = hash_bucket(seed, label, *keys)
    at, before = Window.partitionBy("_label"), Window.unboundedPreceding
    ends = F.sum("_n").over(at.orderBy("_at").rowsBetween(before, Window.currentRow))
    # 2**10 rows per label value
    sizes = (
        df.groupBy(F.col(label).alias("_label"), bucket.alias("_at"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_end", ends)
        .withColumn("_test", F.floor(F.sum("_n").over(at) * TEST_SHARE + 0.5))
        .select("_label", "_at", "_end", (F.col("_test") - (F.col("_end") - F.col("_n"))).alias("_rest"), "_n")
    )
    own = F.col(label).eqNullSafe(F.col("_label")) & (F.col("_bucket") == F.col("_at"))
    placed = df.withColumn("_bucket", bucket).join(F.broadcast(sizes), own)
    whole = (F.col("_rest") >= F.col("_n")) | (F.col("_rest") <= 0)
    marked = placed.where(whole).select(*df.columns, (F.col("_rest") > 0).alias(name))
    cut = placed.where(~whole).select(*df.columns, "_rest")
    numbered = number_within(cut, label, keys, "_number", seed)
    return marked.unionByName(
        numbered.select(*df.columns, (F.col("_number") < F.col("_rest")).alias(name))
    )


def stratified_split(
    df: DataFrame, keys: Sequence[str], label: str, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Train and test part with 20 % of the rows of every label, rounded."""
    marked = with_stratum_test(df, keys, label, "_tested", seed)
    return marked.where("NOT _tested").drop("_tested"), marked.where("_tested").drop("_tested")


def spread(features: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Staged features, dealt by the hash of the row key to as many tasks as run at once.

    Growing trees is bound by compute, so narrow features in a few files would
    otherwise train in a few tasks.
    """
    spark = features.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism,
                int(spark.conf.get("spark.sql.shuffle.partitions")))
    return stage(features.repartition(tasks, key_hash(SEED, *keys)), name)


def training_tasks(rows: int, columns: int, trees: int, depth: int = 1) -> int:
    """Tasks that train on ``rows``, in proportion to them."""
    numbers = TASK_NUMBERS if trees > 1 else min(TREE_NUMBERS, TASK_NUMBERS)
    numbers *= 2 ** max(0, depth - DEEP + 1)
    return math.ceil(rows * (columns + 2 * trees) / numbers)


def forest_parts(rows: int, columns: int, size: ForestSize, at_once: int) -> int:
    """Parts of a deep forest that are grown at once, in as many tasks as run at once in all.

    Each task sends sums of all nodes of its part, so a part with few tasks sends few. More
    rows need more tasks for each part, and in the end one part takes all.
    """
    if size.depth < DEEP:
        return 1
    for parts in range(min(at_once, size.trees // 2), 1, -1):
        tasks = training_tasks(rows, columns, math.ceil(size.trees / parts), size.depth)
        if parts * tasks <= at_once:
            return parts
    return 1


def fit_in_parts(
    forest: RandomForestRegressor, ready: DataFrame, trees: int, parts: int
) -> RandomForestRegressionModel:
    """One forest from ``parts`` that are grown at once, each from its own draws."""
    few, more = divmod(trees, parts)
    seed = forest.getSeed()
    # Spark adds a task's number to the seed; parts must not come to the same sums.
    sizes = [few + (i < more) for i in range(parts)]
    growers = [
        forest.copy({forest.numTrees: n, forest.seed: seed + i * PART_SEEDS})
        for i, n in enumerate(sizes)
    ]
    with branches(ready.sparkSession) as branch:
        grown = [branch(lambda g=g: g.fit(ready)) for g in growers]
        models = [g.result() for g in grown]
    context = ready.sparkSession.sparkContext
    kinds = context._jvm.org.apache.spark.ml.regression
    trees_of_all = context._gateway.new_array(kinds.DecisionTreeRegressionModel, trees)
    at = 0
    for model in models:
        for tree in model._java_obj.trees():
            trees_of_all[at] = tree
            at += 1
    whole = kinds.RandomForestRegressionModel(forest.uid, trees_of_all, models[0].numFeatures)
    model = forest._copyValues(RandomForestRegressionModel(whole))
    model._transfer_params_to_java()
    return model


def fit_forest(
    train: DataFrame,
    categorical: Sequence[str],
    numeric: Sequence[str],
    forest: Estimator,
    size: ForestSize,
    keys: Sequence[str] = (),
) -> PipelineModel:
    """Fit encoder, assembler and forest, with training rows dealt to tasks of bounded memory.

    More than ``SPARK_ROWS`` rows are grown by :mod:`orderflow.models.grower`, where a row's draws
    follow its ``keys`` and values. The rest of this is about fewer rows.

    Spark keeps each row with its draws and nodes of all trees, many times as large as in
    the file, so that parts of a file's size would be too large for a task. Small files are
    read several to a task, so that few tasks would train; rows are dealt to as many as run
    at once, or to more if these would hold too much.

    Rows are sorted in their task, except for few nodes. Rows with like features reach the
    same nodes, so the sums that one row adds to are still in the processor's cache for the
    next. It also makes a row's draws independent of the order in which rows arrive. The sort
    comes after the encoder's joins, since Spark drops a sort below a join.

    A deep forest of a regressor is grown in parts at once as long as its rows fit few tasks.
    """
    encoder = one_hot_stages(categorical)[0].fit(train)
    assemble = assembler(categorical, numeric)
    rows = train.select(forest.getLabelCol(), *categorical, *numeric)
    columns = sum(encoder.sizes.values()) + len(numeric)
    at_once = train.sparkSession.sparkContext.defaultParallelism
    n = train.count()
    if n > SPARK_ROWS:
        model = grower.grow(train, categorical, numeric, forest, encoder, n, keys)
        return PipelineModel([encoder, assemble, model])
    parts = 1
    if isinstance(forest, RandomForestRegressor):
        parts = forest_parts(n, columns, size, at_once)
    if parts > 1:
        # Staged, so that not every part encodes the rows again.
        tasks = training_tasks(n, columns, math.ceil(size.trees / parts), size.depth)
        encoded = assemble.transform(encoder.transform(rows)).drop(*[f"{c}_onehot" for c in categorical])
        ready = stage(encoded, "training-rows").repartition(tasks)
        ready = ready.sortWithinPartitions(*numeric, *categorical, forest.getLabelCol())
        return PipelineModel([encoder, assemble, fit_in_parts(forest, ready, size.trees, parts)])
    tasks = training_tasks(n, columns, size.trees, size.depth)
    ready = assemble.transform(encoder.transform(rows.repartition(max(tasks, at_once))))
    if not size.has_few_nodes:
        ready = ready.sortWithinPartitions(*numeric, *categorical, forest.getLabelCol())
    fitted = forest.fit(ready)
    return PipelineModel([encoder, assemble, fitted])


def feature_table(model: PipelineModel) -> DataFrame:
    """(index, feature) of the slots of ``features``, such as ``region_North`` or ``price``."""
    spark = SparkSession.active()
    numeric = [c for c in _assembled(model) if not c.endswith("_onehot")]
    width = sum(model.stages[0].sizes.values())
    names = spark.createDataFrame(
        [(width + i, c) for i, c in enumerate(numeric)], "index int, feature string"
    )
    encoder: CategoryModel = model.stages[0]
    return encoder.feature_names().unionByName(names) if encoder.columns else names


def _assembled(model: PipelineModel) -> list[str]:
    return next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()


def feature_importance(model: PipelineModel) -> DataFrame:
    """(feature, importance), largest first. Only weights other than 0 pass the driver."""
    weights = model.stages[-1].featureImportances
    held = SparkSession.active().createDataFrame(
        list(zip(weights.indices.tolist(), weights.values.tolist(), strict=True)),
        "index int, importance double",
    )
    return (
        feature_table(model)
        .join(held, "index", "left")
        .select("feature", F.coalesce("importance", F.lit(0.0)).alias("importance"))
        .orderBy(F.desc("importance"), "feature")
    )


def positive_probability(column: str = "probability") -> Column:
    return vector_to_array(column)[1]
