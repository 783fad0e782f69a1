"""One-hot encoding from a distributed dictionary: no value passes the driver.

The dictionary has a row (column, value, slot) for each value seen in fitting, and slots
follow the values in alphabetical order (of their UTF-8 bytes). It is built like a sort:
values are dealt to ranges, numbered inside their range, and each range starts where the
ones before it end. Rows get their slots by a join, broadcast only if the column has at
most ``BROADCAST_VALUES`` values; Spark's encoder then makes sparse vectors from the slots
and needs to know nothing but their number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderflow.session import stage

BROADCAST_VALUES = 100_000


def category_dictionary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, slot) of every value in ``columns``; missing values have none; staged."""
    cells = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                    for c in columns
                ]
            )
        ).alias("cell")
    ).select("cell.*")
    # Ranges of the sort are staged, so that numbering reads the same ones.
    ranges = stage(
        cells.where("value IS NOT NULL")
        .distinct()
        .orderBy("column", "value")
        .withColumn("range", F.spark_partition_id()),
        "categories",
    )
    before = Window.partitionBy("column").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranges.groupBy("column", "range")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("column", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )
    inside = Window.partitionBy("column", "range").orderBy("value")
    return stage(
        ranges.withColumn("at", F.row_number().over(inside) - 1)
        .join(starts, ["column", "range"])
        .select("column", "value", (F.col("start") + F.col("at")).cast("int").alias("slot")),
        "dictionary",
    )


class CategoryEncoder(Estimator):
    """One slot per value seen in fitting; unseen and missing values become all zeros."""

    def __init__(self, columns: Sequence[str]):
        super().__init__()
        self.columns = list(columns)

    def _fit(self, df: DataFrame) -> CategoryModel:
        if not self.columns:
            return CategoryModel([], {}, None)
        dictionary = category_dictionary(df, self.columns)
        counted = dictionary.groupBy("column").count().collect()  # one row per column
        sizes = dict.fromkeys(self.columns, 0) | {r["column"]: r["count"] for r in counted}
        return CategoryModel(self.columns, sizes, dictionary)


class CategoryModel(Model):
    """Adds ``<column>_onehot`` for every column; one without values gets empty vectors."""

    def __init__(self, columns: Sequence[str], sizes: dict[str, int], dictionary: DataFrame | None):
        super().__init__()
        self.columns, self.sizes, self.dictionary = list(columns), sizes, dictionary

    def slots(self, column: str) -> DataFrame:
        """(value, slot) of one column."""
        return self.dictionary.where(F.col("column") == column).select("value", "slot")

    def indexed(self, df: DataFrame, names: dict[str, str]) -> DataFrame:
        """``df`` with the slot of every column in ``names``; the one after the last for other values."""
        for c, name in names.items():
            size, value, slot = self.sizes[c], f"_{c}_value", f"_{c}_slot"
            if not size:
                df = df.withColumn(name, F.lit(0.0))
                continue
            side = self.slots(c).toDF(value, slot)
            if size <= BROADCAST_VALUES:
                side = F.broadcast(side)
            index = F.coalesce(F.col(slot), F.lit(size)).cast("double")
            df = df.join(side, F.col(c).cast("string") == F.col(value), "left").withColumn(name, index)
            df = df.drop(value, slot)
        return df

    def _transform(self, df: DataFrame) -> DataFrame:
        valued = [c for c in self.columns if self.sizes[c]]
        indexed = self.indexed(
            df.withColumns(
                {
                    f"{c}_onehot": array_to_vector(F.array().cast("array<double>"))
                    for c in self.columns
                    if c not in valued
                }
            ),
            {c: f"{c}_index" for c in valued},
        )
        if not valued:
            return indexed
        for c in valued:
            marked = {"ml_attr": {"type": "nominal", "num_vals": self.sizes[c] + 1}}
            indexed = indexed.withMetadata(f"{c}_index", marked)
        encoder = OneHotEncoder(
            inputCols=[f"{c}_index" for c in valued],
            outputCols=[f"{c}_onehot" for c in valued],
            dropLast=True,
        )
        # The numbers of values are in the columns' metadata, so fitting reads no row.
        return encoder.fit(indexed).transform(indexed).drop(*[f"{c}_index" for c in valued])

    def feature_names(self) -> DataFrame:
        """(index, feature) of all slots, such as ``region_North``, column after column."""
        starts, at = [], 0
        for c in self.columns:
            starts.append((c, at))
            at += self.sizes[c]
        spark = self.dictionary.sparkSession
        offsets = spark.createDataFrame(starts, "column string, start int")
        return self.dictionary.join(F.broadcast(offsets), "column").select(
            (F.col("start") + F.col("slot")).alias("index"),
            F.concat_ws("_", "column", "value").alias("feature"),
        )
