"""Tables, intermediate tables and carried columns of the text operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.store import clear, materialise, own_folder, shared_folder, written

__all__ = ["Carried", "clear", "materialise", "own_folder", "shared_folder", "table", "written"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Carried:
    """Columns that pass through an Arrow function under names that its own cannot meet."""

    def __init__(self, documents: DataFrame, names: list[str]):
        self.names, self.inner = names, [f"_c{k}" for k in range(len(names))]
        columns = [F.col(f"`{c}`").alias(k) for c, k in zip(names, self.inner, strict=True)]
        self.text = self.inner[names.index("text")] if "text" in names else "_text"
        self.frame = documents.select(*columns, *([] if "text" in names else [F.col("text").alias("_text")]))
        self.schema = ", ".join(f"{k} {self.frame.schema[k].dataType.simpleString()}" for k in self.inner)

    def restore(self, made: DataFrame) -> DataFrame:
        return made.toDF(*self.names, *made.columns[len(self.names) :])
