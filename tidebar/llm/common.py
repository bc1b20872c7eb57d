"""What the operators of this subpackage share: reading tables, cutting lineage, and joins with hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebar.session import shared_folder

#: The columns of the documents table, which the stages of a pipeline hand on.
DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A key is hot if it has more than one row in so many; there are fewer such keys than this.
HOT_SHARE = 500
#: Parts into which the rows of a hot key are dealt.
SALTS = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of the input folder, which may be in any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The rows of df from a reliable checkpoint in the folder that driver and executors share, so that they outlive any executor."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def removed(spark: SparkSession, folder: str) -> None:
    """Delete a folder of intermediate tables that nothing reads any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def hot_keys(counts: DataFrame, keys: list[str], n: str = "n") -> DataFrame:
    """The keys with more than one row in HOT_SHARE; counts: a row for each key. Fewer than HOT_SHARE rows, whatever the data."""
    total = counts.agg(F.sum(n).alias("_total"))
    return counts.crossJoin(F.broadcast(total)).where(F.col(n) * HOT_SHARE > F.col("_total")).select(*keys)


def dealt(left: DataFrame, hot: DataFrame, keys: list[str], salt: Column) -> DataFrame:
    """left with _salt: for hot keys (a row for each) which of SALTS parts a row is in, by salt; else 0."""
    known = F.broadcast(hot.withColumn("_hot", F.lit(True)))
    return left.join(known, keys, "left").withColumn("_salt", F.when(F.col("_hot"), F.pmod(salt, F.lit(SALTS))).otherwise(0).cast("int")).drop("_hot")


def copied(right: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """right with _salt: rows of hot keys once for each part."""
    known = F.broadcast(hot.withColumn("_hot", F.lit(True)))
    every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return right.join(known, keys, "left").withColumn("_salt", F.explode(every)).drop("_hot")


def join_hot(left: DataFrame, right: DataFrame, keys: list[str], counts: DataFrame, salt: Column, how: str = "inner", n: str = "n") -> DataFrame:
    """left joined with right (one row for each key), with the rows of hot keys dealt over SALTS parts.

    counts: how many rows of left each key has, at least for the hot ones. salt: what tells rows of left apart. A hot
    key's row of right is repeated for each part; hot keys are fewer than HOT_SHARE, which bounds what is broadcast.
    Null keys meet nothing, as in any join.
    """
    hot = hot_keys(counts, keys, n)
    return dealt(left, hot, keys, salt).join(copied(right, hot, keys), [*keys, "_salt"], how).drop("_salt")
