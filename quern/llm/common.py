"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import atexit
import gc
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..cluster import cut, shared_dir, ship
from ..functions.text import let  # noqa: F401  for the operators

#: White space that ends a word: space, tab, line feed, vertical tab, form feed, return.
SPACE = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"

#: A table is broadcast only if it has no more rows than this; rows here are of a few dozen bytes.
BROADCAST_ROWS = 50_000
#: A key of more rows than HEAVY is dealt to SALTS tasks.
HEAVY, SALTS = 20_000, 64


def tune(spark: SparkSession) -> None:
    """Arrow batches small enough for long texts, and the package on the executors."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def cut_parquet(df: DataFrame) -> DataFrame:
    """Like cut(), as Parquet: for wide or many rows, which it compresses. The files go when the driver ends, or by discard()."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    remove_at_exit(spark, path)
    made = spark.read.parquet(path)
    _written[id(made)] = path
    return made


_written: dict[int, str] = {}


def discard(df: DataFrame) -> None:
    """Removes the files of a table of cut_parquet() that nothing reads any more."""
    if (path := _written.pop(id(df), None)) is not None:
        _remove(df.sparkSession, path)


def remove_at_exit(spark: SparkSession, path: str) -> None:
    atexit.register(_remove, spark, path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001  the session has ended already
        pass


def release(spark: SparkSession) -> None:
    """Lets go of shuffle files that nothing refers to any more: Spark removes them when the driver collects garbage, and a job of many
    steps would hold those of all its steps until then."""
    gc.collect()
    spark._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text (null: none)."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS + "+"))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """Columns k1, k2 that tell rows apart even where an id is repeated or null; never null."""
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)).cast("long")).alias("k1"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("k2")]


def join_stats(df: DataFrame, stats: DataFrame, keys: Sequence[str], rows: str, how: str = "left") -> DataFrame:
    """Joins statistics, a row a key, to the rows they are of; the column rows has the number of these, and isn't kept. Counted first: up to
    BROADCAST_ROWS statistics are broadcast. More are shuffled, and only keys of over HEAVY rows are dealt to SALTS tasks, so what is
    copied stays small beside the statistics; where heavy keys are too many to broadcast, AQE splits them."""
    if stats.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return df.join(F.broadcast(stats.drop(rows)), list(keys), how)
    heavy = stats.where(F.col(rows) > HEAVY).select(*keys, F.lit(True).alias("_heavy"))
    if heavy.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        return df.join(stats.drop(rows), list(keys), how)
    salt = F.when(F.col("_heavy"), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    dealt = df.join(F.broadcast(heavy), list(keys), "left").withColumn("_salt", salt).drop("_heavy")
    salts = F.when(F.col(rows) > HEAVY, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return dealt.join(stats.withColumn("_salt", F.explode(salts)).drop(rows), [*keys, "_salt"], how).drop("_salt")


def blocks_of(size: Column, most: int) -> Column:
    return F.greatest(F.ceil(size / most), F.lit(1)).cast("int")


def tiled(df: DataFrame, spread: Column) -> DataFrame:
    """Replaces the column blocks by block, i and j: a group's rows are dealt to its blocks, and each row goes to the tiles (i, j), i < j, of its
    block with every other one, so that any two rows of a group meet in a tile of two blocks; a group of one block is tile (0, 0)."""
    block = F.pmod(spread, "blocks").cast("int")
    pair = lambda c: F.struct(F.least(F.col("block"), c).alias("i"), F.greatest(F.col("block"), c).alias("j"))
    others = F.transform(F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda c: (c != F.col("block")) | (F.col("blocks") == 1)), pair)
    return df.withColumn("block", block).withColumn("_tile", F.explode(others)).withColumns({"i": F.col("_tile.i"), "j": F.col("_tile.j")}).drop("_tile", "blocks")


def labelled_sample(labels: DataFrame, column: str, bound: int, where: Column | None = None) -> DataFrame:
    """doc_id, y: up to bound labelled documents of either class, those with the least hash of their id; 2 * bound rows at most, so
    they may be broadcast. Null labels are left out; of repeated ones the larger counts."""
    own = labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull())
    own = (own if where is None else own.where(where)).groupBy("doc_id").agg(F.max(F.col(column).cast("int")).alias("y"))
    parts = [own.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound) for y in (0, 1)]
    return parts[0].unionByName(parts[1])


def fit_logistic(x, y, ridge: float = 1e-2, rounds: int = 60, balanced: bool = True):
    """Weights of a ridge-penalised logistic regression, the last one the intercept; balanced: classes count alike."""
    import numpy as np

    x = np.column_stack([x, np.ones(len(x))])
    each = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y) if balanced else np.ones(len(y))
    w = np.zeros(x.shape[1])
    penalty = ridge * np.append(np.ones(x.shape[1] - 1), 1e-6)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (each * (p - y)) / len(y) + penalty * w
        hess = (x * (each * p * (1 - p))[:, None]).T @ x / len(y) + np.diag(penalty + 1e-9)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w
