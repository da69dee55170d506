"""What several operators of this subpackage share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.sources.folders import fresh


def reach(df: DataFrame) -> DataFrame:
    """df, after telling Python workers where this package lies, for sessions that were not started from its folder."""
    env, root = df.sparkSession.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))
    return df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def checkpoint(df: DataFrame, drop: DataFrame | None = None) -> DataFrame:
    """Cut lineage: df as a table written to the shared folder that spark.checkpoint.dir names, and read back.

    drop: an earlier result of this function that is not needed any more; its files are deleted.
    """
    spark = df.sparkSession
    path = fresh(spark)
    df.write.parquet(path)
    if drop is not None:
        jvm = spark.sparkContext._jvm
        old = jvm.org.apache.hadoop.fs.Path(drop.inputFiles()[0]).getParent() if drop.inputFiles() else None
        if old is not None:
            old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)
    return spark.read.schema(df.schema).parquet(path)


def one_thread() -> None:
    for name in ("OMP_NUM_THREADS", "OPENBLAS_NUM_THREADS", "RAYON_NUM_THREADS"):
        os.environ.setdefault(name, "1")
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


def append(df: DataFrame, text_col: str, fields: list[T.StructField], make: Callable[[], Callable[[list], list]], keep: Callable | None = None) -> DataFrame:
    """Add columns computed from the texts of each Arrow batch, without moving other columns through Python objects.

    make() runs once a task and gives a function from a list of texts (or None) to a list of columns.
    A column of the input whose name is that of an added one (in any case) is replaced.
    keep, if given, gets the list of added columns and gives a list of booleans: rows that stay;
    the added columns are then left out.
    """
    taken = {f.name.lower() for f in fields} if keep is None else set()
    at = next(i for i, f in enumerate(df.schema.fields) if f.name.lower() == text_col.lower())
    left = [i for i, f in enumerate(df.schema.fields) if f.name.lower() not in taken]
    schema = T.StructType([df.schema.fields[i] for i in left] + (fields if keep is None else []))
    arrow = to_arrow_schema(T.StructType(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = make()
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                columns = score(part.column(at).to_pylist())
                if keep is None:
                    yield pa.RecordBatch.from_arrays(
                        [part.column(i) for i in left] + [pa.array(c, type=arrow.field(k).type) for k, c in enumerate(columns)],
                        names=[f.name for f in schema.fields],
                    )
                else:
                    yield part.filter(pa.array(keep(columns), type=pa.bool_()))

    return reach(df).mapInArrow(run, schema)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of (a, b) long edges: (id, component), the smallest id reachable.

    Alternating large-star and small-star steps; every step is a shuffle on node ids, nothing is
    gathered, and the edge list is checkpointed after each round. Isolated nodes don't appear.
    Self loops are kept out; repeated edges and either direction are allowed.
    """
    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.hash("u", "v").cast("decimal(38,0)"))).first())

    pairs = checkpoint(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = state(pairs)
    for _ in range(rounds):
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        star = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))))
        pairs = checkpoint(large.join(low, "u").select(star.alias("e")).select("e.*").where("u <> v").distinct(), pairs)
        after = state(pairs)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    ends = pairs.select("v").distinct()
    return pairs.select(F.col("u").alias("id"), F.col("v").alias("component")).union(ends.select(F.col("v").alias("id"), F.col("v").alias("component")))
