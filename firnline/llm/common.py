"""Shared pieces of the training-data operators: table access, shared scratch tables, label samples."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


ARROW_BATCH = "4m"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage: spark.checkpoint.dir, or, where that is unset, a folder under the warehouse. A
    warehouse on a machine's own disk will do for a local master only; on a cluster it is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        if not spark.sparkContext.master.startswith("local") and base.split(":", 1)[0] in (base, "file"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return base.rstrip("/")


def bounded(f: Callable) -> Callable:
    """A query or stage (spark, ...) whose lazy result runs with Arrow batches of at most ARROW_BATCH bytes."""

    @wraps(f)
    def run(spark: SparkSession, *args):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH)
        return f(spark, *args)

    return run


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of at most ARROW_BATCH bytes while jobs run, so that long texts do not add up in Python workers."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, ARROW_BATCH)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared scratch folder and read it back: the result has no lineage, so
    a lost executor costs a re-read and not a recomputation."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete materialized tables that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.scratch_path)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


class Sieve:
    """A Bloom filter as a table of 64-bit words: 16 bits a key and three bits of one word set by each, and at most
    MOST_WORDS words, so the table may be broadcast whatever the keys are. Rows that it lets through are then joined
    exactly; the others need not move. With more keys than it is made for it lets more rows through, at worst all."""

    MOST_WORDS = 1 << 19

    def __init__(self, keys: DataFrame, key: Column):
        wanted = 1 << max(6, (keys.count() // 4).bit_length())
        self.words = min(self.MOST_WORDS, wanted)
        word, bits = self._place(key)
        table = keys.select(word.alias("word"), bits.alias("bits")).groupBy("word").agg(F.bit_or("bits").alias("bits"))
        self.table = materialize(table, "sieve")

    def _place(self, key: Column) -> tuple[Column, Column]:
        bit = lambda salt: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(F.lit(salt), key), F.lit(64)).cast("int"))
        return F.pmod(F.xxhash64(F.lit(-1), key), F.lit(self.words)), bit(0).bitwiseOR(bit(1)).bitwiseOR(bit(2))

    def marked(self, df: DataFrame, key: Column, out: str) -> DataFrame:
        """df with a boolean column: whether the key may be one of the keys (it is not, where this is false)."""
        w, b = free_names(df, "sieve_word", "sieve_bits")
        word, bits = self._place(key)
        joined = df.join(F.broadcast(self.table.select(F.col("word").alias(w), F.col("bits").alias(b))), word == F.col(w), "left")
        return joined.withColumn(out, F.coalesce(F.col(b).bitwiseAND(bits) == bits, F.lit(False))).drop(w, b)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names like the wanted ones that no column of df has, in whatever case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> str:
    """A column's name as select() takes it, dots and backticks included."""
    return "`" + name.replace("`", "``") + "`"


def split_mod(id_col: str, mod: int) -> Column:
    """crc32 of the id's decimal text, modulo mod (the held-out rule of the query contracts)."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(mod).cast("long"))


def class_sizes(df: DataFrame, label_col: str, most: int = 1024) -> dict:
    """Rows of each label; more than `most` labels are an error, so that what the driver holds is bounded."""
    rows = df.groupBy(F.col(label_col).alias("label")).agg(F.count("*").alias("n")).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} values of {label_col}")
    return {r["label"]: r["n"] for r in rows}


def sample_per_class(df: DataFrame, id_col: str, label_col: str, per_class: int, sizes: dict | None = None) -> DataFrame:
    """About per_class rows of each label (all, if there are fewer), chosen by a hash of the id: the choice depends
    neither on partitioning nor on other rows, and no label is gathered or sorted."""
    sizes = class_sizes(df, label_col) if sizes is None else sizes
    share = F.lit(0.0)
    for label, n in sorted(sizes.items(), key=lambda x: str(x[0])):
        if label is not None and n:
            share = F.when(F.col(label_col) == F.lit(label), F.lit(min(1.0, per_class / n))).otherwise(share)
    return df.filter(F.pmod(F.xxhash64(id_col), F.lit(1 << 32)) < share * float(1 << 32))
