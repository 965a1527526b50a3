"""Helpers that several corpus operators share."""

from __future__ import annotations

import atexit
import ctypes
import functools
import gc
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType, StructType

#: A word is a maximal run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

SPAN = "struct<start:int,rank:int,end:int,kind:string,value:string>"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def free(name: str, *frames: DataFrame) -> str:
    """A helper column's name that no column of frames has."""
    taken = {c.lower() for f in frames for c in f.columns}
    out = f"__{name}"
    while out.lower() in taken:
        out += "_"
    return out


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where the cluster names none, a local one serves a local master only (tests)."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or getattr(spark, "_tidemill_shared", None)
    if not found:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^,\]]*(,[^,\]]*)?\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        found = spark._tidemill_shared = tempfile.mkdtemp(prefix="tidemill-")
        atexit.register(shutil.rmtree, found, ignore_errors=True)
    return found


def written(df: DataFrame, name: str) -> DataFrame:
    """df, stored as Parquet in the shared folder: a lost executor costs no recomputation beyond this point."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidemill/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.parquet(path)
    out._tidemill_path = path
    return out


def bucketed(df: DataFrame, key: str, name: str, buckets: int, compression: str = "snappy") -> DataFrame:
    """df as a table bucketed by key in the shared warehouse: later joins on key don't shuffle it."""
    spark = df.sparkSession
    table = f"tidemill_{name}_{uuid.uuid4().hex}"
    df.write.option("compression", compression).bucketBy(buckets, key).saveAsTable(table, format="parquet")
    out = spark.table(table)
    out._tidemill_table = table
    return out


def discard(*stored: DataFrame) -> None:
    """Deletes what written() or bucketed() stored. Nothing that is still to be computed may read it."""
    for df in stored:
        spark = df.sparkSession
        if table := getattr(df, "_tidemill_table", None):
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        if path := getattr(df, "_tidemill_path", None):
            jvm = spark.sparkContext._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def swept(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of plans that nothing refers to any more. It does so whenever the driver collects garbage,
    which a driver with little to do would put off while the files pile up."""
    gc.collect()  # Python's references to plans go first
    spark.sparkContext._jvm.System.gc()


def trim() -> None:
    """Gives memory that this process has freed back to the system."""
    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    give = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if give:
        give(0)


def trimmed(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """run, after whose last batch the worker is trimmed: workers stay for later stages, and would keep the most that any stage took."""

    @functools.wraps(run)
    def whole(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            trim()

    return whole


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.transform(F.array(value), body)[0]


def running(xs: Column, zero: Column, op) -> Column:
    """For each item, op over all items before it: in blocks of about the root of their number, so long arrays don't take quadratic time."""
    fold = lambda part: F.aggregate(part, zero, op)

    def blocks(items: Column) -> Column:
        def within(width: Column) -> Column:
            heads = F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / width).cast("int")), lambda n: fold(F.slice(items, n * width + 1, width)))
            before = let(heads, lambda h: F.transform(h, lambda _, n: fold(F.slice(h, F.lit(1), n))))

            def at(base: Column) -> Column:
                def one(_: Column, i: Column) -> Column:
                    n = F.floor(i / width).cast("int")
                    return op(base[n], fold(F.slice(items, n * width + 1, i - n * width)))

                return F.transform(items, one)

            return let(before, at)

        return let(F.ceil(F.sqrt(F.size(items).cast("double"))).cast("int"), within)

    return let(xs, lambda items: F.when(F.size(items) > 0, blocks(items)).otherwise(F.transform(items, lambda _: zero)))


def spans(text: Column, regex: str, kind: str, rank: int, ok=None) -> Column:
    """The matches of a Java regex (leftmost, not overlapping) that pass ok, as array<SPAN> in code points. text must be a plain column."""
    none = F.array().cast(f"array<{SPAN}>")

    def place(found: Column) -> Column:
        def with_gaps(gaps: Column) -> Column:
            def with_before(before: Column) -> Column:
                def span(v: Column, i: Column) -> Column:
                    start = before[i] + F.length(gaps[i])
                    return F.struct(start.alias("start"), F.lit(rank).alias("rank"), (start + F.length(v)).alias("end"), F.lit(kind).alias("kind"), v.alias("value"))

                return F.transform(found, span)

            steps = F.zip_with(gaps, found, lambda g, v: F.length(g) + F.length(v))
            return let(running(steps, F.lit(0), lambda x, y: x + y), with_before)

        every = let(F.slice(F.split(text, regex, -1), F.lit(1), F.size(found)), with_gaps)
        return every if ok is None else F.filter(every, lambda s: ok(s["value"]))

    return let(F.regexp_extract_all(text, F.lit(regex), F.lit(0)), lambda m: F.when(F.size(m) > 0, place(m)).otherwise(none))


def rendered(found: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")


def byte_size(df: DataFrame) -> int:
    """Bytes that the rows of df take in memory, at least; every string, binary and array counts with its length."""

    def of(c: Column, kind) -> Column:
        if isinstance(kind, (StringType, BinaryType)):
            return F.coalesce(F.octet_length(c), F.lit(0)).cast("long") + 16
        if isinstance(kind, ArrayType):
            if isinstance(kind.elementType, (StringType, BinaryType, ArrayType, StructType)):
                return F.coalesce(F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + of(x, kind.elementType)), F.lit(0)) + 16
            return F.coalesce(F.size(c), F.lit(0)).cast("long") * 8 + 16
        if isinstance(kind, StructType):
            return reduce(lambda a, f: a + of(c.getField(f.name), f.dataType), kind.fields, F.lit(8).cast("long"))
        return F.lit(8).cast("long")

    row = reduce(lambda a, f: a + of(F.col(f"`{f.name}`"), f.dataType), df.schema.fields, F.lit(16).cast("long"))
    return df.agg(F.sum(row)).first()[0] or 0


def bounded(df: DataFrame, limit: int = 8_000_000) -> DataFrame:
    """df with a broadcast hint if its rows take no more than limit bytes, else as it is (Spark then shuffles both sides and splits skew)."""
    return F.broadcast(df) if byte_size(df) <= limit else df
