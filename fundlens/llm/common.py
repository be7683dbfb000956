"""Small helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens.session import fresh_folder, stored  # noqa: F401 (for the operators)

# A word is a run of characters other than ASCII white space (fixed value of the contracts).
WORD = r"[^\x20\x09-\x0D]+"

# Bytes of rows sent to a Python task together.
BATCH_BYTES = 4 << 20

_kept: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tagged(df: DataFrame, **names: str) -> DataFrame:
    """The columns of df as _0, _1, ... plus new=old columns; no name of df's can clash.

    A name that repeats means its first column. `untagged` gives the old columns back.
    """
    fresh = df.toDF(*(f"_{i}" for i in range(len(df.columns))))
    return fresh.select("*", *(fresh[f"_{df.columns.index(old)}"].alias(new) for new, old in names.items()))


def untagged(df: DataFrame, like: DataFrame) -> DataFrame:
    return df.select(*(f"_{i}" for i in range(len(like.columns)))).toDF(*like.columns)


def pick(df: DataFrame, **names: str) -> DataFrame:
    """Only the columns new=old of df."""
    return tagged(df, **names).select(*names)


def release(spark: SparkSession) -> None:
    """Let the session's cleaner drop checkpoints, broadcasts and shuffles that nothing uses any more,
    and let the driver return to the system what it has freed.

    It learns of them when the driver's heap is collected, which is rare on a driver that only
    plans. Operators that store many steps call this between phases. Python's references go
    first, as they keep plans; the C library would keep what the JVM freed outside its heap.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    trim_native(spark)


def trim_native(spark: SparkSession) -> bool:
    """Whether the driver's JVM could give back the memory that the C library holds for it (Linux, from Java 17.0.9 on)."""
    gateway, jvm = spark.sparkContext._gateway, spark.sparkContext._jvm
    lang, command = jvm.java.lang, ["systemTrimNativeHeap", None, None]
    kinds, values = gateway.new_array(lang.Class, 4), gateway.new_array(lang.Object, 4)
    try:
        for i, kind in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
            kinds[i] = lang.Class.forName(kind)
        for i, value in enumerate([jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), *command]):
            values[i] = value
        # by its interface, as the server's own class is not exported
        server = lang.Class.forName("javax.management.MBeanServerConnection")
        server.getMethod("invoke", kinds).invoke(lang.management.ManagementFactory.getPlatformMBeanServer(), values)
    except Py4JError:
        return False
    return True


def release_executors(spark: SparkSession) -> None:
    """`release`, and collect the garbage of the executors' heaps, which then shrink to what is in use.

    An executor that has filled its heap once would hold all of it beside its Python workers in
    every later phase. One short task per core; in local mode the driver's call has done it.
    """
    release(spark)
    sc = spark.sparkContext
    if not (sc.master == "local" or sc.master.startswith("local[")):
        n = sc.defaultParallelism
        spark.range(0, n, 1, n).select(F.expr("reflect('java.lang.System', 'gc')").alias("done")).write.format("noop").mode("overwrite").save()


def per_worker(key, build: Callable):
    """What `build` returns, once per Python worker and key; one value is kept per kind (key[0])."""
    kind, rest = key
    if _kept.get(kind, (None, None))[0] != rest:
        _kept[kind] = (rest, build())
    return _kept[kind][1]


def forget_kept() -> None:
    """Drop what tasks of other operators have left in this worker, before a task that needs the room."""
    _kept.clear()
    give_back()


def give_back() -> None:
    """Return to the system what this worker has freed; Arrow's pool and the C library would keep it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def bounded_batches(spark: SparkSession) -> None:
    """Send rows to Python in batches of BATCH_BYTES, unless the session has a limit of its own.

    The executor's JVM holds a batch for each core, and twice while it grows; 10,000 texts are tens
    of MB. Results do not depend on it. The setting stays, as the caller runs the plan.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))


def tidy(run: Callable) -> Callable:
    """A function for mapInArrow that gives memory back when its task ends: its worker may wait
    beside those of later stages, with all it held at its most."""

    def tidied(batches):
        yield from run(batches)
        give_back()

    return tidied


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(text, upper, upper.lower())


def doc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's text, modulo the number of folds; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds
