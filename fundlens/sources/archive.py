"""Moving handled landing files to an archive, so that an interrupted move is finished later.

The `files` table says which files a committed load has handled and when, so where each file
must go is known from the tables alone: <archive>/<its path below the landing folder>, with
__processed_<time of the load> before the suffix. Files are moved one by one, then recorded in the
`archived` table. After a crash in between, the next call finds a file moved but not recorded,
or not moved, and goes on.
"""

from __future__ import annotations

import re
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlens.sources.commits import snapshot
from fundlens.sources.loads import Load
from fundlens.sources.tables import SCHEMAS, read_loads, read_table


def handled_files(spark: SparkSession, root: str, load: Load | None = None) -> DataFrame:
    """Files that loads have handled and that still lie in the landing folder under that name.

    A file that was archived is left out: what has its name now is another file. `load`: the
    other loads' files.
    """
    files = read_table(spark, root, "files") if load is None else load.read("files")
    gone = read_table(spark, root, "archived").groupBy("file").agg(F.count(F.lit(1)).alias("times"))
    held = files.groupBy("file").agg(F.count(F.lit(1)).alias("loads")).join(gone, "file", "left")
    return held.where(F.col("loads") > F.coalesce("times", F.lit(0))).select("file")


def pending_moves(spark: SparkSession, root: str, incoming: str, archive: str) -> DataFrame:
    """file, load_id and target of handled files that are not recorded as archived."""
    at = snapshot(spark, root)
    files = read_loads(spark, root, "files", at=at).select("file", "load_id")
    done = read_table(spark, root, "archived", at=at).select("file", F.col("handled_by").alias("load_id"))
    times = read_loads(spark, root, "runs", at=at).select("load_id", "finished_at")
    landing = _qualified(spark, incoming)
    name = F.regexp_replace("file", "^file:/+", "file:/")  # local files are named in two ways
    below = F.substring(name, len(landing) + 1, 1 << 20)
    stamp = F.concat(F.lit("__processed_"), F.date_format("finished_at", "yyyyMMdd_HHmmss"))
    target = F.concat(F.lit(_qualified(spark, archive)), F.regexp_replace(below, r"\.[^./]*$", ""), stamp, F.regexp_extract(below, r"\.[^./]*$", 0))
    return files.where(name.startswith(landing)).join(done, ["file", "load_id"], "left_anti").join(times, "load_id").select("file", "load_id", target.alias("target"))


def _path(spark: SparkSession, uri: str):
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))


def _qualified(spark: SparkSession, folder: str) -> str:
    """A folder as the URI that its files' names begin with."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri().toString()
    return re.sub("^file:/+", "file:/", uri).rstrip("/") + "/"


def move(spark: SparkSession, file: str, target: str) -> bool:
    """Move a file unless it has been moved; False if it is neither here nor there."""
    source, goal = _path(spark, file), _path(spark, target)
    files = goal.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(goal):
        return True
    if not files.exists(source):
        return False
    files.mkdirs(goal.getParent())
    if not files.rename(source, goal):
        raise OSError(f"cannot move {file} to {target}")
    return True


def archive_handled(spark: SparkSession, root: str, incoming: str, archive: str) -> int:
    """Move all files that committed loads have handled; returns how many were recorded.

    A file that is no longer anywhere is recorded with a null target.
    """
    # names of handled files that are still to move, as many as the last loads had
    moves = [(r.file, r.load_id, r.target) for r in pending_moves(spark, root, incoming, archive).orderBy("file").collect()]
    if not moves:
        return 0
    done = [(file, load_id, target if move(spark, file, target) else None) for file, load_id, target in moves]
    record = Load(spark, root, f"archive-{uuid4().hex}")
    record.write(spark.createDataFrame(done, SCHEMAS["archived"]), "archived")
    record.commit()
    return len(done)
