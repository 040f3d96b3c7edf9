"""Getting this package to the executors, and tables to the folder that all of them share."""

from __future__ import annotations

import gc
import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's source to all executors, once per application, so that Python tasks can import it."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    path = os.path.join(tempfile.mkdtemp(prefix="rangemap-"), "rangemap_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, str(Path(root.name) / p.relative_to(root)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a local session (driver and
    tasks in one process, as in tests) gets a temporary folder; on a cluster that would lose rows, so there it is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that the driver and all executors of {master} share")
        found = "file://" + tempfile.mkdtemp(prefix="rangemap-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


#: For tables whose rows have megabytes: row groups of few rows, since writers and readers hold a whole one of each task.
FEW_ROWS = {"parquet.block.size": 8 << 20, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 4}


def written(df: DataFrame, name: str, options: dict[str, int] | None = None) -> DataFrame:
    """Cut lineage: write the rows to the shared folder and read them back. A lost executor then costs its own tasks only.
    discard() deletes the table when what was made of it is written too. options: more options of the Parquet writer."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.options(**options or {}).option("compression", "zstd").parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found.written_to = path
    return found


def merged(df: DataFrame) -> DataFrame:
    """df as a side of a join that is merged at every size. Spark takes a table's size from its compressed files and does not
    count the rows that an explode makes, so of itself it collects tables of any true size on the driver and broadcasts them."""
    return df.hint("merge")


def discard(*tables: DataFrame) -> None:
    """Delete tables that written() returned and that no later step reads any more; others are left alone. Shuffle files of
    finished steps go as well."""
    for table in tables:
        path = getattr(table, "written_to", None) if "written_to" in vars(table) else None
        if path:
            jvm, context = table.sparkSession.sparkContext._jvm, table.sparkSession.sparkContext._jsc
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(context.hadoopConfiguration()).delete(folder, True)
    if tables:
        release(tables[0].sparkSession)


def release(spark: SparkSession) -> None:
    """Have Spark find out which shuffle files nothing refers to any more, and delete them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
