"""Reading snapshot files, and the few file-system calls a table needs, on any Hadoop-supported store."""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakehist.functions.changes import quoted


# Formats whose files do not say what they hold; anything else brings its own schema along.
_UNTYPED = ("csv", "json", "text")


def read_snapshot(
    spark: SparkSession, path: str, schema: StructType, format: str = "parquet", **options: str
) -> DataFrame:
    """A full snapshot, cast to its declared schema.

    A missing path raises ``AnalysisException``. So does a missing column: reading it as NULL would pass
    an incomplete extract off as a change to every row. Casts follow the session's ANSI setting, and cost
    nothing where the types already agree.
    """
    reader = spark.read.format(format).options(**options)
    rows = (reader.schema(schema) if format in _UNTYPED else reader).load(path)
    return rows.select(*[F.col(quoted(f.name)).cast(f.dataType).alias(f.name) for f in schema])


def literal(path: str) -> str:
    """``path`` for a reader that takes patterns, with nothing in it read as one."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def names(spark: SparkSession, path: str) -> list[str]:
    """What a directory holds, by one listing; nothing if there is no such directory."""
    fs, hadoop_path = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def touch(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.create(hadoop_path, True).close()


def claim(spark: SparkSession, path: str) -> None:
    """Create an empty file, or raise ``FileExistsError``: of several that try, one gets it.

    This is the store's own atomic create. Hadoop's for local files looks first and creates then, so Java's stands in.
    """
    fs, hadoop_path = _file_system(spark, path)
    fs.mkdirs(hadoop_path.getParent())
    if fs.getUri().getScheme() == "file":
        created = spark._jvm.java.io.File(hadoop_path.toUri().getPath()).createNewFile()
    else:
        try:
            fs.create(hadoop_path, False).close()
            created = True
        except Py4JJavaError as refused:  # which exception says so differs from store to store
            if not fs.exists(hadoop_path):
                raise
            raise FileExistsError(path) from refused
    if not created:
        raise FileExistsError(path)


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, True)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name under the cluster's ``spark.checkpoint.dir``, or under the warehouse where that is unset.

    Both are folders that driver and executors share; a folder of one machine never stands in.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{shared.rstrip('/')}/lakehist-{purpose}-{uuid.uuid4().hex}"
