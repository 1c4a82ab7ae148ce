"""Intermediate tables in the folder that the whole cluster shares."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Sequence
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from vitrine.session import shared_folder


@cache
def _local_folder() -> str:
    local = tempfile.TemporaryDirectory(prefix="vitrine-")
    atexit.register(local.cleanup)
    return local.name


def folder_for(spark: SparkSession, name: str) -> str:
    """A new folder's path in the shared folder.

    Only where spark.checkpoint.dir is unset, that is in local tests, a temporary folder serves that goes
    with the process; on a cluster each executor would write to its own disk, so there it is an error.
    """
    local = None
    if not spark.conf.get("spark.checkpoint.dir", None):
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the whole cluster shares")
        local = _local_folder()
    return f"{shared_folder(spark, local)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, by: Sequence[str] = (), **options) -> DataFrame:
    """`df` written to the shared folder, in one folder for each value of `by`, and read back.

    A lost executor then costs no more than the tasks after this point, what reads the table twice
    does not compute it twice, and Spark knows its size when it plans a join.
    """
    folder = folder_for(df.sparkSession, name)
    df.write.options(**options).partitionBy(*by).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def quoted(name: str) -> str:
    """A column name as a reference, whatever it holds."""
    return "`" + name.replace("`", "``") + "`"
