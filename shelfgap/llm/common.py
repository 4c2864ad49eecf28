"""What the operators of this subpackage share: words, keys, shared folders."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run without ASCII white space. ``bytes.split()`` cuts the same words.
WORD = r"[^\x20\x09-\x0D]+"

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see.

    It is the one of ``spark.checkpoint.dir``; where that is unset, one in the warehouse.
    """
    found = spark.conf.get(_CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    return (found or f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints").rstrip("/")


def new_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows as files of the shared folder; what made them is not run again."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def remainder(doc_id: Column, parts: int = 5) -> Column:
    """crc32 of the decimal text of the id, modulo ``parts``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def n_words(text: Column) -> Column:
    """How many words the text has; none if it is NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts, from one scan."""
    row = docs.agg(F.sum(F.octet_length(F.col(text)).cast("long")).alias("n")).first()
    return row["n"] or 0


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table of the shared folder."""
    path = new_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


_CODE = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def with_code(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``function``, whose first argument is the session, with Python workers that look for this
    package where the driver has it. A cluster whose machines do not have it there gets it by
    ``--py-files``."""

    @wraps(function)
    def run(spark: SparkSession, *args: object) -> DataFrame:
        env = spark.sparkContext.environment
        paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
        if _CODE not in paths:
            env["PYTHONPATH"] = os.pathsep.join([_CODE, *paths])
        return function(spark, *args)

    return run
