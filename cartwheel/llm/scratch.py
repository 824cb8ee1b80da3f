"""Intermediate tables in the shared folder.

A staged table cuts the lineage the way ``checkpoint()`` does: it is written
under ``spark.checkpoint.dir`` (which every executor sees), so a lost executor
costs a re-read and never a recomputation of the steps before it.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from cartwheel.config import shared_dir


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to a fresh shared folder and read it back."""
    return stage_at(df, name)[0]


def stage_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``stage`` with the folder, which ``config.remove_dir`` removes once
    nothing reads it."""
    spark = df.sparkSession
    path = shared_dir(spark, "llm", name, unique=True)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """At most ``rows`` rows in an Arrow batch of the jobs run inside (long
    texts in batches of the usual 10,000 rows cost each task a multiple of
    their size, on both sides)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of ``df`` has them (Spark does not
    tell upper from lower case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a given table."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def tokenizer_path(name: str) -> str:
    """Where the public tokenizer file of that name is installed."""
    import public_tokenizers

    return public_tokenizers.path(name)
