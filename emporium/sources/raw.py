"""Source registry and readers (A1-A3).

``load`` reads one named raw table with its declared schema, from Parquet when
an ingested copy exists and from CSV otherwise.  ``ingest`` converts CSV to
Parquet once: multi-line CSV cannot be split across tasks, Parquet can, and
Parquet gives the later scans column pruning and filter pushdown.  Paths go
through Hadoop's file systems, so HDFS, object stores and ``file://`` work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from emporium.session import path_exists
from emporium.sources.schemas import MULTILINE_TABLES, RAW_SCHEMAS


def _path(base: str, name: str, ext: str) -> str:
    return f"{base.rstrip('/')}/{name}.{ext}"


def _known(name: str) -> None:
    if name not in RAW_SCHEMAS:
        raise KeyError(f"unknown raw table {name!r}; known: {sorted(RAW_SCHEMAS)}")


def read_csv(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Read one raw CSV with its declared schema.

    Header line, UTF-8 BOM, CRLF endings and a last line without newline are
    handled by Spark's CSV reader.  The header must name the declared columns
    in order, and malformed rows fail the job (FAILFAST) instead of turning
    into silent nulls.
    """
    _known(name)
    return (
        spark.read.schema(RAW_SCHEMAS[name])
        .option("header", True)
        .option("enforceSchema", False)
        .option("encoding", "UTF-8")
        .option("multiLine", name in MULTILINE_TABLES)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .csv(path)
    )


def load(spark: SparkSession, base: str, name: str, fmt: str | None = None) -> DataFrame:
    """Scan raw table ``name`` under ``base`` (``<base>/<name>.parquet`` or ``.csv``).

    Raises ``FileNotFoundError`` if there is neither."""
    _known(name)
    formats = [fmt] if fmt else ["parquet", "csv"]
    found = next((f for f in formats if path_exists(spark, _path(base, name, f))), None)
    if found is None:
        raise FileNotFoundError(f"no {' or '.join(formats)} file of {name} in {base}")
    if found == "parquet":
        return spark.read.schema(RAW_SCHEMAS[name]).parquet(_path(base, name, "parquet"))
    return read_csv(spark, _path(base, name, "csv"), name)


def ingest(spark: SparkSession, csv_dir: str, parquet_dir: str, names: Sequence[str] | None = None) -> dict[str, str]:
    """Convert raw CSVs to Parquet once; returns name -> written path.

    All tables (or ``names``) must be there: a missing one raises before
    anything is written."""
    names = list(RAW_SCHEMAS) if names is None else list(names)
    for name in names:
        _known(name)
        if not path_exists(spark, _path(csv_dir, name, "csv")):
            raise FileNotFoundError(f"no csv file of {name} in {csv_dir}")
    written = {name: _path(parquet_dir, name, "parquet") for name in names}
    for name, target in written.items():
        read_csv(spark, _path(csv_dir, name, "csv"), name).write.mode("overwrite").parquet(target)
    return written


def columns_of(df: DataFrame) -> list[str]:
    """Column introspection of a table (A5)."""
    return list(df.schema.names)
