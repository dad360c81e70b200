"""Raw sources: declared schemas, CSV/Parquet readers and test stand-ins."""

from emporium.sources.raw import columns_of, ingest, load, read_csv
from emporium.sources.schemas import RAW_SCHEMAS, RAW_TABLES

__all__ = ["RAW_SCHEMAS", "RAW_TABLES", "columns_of", "ingest", "load", "read_csv"]
