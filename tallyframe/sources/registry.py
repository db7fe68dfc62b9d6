"""Table registry: gives reports their input tables by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.session import tune
from tallyframe.sources.schemas import SCHEMAS
from tallyframe.sources.scratch import stored_bytes


class TableSet:
    """Named input tables, read lazily and with declared types.

    ``tables["fa_books"]`` returns a DataFrame with exactly the declared columns.  Build one from Parquet
    with :meth:`from_parquet` or from frames at hand with :meth:`from_frames`.
    """

    def __init__(self, spark: SparkSession, frames: dict[str, DataFrame]):
        self.spark = tune(spark)
        self._frames = {name.lower(): frame for name, frame in frames.items()}
        self._tables: dict[str, DataFrame] = {}
        self._opened: dict[str, int] = {}

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str) -> TableSet:
        """Tables stored as ``root/<table name>`` in Parquet; only the tables asked for are opened."""
        return _ParquetTables(spark, root)

    @classmethod
    def from_frames(cls, spark: SparkSession, frames: dict[str, DataFrame]) -> TableSet:
        return cls(spark, frames)

    def __getitem__(self, name: str) -> DataFrame:
        name = name.lower()
        if name not in SCHEMAS:
            raise KeyError(f"unknown table {name!r}")
        if name not in self._tables:
            self._tables[name] = self._load(name)
        return self._tables[name]

    def _load(self, name: str) -> DataFrame:
        if name not in self._frames:
            raise KeyError(f"table {name!r} was not supplied")
        return self.conform(name, self._frames[name])

    def _open(self, path: str, schema: T.StructType | None = None) -> DataFrame:
        """The Parquet files at ``path``.  Shuffles are dealt by the size of all files that the set has opened."""
        if path not in self._opened:
            self._opened[path] = stored_bytes(self.spark, path)
            tune(self.spark, sum(self._opened.values()))
        return (self.spark.read if schema is None else self.spark.read.schema(schema)).parquet(path)

    @staticmethod
    def schema(name: str) -> T.StructType:
        return T.StructType.fromDDL(SCHEMAS[name])

    @classmethod
    def conform(cls, name: str, frame: DataFrame) -> DataFrame:
        """Project ``frame`` to the declared columns and types of ``name``."""
        present = {column.lower(): field for column, field in zip(frame.columns, frame.schema.fields)}
        missing = [f.name for f in cls.schema(name) if f.name not in present]
        if missing:
            raise ValueError(f"table {name!r} lacks columns {missing}")
        return frame.select(
            *(
                F.col(present[f.name].name).alias(f.name)
                if present[f.name].dataType == f.dataType
                else F.col(present[f.name].name).cast(f.dataType).alias(f.name)
                for f in cls.schema(name)
            )
        )


class _ParquetTables(TableSet):
    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark, {})
        self._root = root.rstrip("/")

    def _load(self, name: str) -> DataFrame:
        return self._open(f"{self._root}/{name}", self.schema(name))
