"""Schemas of parquet files, read from their footers by the tasks.

``file_schemas`` gives one row per file; ``schema_groups`` brings the files of one schema
together in Spark and merges what can be read as one frame. The driver opens no file, and an
explicit schema spares the reader its own inference.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmart.session import importable

#: Footer entry in which Spark leaves a file's own schema.
_SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"
# The signed types Spark reads unsigned parquet integers as.
_UNSIGNED = {"uint8": T.ShortType(), "uint16": T.IntegerType(), "uint32": T.LongType(), "uint64": T.DecimalType(20, 0)}
FILE_SCHEMA_DDL = "path string, schema string, fingerprint string"


def footer_schema(uri: str) -> T.StructType:
    """A file's columns as Spark reads them. Only the footer is read."""
    import pyarrow.parquet as pq
    from pyarrow import fs
    from pyspark.sql.pandas.types import from_arrow_type

    store, path = fs.FileSystem.from_uri(uri)
    with store.open_input_file(path) as source:
        file = pq.ParquetFile(source)
        own = (file.metadata.metadata or {}).get(_SPARK_SCHEMA)
        if own:
            return T.StructType.fromJson(json.loads(own))
        columns = {file.schema.column(k).path: file.schema.column(k) for k in range(len(file.schema))}
        out = T.StructType()
        for f in file.schema_arrow:
            leaf = columns.get(f.name)
            if leaf is not None and leaf.physical_type == "INT96":
                kind: T.DataType = T.TimestampType()
            else:
                kind = _UNSIGNED.get(str(f.type)) or from_arrow_type(f.type, prefer_timestamp_ntz=True)
            out.add(f.name, kind)
        return out


def fingerprint(schema: T.StructType) -> str:
    """Equal for schemas with the same columns and types, in any order or case (what may be
    null doesn't count: Spark reads any column as nullable)."""
    columns = sorted((f.name.lower(), f.dataType.simpleString()) for f in schema.fields)
    return hashlib.sha256(json.dumps(columns).encode()).hexdigest()


def _read_footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths = batch.column(0).to_pylist()
        found = [footer_schema(p) for p in paths]
        yield pa.RecordBatch.from_pydict(
            {"path": paths, "schema": [s.json() for s in found], "fingerprint": [fingerprint(s) for s in found]}
        )


def file_schemas(files: DataFrame) -> DataFrame:
    """``path, schema, fingerprint`` for each row's ``path``; the tasks open the files."""
    importable(files.sparkSession)
    return files.select("path").mapInArrow(_read_footers, FILE_SCHEMA_DDL)


@dataclass
class SchemaGroup:
    """Files that one frame can be read from: no column has two types among them."""

    columns: dict[str, T.StructField] = field(default_factory=dict)
    paths: list[str] = field(default_factory=list)

    @property
    def schema(self) -> T.StructType:
        return T.StructType(list(self.columns.values()))

    def takes(self, schema: T.StructType) -> bool:
        own = {name: f.dataType.simpleString() for name, f in self.columns.items()}
        return all(own.get(f.name.lower(), kind) == kind for f in schema.fields for kind in [f.dataType.simpleString()])

    def add(self, schema: T.StructType, paths: list[str]) -> None:
        for f in schema.fields:
            self.columns.setdefault(f.name.lower(), T.StructField(f.name, f.dataType))
        self.paths += paths


def schema_groups(schemas: DataFrame) -> list[SchemaGroup]:
    """The files of a :func:`file_schemas` frame by what can be read together.

    Files are grouped by fingerprint in Spark; a row per distinct schema comes to the driver,
    with the paths that the reader is then given. Schemas that differ only in which columns
    they have make one group (a column that a file lacks is NULL there)."""
    rows = schemas.groupBy("fingerprint").agg(
        F.min(F.struct("path", "schema"))["schema"].alias("schema"), F.sort_array(F.collect_list("path")).alias("paths")
    ).collect()
    groups: list[SchemaGroup] = []
    for row in sorted(rows, key=lambda r: r.paths[0]):
        schema = T.StructType.fromJson(json.loads(row.schema))
        group = next((g for g in groups if g.takes(schema)), None)
        if group is None:
            groups.append(group := SchemaGroup())
        group.add(schema, list(row.paths))
    return groups
