"""Features and validity from a caller's own function, row by row in Python.

The caller passes a factory.  Every task calls it once, so what it builds (a
parser, a model, a compiled pattern) is built per task and not per row.  Rows
travel as Arrow batches.  A row whose function raises, or gives None, has no
result: NULL features, not valid.  It stays a row, so that it can be counted.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tanimart.operators import fingerprints as fpo
from tanimart.session import ship

Featuriser = Callable[[str], Iterable[str] | None]
Validator = Callable[[str], bool | None]


def _applied(df: DataFrame, text_col: str, name: str, kind: T.DataType, arrow: pa.DataType, make: Callable[[], Callable], shape: Callable) -> DataFrame:
    """``df`` with a column of ``shape(function(text))``; NULL where the text is
    NULL or the function fails."""
    ship(df.sparkSession)
    at = df.columns.index(text_col)
    schema = T.StructType([*df.schema.fields, T.StructField(name, kind)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            values = []
            for text in batch.column(at).to_pylist():
                try:
                    found = None if text is None else function(text)
                    values.append(None if found is None else shape(found))
                except Exception:  # noqa: BLE001 - whatever a row's text makes the function raise
                    values.append(None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, arrow)], names=schema.names)

    return df.mapInArrow(run, schema)


def featurised(df: DataFrame, make: Callable[[], Featuriser], text_col: str = "text", name: str = "features") -> DataFrame:
    """``df`` with ``name``: ARRAY<STRING> of ``make()(text)``.

    ``make`` itself must not fail: that is an error of the job."""
    return _applied(df, text_col, name, T.ArrayType(T.StringType()), pa.list_(pa.string()), make, lambda found: [None if f is None else str(f) for f in found])


def validated(df: DataFrame, make: Callable[[], Validator], text_col: str = "text", name: str = "is_valid") -> DataFrame:
    """``df`` with the boolean ``name``: false also where the function fails."""
    rows = _applied(df, text_col, name, T.BooleanType(), pa.bool_(), make, bool)
    return rows.withColumn(name, F.coalesce(name, F.lit(False)))


def fingerprints(df: DataFrame, make: Callable[[], Featuriser], id_col: str = "mol_id", text_col: str = "text",
                 failed: Observation | None = None) -> DataFrame:
    """(mol_id, fp, n_bits) from a caller's featuriser; entries that fail or have
    no feature are dropped and observed as ``failed_rows``."""
    rows = featurised(df.select(id_col, text_col), make, text_col)
    return fpo.fingerprints(rows, id_col, features=F.col("features"), failed=failed)
