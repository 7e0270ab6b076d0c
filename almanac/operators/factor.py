"""Spectra of matrices whose rows lie all over the cluster: a QR factorisation in blocks of rows that meet in a tree.

The R of a stack of blocks is the R of their stacked Rs, and a matrix has the singular values of its R. Every task
folds its rows into one small triangle a matrix; triangles meet ``FAN`` at a time. No row is
shuffled and no task sees more than its own rows and ``FAN`` triangles at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Triangles that meet in one step, and matrices whose triangles a task holds at once.
FAN, HELD = 16, 256


def _fold(r: np.ndarray | None, rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows if r is None else np.vstack([r, rows]), mode="r")


def _array(column: pa.Array, width: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    if len(x) != len(column) * width:
        raise ValueError(f"rows that don't have {width} columns")
    return x.reshape(-1, width)


def spectra(rows: DataFrame, matrix: str, vector: str, columns: int, fan: int = FAN) -> DataFrame:
    """(matrix, spectrum): singular values, greatest first, of the matrices whose rows are ``vector``, of ``columns`` numbers each.

    A matrix may have any number of rows in any order; one with fewer rows than columns has as many values as rows.
    NULL rows don't count; rows of another size are an error.
    """
    kind = rows.schema[matrix].dataType.simpleString()
    held = rows.select(F.col(matrix).alias("matrix"), F.col(vector).cast("array<double>").alias("v")).where("v IS NOT NULL")
    schema = f"matrix {kind}, node long, height int, r binary"
    as_row = lambda key, node, r: {"matrix": key, "node": node, "height": len(r), "r": np.ascontiguousarray(r).tobytes()}

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, have, fields = TaskContext.get().partitionId(), {}, None
        for b in batches:
            fields = pa.schema([pa.field("matrix", b.schema.field(0).type), ("node", pa.int64()), ("height", pa.int32()), ("r", pa.binary())])
            keys, x = b.column(0).dictionary_encode(null_encoding="encode"), _array(b.column(1), columns)
            codes = keys.indices.to_numpy()
            for c, key in enumerate(keys.dictionary.to_pylist()):
                have[key] = _fold(have.get(key), x[codes == c])
            if len(have) > HELD:
                yield pa.RecordBatch.from_pylist([as_row(k, node, r) for k, r in have.items()], fields)
                have = {}
        if have:
            yield pa.RecordBatch.from_pylist([as_row(k, node, r) for k, r in have.items()], fields)

    def meet(t: pa.Table) -> pa.Table:
        r = None
        for x, h in zip(t["r"].to_pylist(), t["height"].to_pylist(), strict=True):
            r = _fold(r, np.frombuffer(x).reshape(h, columns))
        return pa.Table.from_pylist([as_row(t["matrix"][0].as_py(), t["node"][0].as_py() // fan, r)], t.schema)

    def end(t: pa.Table) -> pa.Table:
        r = np.frombuffer(meet(t)["r"][0].as_py()).reshape(-1, columns)
        return pa.table({"matrix": t["matrix"].slice(0, 1), "spectrum": pa.array([np.linalg.svd(r, compute_uv=False).tolist()], pa.list_(pa.float64()))})

    parts, nodes = held.mapInArrow(local, schema), held.rdd.getNumPartitions()
    while nodes > fan:
        parts = parts.groupBy("matrix", F.floor(F.col("node") / fan)).applyInArrow(lambda key, t: meet(t), schema)
        nodes = -(-nodes // fan)
    return parts.groupBy("matrix").applyInArrow(end, f"matrix {kind}, spectrum array<double>").withColumnRenamed("matrix", matrix)
