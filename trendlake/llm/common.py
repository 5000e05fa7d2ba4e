"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import hashlib
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.session import shared_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage with a Parquet table in the shared checkpoint folder.

    The table outlives a lost executor, is read back with column pruning, and
    lets adaptive execution see true sizes.
    """
    spark = df.sparkSession
    path = shared_path(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that clashes with none of ``df``'s (names
    are compared without case, as Spark resolves them)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def fold(id_col: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (null id: as '')."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % F.lit(modulus)


# Rows of whole texts are wide: Arrow batches hold this many unless the session
# names another number than Spark's default.
BATCH_ROWS = 4000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Prepare a session for Python workers: make this package importable in
    those of any cluster (as ``--py-files`` would), once for each session, and
    keep the batches of wide rows small."""
    context = spark.sparkContext
    if spark.conf.get(_BATCH_SETTING) == "10000":
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))
    root = Path(__file__).resolve().parents[2]
    files = sorted(Path(__file__).resolve().parents[1].rglob("*.py"))
    digest = hashlib.sha256()
    for f in files:
        digest.update(f.read_bytes())
    name = f"trendlake_{digest.hexdigest()[:12]}.zip"
    if name in context._python_includes:
        return
    path = os.path.join(tempfile.mkdtemp(prefix="trendlake-code-"), name)
    with zipfile.ZipFile(path, "w") as z:
        for f in files:
            z.write(f, f.relative_to(root).as_posix())
    context.addPyFile(path)


def releasing(run: Callable) -> Callable:
    """``run`` (a function over Arrow batches), after whose last batch freed
    memory goes back to the system. A worker is used again by the next
    operator, and what it keeps counts against the executor until then."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)   # of glibc
        if trim is not None:
            trim(0)
    return wrapped


def key_slices(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Rows that come sorted by their first ``keys`` columns, cut where one of
    these changes: (values of the keys, rows). A group of many rows comes in
    several slices."""
    for batch in batches:
        rows = batch.num_rows
        if not rows:
            continue
        change = None
        for i in range(keys):
            column = batch.column(i)
            differs = pc.not_equal(column.slice(1), column.slice(0, rows - 1))
            change = differs if change is None else pc.or_(change, differs)
        cuts = pc.indices_nonzero(change).to_numpy() + 1
        for x, y in zip([0, *cuts.tolist()], [*cuts.tolist(), rows]):
            yield tuple(batch.column(i)[x].as_py() for i in range(keys)), batch.slice(x, y - x)
