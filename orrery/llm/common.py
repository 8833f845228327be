"""What the operators of this subpackage share: input columns, scratch tables and word rules."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def lower_words(text: str | None) -> list[bytes]:
    """Words of a text, A-Z lower-cased, in UTF-8: runs of characters other than x20 and x09-x0D, which is what bytes are split at."""
    return text.encode().translate(_LOWER).split() if text else []


def hashed_sample(rows: DataFrame, key: str, bound: int) -> DataFrame:
    """At most `bound` rows, those with the least hashes of their key: a share that is a little too large is thinned out where it lies, then ordered."""
    n = rows.count()
    if n > 2 * bound:
        h = F.pmod(F.xxhash64(key, F.lit(3)), F.lit(1 << 40))
        rows = rows.where(h < int((1 << 40) * min(1.0, 1.3 * bound / n)))
    return rows.orderBy(F.xxhash64(key, F.lit(3)), key).limit(bound)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test data."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text", *more: str) -> DataFrame:
    """Only the columns that are needed, with null texts as empty ones."""
    return docs.select(F.col(key).cast("long").alias(key), F.coalesce(F.col(text), F.lit("")).alias(text), *more)


def held_out(key: Column | str, modulus: int) -> Column:
    """Whether crc32 of the key as text leaves 2; a null key is never held out."""
    key = F.col(key) if isinstance(key, str) else key
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(modulus)) == 2, F.lit(False))


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share. Where none is set a local session, as in tests, gets a temporary one; on a cluster that is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="orrery-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table in the shared folder: its lineage ends here and lost executors lose nothing."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes written tables that nothing reads any more, and lets the driver notice which shuffles nothing can read any more: until its next collection of garbage their files stay. The driver's Python gives back what it has freed."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    trim()
    tables[0].sparkSession._jvm.System.gc()


def slices(batch: pa.RecordBatch, column: int, rows: int, most: int = 1 << 25) -> Iterator[pa.RecordBatch]:
    """A batch in parts of at most `rows` rows and, unless one row is larger, `most` bytes of a text column."""
    size = np.cumsum(np.nan_to_num(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False).astype(float)))
    at = 0
    while at < batch.num_rows:
        before = size[at - 1] if at else 0.0
        end = min(at + rows, max(at + 1, int(np.searchsorted(size, before + most, "right"))))
        yield batch.slice(at, end - at)
        at = end


def trim() -> None:
    """Gives memory that a task or the driver has freed back to the system: workers outlive their tasks, and stages of a pipeline share them."""
    import ctypes

    pa.default_memory_pool().release_unused()
    if give_back := getattr(ctypes.CDLL(None), "malloc_trim", None):
        give_back(0)


def arrow_rows(rows: Iterable[tuple], schema: pa.Schema, size: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Tuples as record batches of at most `size` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)
        held = []
    trim()


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
