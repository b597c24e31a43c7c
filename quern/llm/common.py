"""What the text operators share: reading, durable intermediate tables, Arrow maps and joins with a small side."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quern.sources.tables import bucketed, dealt, durable, release, shared_dir, unique_path  # noqa: F401  shared with the modules here

#: Separators of words in every operator here: space and the five ASCII controls from tab to carriage return.
SEPARATORS = r"[\x20\x09-\x0D]+"
#: Rows of a side that is broadcast without being asked for; past it the join is salted.
BROADCAST_ROWS = 500_000

_shipped: set[str] = set()
_kept: list[Callable] = []


def kept(make: Callable) -> Callable:
    """make, whose results a Python worker keeps from task to task until let_go()."""
    _kept.append(cache(make))
    return _kept[-1]


def let_go(but: Callable | None = None) -> None:
    """For tasks that hold much themselves: gives back what tasks of other operators have kept in this worker, which stages share."""
    held = [make for make in _kept if make is not but and make.cache_info().currsize]
    for make in held:
        make.cache_clear()
    if held:
        gc.collect()
        give_back()


def give_back() -> None:
    """Gives memory that isn't in use any more back to the system, as a worker waits for its next task while other stages run."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once an application, so that their Python can import it."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    zipped = Path(tempfile.mkdtemp(prefix="quern-")) / "quern.zip"
    with zipfile.ZipFile(zipped, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(zipped))
    _shipped.add(sc.applicationId)


def arrow_map_all(df: DataFrame, steps: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str) -> DataFrame:
    """df through steps, a task's Arrow batches at a time; steps yields dicts of equally long lists or arrays by column of schema."""
    ship(df.sparkSession)
    out = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in steps(batches):
            yield pa.RecordBatch.from_arrays([x if isinstance(x := columns[f.name], pa.Array) and x.type == f.type else pa.array(x, type=f.type) for f in out], schema=out)

    return df.mapInArrow(run, schema)


def arrow_map(df: DataFrame, step: Callable[[pa.RecordBatch], Iterator[dict]], schema: str) -> DataFrame:
    """df through step, which takes one Arrow batch."""
    return arrow_map_all(df, lambda batches: (columns for batch in batches for columns in step(batch)), schema)


def slices(batch: pa.RecordBatch, limit: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about limit bytes at most (a single row may be larger)."""
    if not batch.num_rows:
        return
    rows = max(1, int(batch.num_rows * limit / max(1, batch.nbytes)))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def words(text: Column) -> Column:
    """Words of a text, in order; none for a null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    name, taken = f"__{name}", {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def join_small(left: DataFrame, right: DataFrame, on: str, how: str = "left", limit: int = BROADCAST_ROWS) -> DataFrame:
    """left joined with right, a durable table that has one row a key (nulls match nulls) and is mostly small.

    right is counted: up to limit rows it is broadcast. Beyond, both sides are shuffled by the key, and as one row of
    right meets any number of left's, the adaptive plan splits the rows of a hot key over tasks.
    """
    key = fresh(left, "key")
    right = right.withColumnRenamed(on, key)
    same = left[on].eqNullSafe(right[key])
    near = F.broadcast(right) if right.limit(limit + 1).count() <= limit else right.hint("merge")
    return left.join(near, same, how).drop(key)
