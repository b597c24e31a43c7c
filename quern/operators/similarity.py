"""Exact threshold join of vectors by a metric index: blocks of rows near one pivot, compared where their angles to all pivots allow a link."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.sources.tables import durable, release

#: Pivots at most, and rows of a block. Both change how much is compared, and no result.
PIVOTS, BLOCK = 512, 1024
#: Angles are computed with errors below this: an angle's cosine has an error of some 1e-15, and near 1 the angle that of its root.
_SLACK = 1e-6
#: Cosines are computed from unit vectors with errors below this; what is as near to the threshold is decided by the plain formula.
_CLOSE = 1e-10


def unit_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, width, unit, v): vectors of length 1, and vectors scaled by a power of two to parts of 1 at most, as little-endian 64-bit floats.

    Rows without a direction, or with null or non-finite parts, are left out.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(F.coalesce(F.size("v"), F.lit(0)) > 0)
    rows = rows.where(F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < F.lit(math.inf)) & ~F.isnan(x)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, widths, units, scaled = [], [], [], []
            for i, v in enumerate(batch.column(1).to_pylist()):
                x = np.array(v)
                top = np.abs(x).max()
                if top > 0:  # scaled first, so that no square leaves the range of floats
                    at.append(i)
                    widths.append(len(x))
                    scaled.append(np.ldexp(x, -np.frexp(top)[1]).astype("<f8").tobytes())
                    x = x / top
                    units.append((x / np.sqrt((x * x).sum())).astype("<f8").tobytes())
            columns = [pa.array(widths, pa.int32()), pa.array(units, pa.binary()), pa.array(scaled, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *columns], ["id", "width", "unit", "v"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, width int, unit binary, v binary")


def _homes(rows: DataFrame, pivots: dict[int, np.ndarray], angle: float) -> DataFrame:
    """rows (cls, width, v) with the cell of their nearest pivot, and their ring in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column("width").to_numpy()
            for width in np.unique(widths):
                own = batch.take(pa.array(np.flatnonzero(widths == width)))
                x = np.frombuffer(b"".join(own.column("v").to_pylist()), "<f8").reshape(-1, width)
                near = (x / np.sqrt((x * x).sum(axis=1))[:, None]) @ pivots.get(int(width), np.zeros((1, width))).T
                ring = np.floor(np.arccos(np.clip(near.max(axis=1), -1, 1)) / angle)
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(near.argmax(axis=1), pa.int32()), pa.array(ring, pa.int32())], ["cls", "width", "v", "cell", "ring"])

    return rows.select("cls", "width", "v").mapInArrow(run, f"cls {rows.schema['cls'].dataType.simpleString()}, width int, v binary, cell int, ring int")


def _bounded(packed: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Blocks (at, width, ids, vs) with the least and the largest of their rows' angles to each pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, high = [], []
            for width, vs in zip(batch.column("width").to_pylist(), batch.column("vs").to_pylist(), strict=True):
                x = np.frombuffer(vs, "<f8").reshape(-1, width)
                angles = np.arccos(np.clip((x / np.sqrt((x * x).sum(axis=1))[:, None]) @ pivots.get(width, np.zeros((1, width))).T, -1, 1))
                low.append(angles.min(axis=0))
                high.append(angles.max(axis=0))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(low, pa.list_(pa.float64())), pa.array(high, pa.list_(pa.float64()))], ["at", "width", "ids", "vs", "low", "high"])

    kind = packed.schema["ids"].dataType.simpleString()
    return packed.select("at", "width", "ids", "vs").mapInArrow(run, f"at string, width int, ids {kind}, vs binary, low array<double>, high array<double>")


def _angle(threshold: float) -> float:
    return math.acos(max(-1.0, min(1.0, threshold))) + _SLACK


def _pivots(units: DataFrame, directions: int, pivots: int) -> dict[int, np.ndarray]:
    """Unit vectors by width, of `pivots` directions at most."""
    many = min(pivots, max(1, math.isqrt(directions) // 2))
    chosen: dict[int, list[bytes]] = {}
    for r in units.select("width", "unit", "key").dropDuplicates(["width", "key"]).orderBy("key", "width").limit(many).collect():
        chosen.setdefault(r["width"], []).append(bytes(r["unit"]))
    return {w: np.frombuffer(b"".join(us), "<f8").reshape(-1, w) for w, us in chosen.items()}


def _linked(rows: DataFrame, own: dict[int, np.ndarray], threshold: float, block: int) -> DataFrame:
    """(x, y, similarity): each two of the rows (cls, width, v) within the threshold, once and in any order."""
    angle = _angle(threshold)
    homes = durable(_homes(rows, own, angle), "homes")
    group = ["width", "cell", "ring"]
    few = homes.groupBy(*group).count()  # pivots * rings rows at most
    place = F.xxhash64("v", F.monotonically_increasing_id())  # of a table's row, so that copies are dealt over parts too
    dealt = homes.withColumn("place", place).join(F.broadcast(few), group).withColumn("part", F.pmod("place", F.ceil(F.col("count") / block)))
    packed = dealt.groupBy(*group, "part").agg(F.collect_list(F.struct("cls", "v")).alias("rows"))
    packed = packed.select(F.concat_ws(":", *group, "part").alias("at"), "width", F.col("rows.cls").alias("ids"), F.unhex(F.array_join(F.transform("rows.v", F.hex), "")).alias("vs"))
    blocks = durable(_bounded(packed, own), "blocks")
    release(homes)
    close = _CLOSE

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                width, same, ids_a, vs_a, ids, vs = (batch.column(k)[i] for k in range(6))
                x = np.frombuffer(vs_a.as_py(), "<f8").reshape(-1, width.as_py())
                y = np.frombuffer(vs.as_py(), "<f8").reshape(-1, width.as_py())
                s = (x / np.sqrt((x * x).sum(axis=1))[:, None]) @ (y / np.sqrt((y * y).sum(axis=1))[:, None]).T
                p, q = np.nonzero(s >= threshold - close)
                if same.as_py():
                    p, q = p[p < q], q[p < q]
                found = np.clip(s[p, q], -1, 1)
                near = np.flatnonzero(found < threshold + close)
                for at in range(0, len(near), 1 << 16):  # products part by part, in order
                    some = near[at : at + (1 << 16)]
                    dot, u, v = np.zeros((3, len(some)))
                    for k in range(x.shape[1]):
                        left, right = x[p[some], k], y[q[some], k]
                        dot, u, v = dot + left * right, u + left * left, v + right * right
                    found[some] = np.clip(dot / np.sqrt(u * v), -1, 1)
                good = found >= threshold
                yield pa.RecordBatch.from_arrays([ids_a.values.take(pa.array(p[good])), ids.values.take(pa.array(q[good])), pa.array(found[good])], ["x", "y", "similarity"])

    kind = homes.schema["cls"].dataType.simpleString()
    x, y = blocks.withColumnsRenamed({c: f"{c}_a" for c in blocks.columns}), blocks
    parted = lambda low, high: F.exists(F.zip_with(low, high, lambda u, v: u - v), lambda gap: gap > angle + _SLACK)
    meet = (F.col("width_a") - F.col("width") == 0) & (F.col("at_a") <= F.col("at")) & ~parted("low_a", "high") & ~parted("low", "high_a")
    met = x.crossJoin(y).where(meet)  # of blocks, not rows; a join on their width would put all into one task
    return met.select("width", (F.col("at_a") == F.col("at")).alias("same"), "ids_a", "vs_a", "ids", "vs").mapInArrow(compare, f"x {kind}, y {kind}, similarity double")


def vector_links(df: DataFrame, id_col: str, vector_col: str, threshold: float, pivots: int = PIVOTS, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Exact cosine join: (id, cls) membership and (a, b, similarity) links between classes of equal directions, a before b.

    cls is the least id with the direction; within a class all are as good as equal. Rows without a direction are in no
    class, vectors of different widths never link. Each class is stored once, in a block of rows near one pivot. By the
    triangle inequality two that link differ by no more than the threshold's angle in their angles to every pivot, so
    two blocks are compared, in one matrix product, unless a pivot parts them. Pairs of blocks are read from the table of
    blocks as they are compared, and nothing is copied for them: the disk grows with the rows, the work with the pairs
    of blocks that nothing parts, which for vectors without clusters are all. Pivots are a sample of bounded size; which
    ones they are decides only how much is compared. Cosines next to the threshold are decided by the plain formula.
    """
    units = durable(unit_vectors(df, id_col, vector_col).withColumn("key", F.sha2("unit", 256)), "units")
    firsts = durable(units.groupBy("width", "key").agg(F.min("id").alias("cls")), "directions")
    members = units.select("id", "width", "key").join(firsts, ["width", "key"]).select("id", "cls")
    classes = units.join(firsts.withColumnRenamed("cls", "id"), ["width", "key", "id"], "left_semi").dropDuplicates(["width", "key"]).select(F.col("id").alias("cls"), "width", "v")
    pairs = _linked(classes, _pivots(units, firsts.count(), pivots), threshold, block)
    return members, pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "similarity")


def vector_pairs(df: DataFrame, id_col: str, vector_col: str, threshold: float, pivots: int = PIVOTS, block: int = BLOCK) -> DataFrame:
    """(a, b, similarity): all pairs of rows within the threshold, copies and repeated rows included, with a before b.

    As vector_links(), but each row is compared itself, so that equal directions give all their pairs. Rows without an
    id, and pairs of one id, are left out. Copies lie in several blocks, so that their pairs are dealt over tasks as well.
    """
    units = durable(unit_vectors(df, id_col, vector_col).where("id IS NOT NULL").withColumn("key", F.sha2("unit", 256)), "units")
    directions = units.select("width", "key").distinct().count()
    pairs = _linked(units.select(F.col("id").alias("cls"), "width", "v"), _pivots(units, directions, pivots), threshold, block)
    return pairs.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "similarity")
