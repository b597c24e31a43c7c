"""Vectors as codes of their parts; the nearest codebook entry is found among entries that slices of coordinates leave."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import arrow_map, arrow_map_all, durable, join_small, slices

#: Parts of a vector, entries of a part's codebook (64 at most, one bit each), rounds, and steps of a unit.
PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
_LONG, _LIMB = (1 << 63) - 1, 10**15


class Sliced:
    """The entries of one part's codebook, for exact search.

    Per dimension the entries' coordinates are sorted, and masks[d][i] has the bits of the i least. So the entries with
    a coordinate in a range are the difference of two masks, and those in the box around a vector are the AND over the
    dimensions. An entry within the radius of the box lies in it, so once the best one found is within the radius, no
    other is as near.
    """

    def __init__(self, entries: np.ndarray):
        self.entries = entries  # [entry, dimension]
        self.coordinates = np.sort(entries, axis=0).T
        bits = np.left_shift(np.uint64(1), np.argsort(entries, axis=0, kind="stable").T.astype(np.uint64))
        self.masks = np.zeros((entries.shape[1], len(entries) + 1), np.uint64)
        self.masks[:, 1:] = np.bitwise_or.accumulate(bits, axis=1)

    def box(self, x: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Bits of the entries in the box of each row of x."""
        found = np.full(len(x), (1 << len(self.entries)) - 1, np.uint64)
        for d, (coordinates, masks) in enumerate(zip(self.coordinates, self.masks, strict=True)):
            below = np.searchsorted(coordinates, x[:, d] - radius, "left")
            found &= masks[np.searchsorted(coordinates, x[:, d] + radius, "right")] ^ masks[below]
        return found

    def nearest(self, x: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each row of x, of equally near ones the first, and its squared distance.

        A box without entries is tried again with twice the radius; one whose best entry lies beyond the radius, with
        that entry's distance.
        """
        best, index = np.full(len(x), -1, x.dtype), np.zeros(len(x), np.int64)
        open_rows, wide = np.arange(len(x)), np.full(len(x), max(1, radius), x.dtype)
        while len(open_rows):
            rows, r = x[open_rows], wide[open_rows]
            found = self.box(rows, r)
            near, at = np.full(len(rows), -1, x.dtype), np.zeros(len(rows), np.int64)
            for k, entry in enumerate(self.entries):
                own = np.flatnonzero(found >> np.uint64(k) & np.uint64(1))
                distance = np.square(rows[own] - entry).sum(axis=1)
                less = (near[own] < 0) | (distance < near[own])
                near[own[less]], at[own[less]] = distance[less], k
            best[open_rows], index[open_rows] = near, at
            again = (near < 0) | (near > r * r)
            wide[open_rows] = np.where(near < 0, 2 * r, _root(near))
            open_rows = open_rows[again.astype(bool)]
        return index, best


def _root(squares: np.ndarray) -> np.ndarray:
    """The least whole numbers whose squares reach the given ones; what is below 0 counts as 0."""
    if squares.dtype == object:
        return np.array([0 if s <= 0 else math.isqrt(s - 1) + 1 for s in squares], object)
    out = np.sqrt(np.maximum(squares, 0).astype(np.float64)).astype(np.int64)
    return out + (out * out < squares)


def whole(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of floor(SCALE * x), 64-bit where squared distances surely fit, else exact Python numbers."""
    x = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE).reshape(-1, width)
    if not x.size or (2 * np.abs(x).max() + 2) ** 2 * max(1, width) < 2**62:
        return x.astype(np.int64)
    return np.array([[int(v) for v in row] for row in x], object)


def assigned(x: np.ndarray, books: list[np.ndarray], radii: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each part: its rows, their entries and squared distances."""
    for part, book, radius in zip(np.split(x, PARTS, axis=1), books, radii, strict=True):
        big = part.dtype == object or (2 * max((abs(int(v)) for v in book.flat), default=0) + 2) ** 2 * x.shape[1] >= 2**62
        own, entries = (part.astype(object), book.astype(object)) if big else (part, book.astype(np.int64))
        yield part, *Sliced(entries).nearest(own, radius)


def usable(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there and holds only finite components."""
    return df.where(F.col(vector).isNotNull() & F.forall(vector, lambda v: v.isNotNull() & (F.abs(v) < F.lit(math.inf)) & ~F.isnan(v)))


def train(rows: DataFrame, width: int, rounds: int = ROUNDS) -> tuple[list[np.ndarray], list[int]]:
    """Codebooks [entry, dimension] by part, after the rounds, and a typical distance by part, from rows (id, vector, ...) of one width.

    They start as the parts of the first ENTRIES rows by id, of equal ids by vector; nulls come last. In each round
    tasks add up what goes to each entry, so some ENTRIES * width sums a task are shuffled, and as many in all reach the driver.
    """
    first = rows.select("id", "vector").orderBy(F.col("id").asc_nulls_last(), "vector").limit(ENTRIES).toArrow()
    start = whole(first.column("vector").combine_chunks(), width)
    books, radii = [np.array(p, object) for p in np.split(start, PARTS, axis=1)], [1] * PARTS
    for _ in range(rounds):
        books, radii = _moved(rows.select("vector"), width, books, radii)
    return books, radii


def _limbs(v: int) -> list[int]:
    """A whole number of any size as parts to base _LIMB, with its sign; sums of each part are exact in Spark."""
    out, rest = [], abs(v)
    while rest:
        rest, low = divmod(rest, _LIMB)
        out.append(low if v > 0 else -low)
    return out


def _moved(rows: DataFrame, width: int, books: list[np.ndarray], radii: list[int]) -> tuple[list[np.ndarray], list[int]]:
    """Codebooks after one round, and the typical distances in it."""

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        size, d = len(books[0]), width // PARTS
        total = np.zeros((PARTS, size, d + 2), object)  # sums, distance, rows
        for batch in batches:
            for piece in slices(batch):
                for p, (part, at, distance) in enumerate(assigned(whole(piece.column(0), width), books, radii)):
                    for k in range(size):
                        own = at == k
                        if own.any():
                            total[p, k] += np.array([*part[own].sum(axis=0).tolist(), int(distance[own].sum()), int(own.sum())], object)
        out = [(*at, k, limb) for at in np.ndindex(*total.shape) for k, limb in enumerate(_limbs(total[at]))]
        yield dict(zip(("part", "entry", "at", "limb", "v"), zip(*out, strict=True), strict=True)) if out else dict.fromkeys(("part", "entry", "at", "limb", "v"), ())

    sums = arrow_map_all(rows, steps, "part int, entry int, at int, limb int, v long")
    found: dict[tuple[int, int], list[int]] = {}
    for r in sums.groupBy("part", "entry", "at", "limb").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect():  # PARTS * ENTRIES * (width / PARTS + 2) rows, times limbs
        found.setdefault((r["part"], r["entry"]), [0] * (width // PARTS + 2))[r["at"]] += int(r["v"]) * _LIMB ** r["limb"]
    books, d = [b.copy() for b in books], width // PARTS
    spread = [[0, 1] for _ in range(PARTS)]
    for (p, k), v in found.items():
        books[p][k] = [v[i] // v[d + 1] for i in range(d)]
        spread[p] = [spread[p][0] + v[d], spread[p][1] + v[d + 1]]
    return books, [max(1, math.isqrt(total // n)) for total, n in spread]


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(int(v)) for book in books for v in book.flat).encode()).hexdigest()


def encode(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of each row whose vector is there and finite.

    Components are floored to whole numbers, and all is exact from there. All vectors should have the width of the row
    with the least id, a multiple of PARTS; those of another width keep a row with null code and error, as all do where
    PARTS doesn't divide it. An error past 64 bits is null. Null labels are one label; repeated rows, ids and vectors
    each count; an empty table gives none. With fewer rows than ENTRIES the codebooks have as many entries as rows.
    Other columns are ignored, whatever their names.
    """
    spark = vectors.sparkSession
    rows = durable(usable(vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"), F.col(label_col).alias("label")), "vector"), "vectors")
    head = rows.orderBy(F.col("id").asc_nulls_last(), "vector").select(F.size("vector").alias("n")).first()
    width = head["n"] if head and head["n"] and head["n"] % PARTS == 0 else 0
    fits = F.size("vector") == width
    books, radii = train(rows.where(fits), width, rounds) if width else ([], [])

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        for piece in slices(batch):
            code, error = np.zeros((piece.num_rows, PARTS), np.int64), np.zeros(piece.num_rows, object)
            for p, (_, at, distance) in enumerate(assigned(whole(piece.column(1), width), books, radii)):
                code[:, p] = at
                error += distance.astype(object)
            yield {"id": piece.column(0), "label": piece.column(2), "code": ["".join(f"{v:02x}" for v in row) for row in code.tolist()], "error": [int(e) if e <= _LONG else None for e in error]}

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select("id", "label").schema)
    nothing = rows.where(~fits if width else F.lit(True)).select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    coded = arrow_map(rows.where(fits), step, f"{kinds}, code string, error long").unionByName(nothing) if width else nothing
    coded = durable(coded, "codes")
    sums = durable(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    out = join_small(coded, sums, "label").select(F.col("id").alias("vec_id"), "code", "error", "label_error")
    return out.withColumn("codebooks_sha256", F.lit(digest(books)))


_ROUND = """
d{r} AS (SELECT v.vec_id, v.part, c.entry, list_sum(list_transform(list_zip(v.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM parts v JOIN c{r} c USING (part)),
a{r} AS (SELECT vec_id, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM d{r} GROUP BY vec_id, part)"""
_MOVE = """
s{r} AS (SELECT part, a.entry, k, sum(x[k]) AS s, count(*) AS n FROM a{r} a JOIN parts USING (vec_id, part), (SELECT unnest(range(1, 9)) AS k) GROUP BY part, a.entry, k),
m{r} AS (SELECT part, entry, list(CAST((s - (s % n + n) % n) // n AS HUGEINT) ORDER BY k) AS x FROM s{r} GROUP BY part, entry),
c{n} AS (SELECT part, entry, coalesce(m.x, c.x) AS x FROM c{r} c LEFT JOIN m{r} m USING (part, entry))"""
#: For vectors of 64 components without repeated ids.
ORACLE = (
    f"""WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda y: CAST(floor(CAST(y AS DOUBLE) * {SCALE}) AS HUGEINT)) AS x FROM embeddings
WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda y: y IS NULL OR NOT isfinite(y))) = 0),
parts AS (SELECT vec_id, part, x[part * 8 + 1 : part * 8 + 8] AS x FROM v, (SELECT unnest(range({PARTS})) AS part)),
c0 AS (SELECT part, rank - 1 AS entry, x FROM (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS rank FROM v QUALIFY rank <= {ENTRIES}) JOIN parts USING (vec_id)),"""
    + ",".join(_ROUND.format(r=r) + "," + _MOVE.format(r=r, n=r + 1) for r in range(ROUNDS))
    + ","
    + _ROUND.format(r=ROUNDS)
    + f""",
e AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY vec_id),
h AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS h FROM c{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM e JOIN v USING (vec_id), h"""
)
