"""Quality by perplexity: an interpolated modified Kneser-Ney model of character n-grams, counted over trusted text and kept a table.

The log probability of a text is a sum over its n-grams of one value each, as backing off from abcde to bcde to cde and
so on adds the weights of contexts and what seen n-grams change; an unseen n-gram adds 0. The table is never collected
or broadcast: documents are dealt to slices, a slice asks for each of its n-grams once, and one join of these with the
table, in as many shards as there are, gives the slice the values of its n-grams. Texts themselves are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from quern.llm.common import bucketed, durable, join_small, let_go, ship

#: Characters of the longest n-grams; what stands before each text (ORDER - 1 times) and after it; a NUL in a text counts as the third.
ORDER, START, END, NUL = 5, 2, 3, 1
#: Characters of a slice, whose last document may reach beyond; small tables get a slice a core, of LEAST_SLICE characters
#: at least. A slice's documents come from one task. Small slices would ask for common n-grams over and over.
SLICE, LEAST_SLICE = 48_000_000, 1_000_000
#: Characters that are looked at at once (each takes some 60 bytes meanwhile), and cells of a look-up table; they change no result.
CHUNK, CELLS = 500_000, 1 << 24
#: Of trusted texts one in HELD, by a hash of the text, is held out of the model; limits are quantiles over these.
HELD = 5
#: A document is rejected if its log perplexity exceeds its language's median by more than SPREAD times the distance
#: from the median to the HIGH quantile, both over held-out documents; short texts get a wider margin (see limit()).
HIGH, SPREAD, SHORT = 0.95, 3.0, 4.0
#: A language with fewer held-out documents takes the quantiles of all.
MIN_TRUSTED = 30


class Chunk:
    """Texts as one sequence of code points, each between starts and an end."""

    def __init__(self, texts: list[str]):
        sizes = np.array([len(x) for x in texts], np.int64) + ORDER
        self.ends = np.cumsum(sizes)
        self.begins = self.ends - sizes
        joined = chr(START) * (ORDER - 1) + (chr(END) + chr(START) * (ORDER - 1)).join(texts) + chr(END)
        self.points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
        self.points[self.points == 0] = NUL


class Numbers:
    """Codes numbered from 1 on as they are added; 0 is the number of all others.

    While codes are below CELLS, a table has the number of each. Beyond, a hash table of at least twice as many cells
    as codes has them: a code lies in the first cell from its own on that was free.
    """

    def __init__(self):
        self.n, self.codes, self.table = 1, np.zeros(64, np.int64), np.zeros(1, np.int32)  # codes by number, and room

    def reach(self, bound: int) -> None:
        """From now on codes are below bound."""
        if self.table is not None and bound > len(self.table):
            old, self.table = self.table, np.zeros(min(CELLS, 2 * bound), np.int32) if bound <= CELLS else None
            if self.table is None:
                self._lay()
            else:
                self.table[: len(old)] = old

    def _lay(self) -> None:
        bits = max(10, (2 * self.n).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.held, self.number = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
        self._put(1)

    def _cells(self, codes: np.ndarray) -> np.ndarray:
        return ((codes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def _put(self, first: int) -> None:
        """Lays the codes from number first on into cells."""
        codes, numbers = self.codes[first : self.n], np.arange(first, self.n, dtype=np.int32)
        cells = self._cells(codes)
        while len(codes):
            free = self.held[cells] < 0
            self.held[cells[free]] = codes[free]  # of several codes for a cell one stays
            laid = self.held[cells] == codes
            self.number[cells[laid]] = numbers[laid]
            codes, numbers, cells = codes[~laid], numbers[~laid], (cells[~laid] + 1) & self.mask

    def find(self, codes: np.ndarray) -> np.ndarray:
        if self.table is not None:
            return self.table[codes]
        cells = self._cells(codes)
        held = self.held[cells]
        same = held == codes
        out = np.where(same, self.number[cells], np.int32(0))
        left = np.flatnonzero(~same & (held >= 0))
        cells = cells[left]
        while len(left):
            cells = (cells + 1) & self.mask
            held = self.held[cells]
            same = held == codes[left]
            out[left[same]] = self.number[cells[same]]
            on = ~same & (held >= 0)
            left, cells = left[on], cells[on]
        return out

    def add(self, codes: np.ndarray, least: int) -> np.ndarray:
        """As find(), and codes from least on that have no number get one."""
        out = self.find(codes)
        lacking = np.flatnonzero(out == 0)
        lacking = lacking[codes[lacking] >= least]
        if len(lacking):
            new, which = np.unique(codes[lacking], return_inverse=True)
            first, self.n = self.n, self.n + len(new)
            if self.n > len(self.codes):
                self.codes = np.concatenate([self.codes, np.zeros(self.n, np.int64)])
            self.codes[first : self.n] = new
            if self.table is not None:
                self.table[new] = np.arange(first, self.n, dtype=np.int32)
            elif 2 * self.n > self.mask + 1:
                self._lay()
            else:
                self._put(first)
            out[lacking] = first + which
        return out


class Grams:
    """n-grams of each order by number: characters by their rank from 1 on, others coded by the number of all but their last character and that one's; 0 is for unknown ones."""

    def __init__(self, seen: np.ndarray):
        """seen: which code points occur, as flags."""
        self.chars = np.concatenate([[0], np.flatnonzero(seen)]).astype(np.uint32)
        self.rank = np.zeros(int(self.chars[-1]) + 2, np.int32)  # and 0 last, for larger ones
        self.rank[self.chars[1:]] = np.arange(1, len(self.chars), dtype=np.int32)
        self.bits = len(self.chars).bit_length()
        self.levels = [Numbers() for _ in range(ORDER - 1)]

    def sizes(self) -> list[int]:
        return [len(self.chars), *(level.n for level in self.levels)]

    def _chars(self, points: np.ndarray) -> np.ndarray:
        return self.rank[np.minimum(points, len(self.rank) - 1)]

    def _next(self, order: int, codes: np.ndarray, new: bool) -> np.ndarray:
        level = self.levels[order - 2]
        level.reach(self.sizes()[order - 2] << self.bits)
        return level.add(codes, 1 << self.bits) if new else level.find(codes)

    def add(self, grams: np.ndarray) -> np.ndarray:
        """The numbers of n-grams of one order, rows of code points; those without get one, and so does what they begin with."""
        chars = self._chars(grams)
        at = chars[:, 0]
        for order in range(2, grams.shape[1] + 1):
            at = self._next(order, np.left_shift(at, self.bits, dtype=np.int64) | chars[:, order - 1], True)
        return at

    def walk(self, chunk: Chunk, new: bool) -> Iterator[tuple[int, np.ndarray]]:
        """For orders from 1 on: the order, and the number of the n-gram from each place; 0 where it reaches into the next text or isn't known (new: it gets a number)."""
        at = chars = self._chars(chunk.points)
        yield 1, at
        for order in range(2, ORDER + 1):
            codes = np.left_shift(at[:-1], self.bits, dtype=np.int64)
            codes |= chars[order - 1 :]
            over = chunk.ends - order + 1  # what began later in a text is over already
            codes[over[over < len(codes)]] = 0
            at = self._next(order, codes, new)
            yield order, at

    def points(self) -> Iterator[np.ndarray]:
        """The n-grams of each order from 1 on in order of their numbers, from 1 on, as rows of code points."""
        before = self.chars[:, None]
        yield before[1:]
        for level in self.levels:
            codes = level.codes[: level.n]
            before = np.concatenate([before[codes >> self.bits], self.chars[codes & ((1 << self.bits) - 1)][:, None]], axis=1)
            yield before[1:]


def occurring(stretches: Iterator[np.ndarray]) -> np.ndarray:
    seen = np.zeros(0x110000, bool)
    for points in stretches:
        seen[points] = True
    return seen


def chunks(texts: pa.ChunkedArray) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Texts with a character in stretches of about CHUNK characters, with their places; only a stretch at a time is in Python's strings."""
    let_go()
    sizes = lengths(texts)
    full = np.flatnonzero(sizes)
    ends = np.cumsum(sizes[full] + ORDER)
    at = 0
    while at < len(full):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK, "right")))
        first, last = full[at], full[upto - 1]
        yield full[at:upto], [x for x in texts.slice(first, last + 1 - first).to_pylist() if x]  # take() would copy all texts
        at = upto
    pa.default_memory_pool().release_unused()  # a worker waits for its next task


def lengths(texts: pa.ChunkedArray) -> np.ndarray:
    return pc.fill_null(pc.utf8_length(texts), 0).to_numpy().astype(np.int64)


def strings(grams: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(grams).view(f"<U{grams.shape[1]}").ravel(), pa.string())


def code_points(grams: pa.Array, order: int) -> np.ndarray:
    """Strings of order characters each as rows of code points."""
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(grams)], pa.int32()), grams), "")[0].as_py() or ""
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, order)


def count_slice(docs: pa.Table, places: pa.Table) -> pa.Table:
    """(gram, n): n-grams of the highest order in the texts of these places, once each."""
    mask = np.isin(docs.column("__place").to_numpy(), places.column("__place").to_numpy()) if len(docs) else np.zeros(0, bool)
    texts = docs.column("text").filter(pa.array(mask))
    known, n = Grams(occurring(Chunk(part).points for _, part in chunks(texts))), np.zeros(1, np.int64)
    for _, part in chunks(texts):
        *_, (_, at) = known.walk(Chunk(part), True)
        own = np.bincount(at, minlength=known.levels[-1].n)
        own[: len(n)] += n
        n = own
    *_, grams = known.points()
    return pa.table({"gram": strings(grams), "n": pa.array(n[1:], pa.int64())})


def ask_slice(docs: pa.Table) -> pa.Table:
    """(gram, __slice): all n-grams of a slice, once each."""
    texts = docs.column("text")
    known = Grams(occurring(Chunk(part).points for _, part in chunks(texts)))
    for _, part in chunks(texts):
        for _ in known.walk(Chunk(part), True):
            pass
    grams = pa.concat_arrays([strings(x) for x in known.points()])
    return pa.table({"gram": grams, "__slice": pa.array(np.full(len(grams), docs.column("__slice")[0].as_py() if len(docs) else 0), pa.int64())})


def score_slice(docs: pa.Table, values: pa.Table, unseen: float) -> pa.Table:
    """The rows of a slice without their texts, with n_chars and log_ppl, the mean negative log probability of a character and the end (null: no text)."""
    gram, value = values.column("gram").combine_chunks(), values.column("value").to_numpy()
    size = pc.utf8_length(gram).to_numpy(zero_copy_only=False)
    given = [code_points(gram.filter(pa.array(size == order)), order) for order in range(1, ORDER + 1)]
    known = Grams(occurring(iter(given)))
    own = [known.add(grams) for grams in given]
    by_number = [np.zeros(n) for n in known.sizes()]  # 0.0 for what has no value, and first, for unknown ones
    for order, numbers in enumerate(own, 1):
        by_number[order - 1][numbers] = value[size == order]
    sums = np.zeros(len(docs))
    for at, part in chunks(docs.column("text")):
        chunk = Chunk(part)
        total = np.zeros(len(chunk.points) + 1)
        for order, numbers in known.walk(chunk, False):
            found = by_number[order - 1][numbers]
            for early in range(ORDER - 1 - order):  # these end before the last start
                found[chunk.begins + early] = 0.0
            total[1 : len(found) + 1] += found
        np.cumsum(total, out=total)
        sums[at] += total[chunk.ends] - total[chunk.begins]
    n_chars = lengths(docs.column("text"))
    log_ppl = np.where(n_chars > 0, -sums / (n_chars + 1) - unseen, np.nan)
    out = docs.drop_columns(["text"])
    return out.append_column("n_chars", pa.array(n_chars)).append_column("log_ppl", pa.array(log_ppl, mask=np.isnan(log_ppl)))


def discounts(level: DataFrame):
    """The discount of a count, from the counts of counts."""
    c = {r["n"]: r["count"] for r in level.where("n <= 4").groupBy("n").count().collect()}  # four rows at most
    n1, n2, n3, n4 = (c.get(i, 0) for i in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    d1, d2, d3 = (min(max(i - (i + 1) * y * b / a, 0.1), i - 0.1) if a and b else 0.5 for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4)))
    return lambda n: F.when(n == 1, d1).when(n == 2, d2).otherwise(d3)


def kneser_ney(counts: DataFrame) -> tuple[DataFrame, float]:
    """From (gram, n) of the highest order: (gram, value) of all orders, and the log probability of an unseen character.

    Counts below the highest order are continuation counts. n-grams meet the totals of their contexts and the
    probabilities of their endings in joins, order by order.
    """
    levels = {ORDER: durable(counts, f"grams-{ORDER}")}
    for order in range(ORDER - 1, 0, -1):
        levels[order] = durable(levels[order + 1].groupBy(F.expr("substring(gram, 2)").alias("gram")).agg(F.count("*").alias("n")), f"grams-{order}")
    cut = discounts(levels[1])
    sums = levels[1].agg(F.sum("n").alias("total"), F.sum(cut(F.col("n"))).alias("left"), F.count("*").alias("chars")).first()
    if not sums["chars"]:
        return levels[1].select("gram", F.lit(0.0).cast("float").alias("value")), 0.0
    unseen = sums["left"] / sums["total"] / (sums["chars"] + 1)
    p = levels[1].select("gram", ((F.col("n") - cut(F.col("n"))) / sums["total"] + unseen).alias("p"))
    every = p.select("gram", (F.log("p") - float(np.log(unseen))).alias("value"))
    for order in range(2, ORDER + 1):
        cut = discounts(levels[order])
        context = F.expr(f"substring(gram, 1, {order - 1})").alias("context")
        rows = levels[order].select("gram", context, F.expr("substring(gram, 2)").alias("ending"), "n")
        contexts = durable(rows.groupBy("context").agg(F.sum("n").alias("total"), F.sum(cut(F.col("n"))).alias("left")), f"contexts-{order}")
        every = every.unionByName(contexts.select(F.col("context").alias("gram"), F.log(F.col("left") / F.col("total")).alias("value")))
        rest = F.col("left") / F.col("total") * F.col("lower")
        met = rows.join(contexts, "context").join(p.select(F.col("gram").alias("ending"), F.col("p").alias("lower")), "ending")
        p = durable(met.select("gram", ((F.col("n") - cut(F.col("n"))) / F.col("total") + rest).alias("p"), rest.alias("rest")), f"shares-{order}")
        every = every.unionByName(p.select("gram", F.log(F.col("p") / F.col("rest")).alias("value")))
    return durable(every.groupBy("gram").agg(F.sum("value").cast("float").alias("value")), "model"), float(np.log(unseen))


def slices_of(docs: DataFrame, id_col: str, text_col: str, lang_col: str, whole: bool) -> DataFrame:
    """docs in a table that is dealt by slices, as they come, without a shuffle: __slice, __place in it, id, lang, text, and with whole all columns in `row`."""
    columns = [F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")]
    if whole:
        columns.append(F.struct(*(c for c in docs.columns if c != text_col)).alias("row"))
    total, cores = docs.agg(F.sum(F.length(text_col))).first()[0] or 0, docs.sparkSession.sparkContext.defaultParallelism
    size = max(LEAST_SLICE, min(SLICE, -(-total // cores)))
    docs = docs.coalesce(max(1, -(-total // size))).select(*columns)  # small tasks share a slice
    schema = T.StructType([T.StructField("__slice", T.LongType()), T.StructField("__place", T.IntegerType()), *docs.schema])
    return bucketed(docs.mapInArrow(lambda batches: cut(batches, size), schema), "__slice", "slices")


def cut(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """A task's rows with the number of their slice, which is no other task's, and their place in it; a slice is full once it holds size characters."""
    let_go()
    task, number, place, held = TaskContext.get().partitionId() << 32, 0, 0, 0
    for batch in batches:
        slices, places = [], []
        for n in pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_pylist():
            if held >= size:
                number, place, held = number + 1, 0, 0
            slices.append(task + number)
            places.append(place)
            place, held = place + 1, held + n + 1
        yield pa.RecordBatch.from_arrays([pa.array(slices, pa.int64()), pa.array(places, pa.int32()), *batch.columns], names=["__slice", "__place", *batch.schema.names])


def limits(scored: DataFrame) -> tuple[DataFrame, tuple[float, float]]:
    """(lang, __mid, __high) by language over rows of held-out text, and the same two quantiles over all of them."""
    q = lambda p: F.percentile_approx("log_ppl", p, 10_000)
    by_lang = durable(scored.groupBy("lang").agg(q(0.5).alias("__mid"), q(HIGH).alias("__high"), F.count("*").alias("__n")).where(F.col("__n") >= MIN_TRUSTED).drop("__n"), "quantiles")
    every = scored.agg(q(0.5), q(HIGH)).first()
    return by_lang, (every[0], every[1])


def limit(mid: Column, high: Column, n_chars: Column) -> Column:
    """The largest log perplexity that passes; the mean over n characters varies with 1 / sqrt(n), and so does the margin."""
    return mid + SPREAD * (high - mid) + F.lit(SHORT) / F.sqrt(F.greatest(n_chars, F.lit(1)))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", keep_text: bool = True) -> DataFrame:
    """docs with __n_chars, __log_ppl, __limit and __kept; without keep_text, only their id and language with these.

    The model is trained on the texts that a label calls good (quality 1), but for the held-out ones. A row is kept if
    its log perplexity is at most its language's limit. Null and empty texts have no perplexity and are not kept. Null
    languages are a language. A text longer than a slice is a slice by itself or the last of one. Without held-out rows there is no limit, and every text with a character is kept.
    Repeated rows are judged each, and an empty table gives no rows; other columns pass through, whatever their names,
    but for those named as the four, which are replaced.
    """
    spark = docs.sparkSession
    ship(spark)
    table = slices_of(docs, id_col, text_col, lang_col, keep_text)
    trusted = labels.where("quality = 1").select(F.col("doc_id").alias("id")).distinct()
    fold = (F.pmod(F.xxhash64("text"), F.lit(HELD)) == 0).alias("held")
    known = durable(table.select("id", "__slice", "__place", fold).join(trusted, "id", "left_semi").drop("id"), "trusted")
    of = lambda df: df.groupBy("__slice")
    counted = of(table.select("__slice", "__place", "text")).cogroup(of(known.where("NOT held").select("__slice", "__place"))).applyInArrow(count_slice, "gram string, n long")
    model, unseen = kneser_ney(counted.groupBy("gram").agg(F.sum("n").alias("n")))
    asked = of(table.select("__slice", "text")).applyInArrow(ask_slice, "gram string, __slice long")
    values = asked.join(model, "gram").select("__slice", "gram", "value")
    small = table.select("__slice", "__place", "id", "lang", "text")
    schema = small.drop("text").schema.add("n_chars", "long").add("log_ppl", "double")
    scored = durable(of(small).cogroup(of(values)).applyInArrow(lambda own, v: score_slice(own, v, unseen), schema), "perplexity")
    held = scored.where("log_ppl IS NOT NULL").join(known.where("held").select("__slice", "__place"), ["__slice", "__place"], "left_semi")
    by_lang, (mid, high) = limits(held)
    if keep_text:
        own = [c for c in docs.columns if c not in ("__n_chars", "__log_ppl", "__limit", "__kept")]
        found = scored.select("__slice", "__place", "n_chars", "log_ppl")
        both = T.StructType([*table.select("lang", "text", "row").schema, T.StructField("n_chars", T.LongType()), T.StructField("log_ppl", T.DoubleType())])
        rows = of(table.drop("id")).cogroup(of(found)).applyInArrow(lambda a, b: beside(a, b, to_arrow_schema(both)), both)
    else:
        rows = scored
    out = join_small(rows, by_lang, "lang")
    bound: Column = limit(F.coalesce("__mid", F.lit(mid).cast("double")), F.coalesce("__high", F.lit(high).cast("double")), F.col("n_chars"))
    kept = F.when(F.col("log_ppl").isNull(), False).otherwise(F.coalesce(F.col("log_ppl") <= bound, F.lit(True)))
    first = [F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in own] if keep_text else [F.col("id").alias(id_col), F.col("lang").alias(lang_col)]
    return out.select(*first, F.col("n_chars").alias("__n_chars"), F.col("log_ppl").alias("__log_ppl"), bound.alias("__limit"), kept.alias("__kept"))


def beside(docs: pa.Table, found: pa.Table, schema: pa.Schema) -> pa.Table:
    """Rows of a slice with what was found at their places."""
    at = pc.index_in(docs.column("__place"), value_set=found.column("__place").combine_chunks())
    columns = {c: docs.column(c) for c in ("lang", "text", "row")} | {c: found.column(c).take(at) for c in ("n_chars", "log_ppl")}
    return pa.table([columns[f.name] for f in schema], names=schema.names)
