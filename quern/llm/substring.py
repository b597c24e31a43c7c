"""Repeated passages of words: anchors deal windows to shards, an FM-index per shard gives their matching statistics.

A window's anchor is the least hash of the short word runs in it, so equal windows have equal anchors and meet in one
shard, and a shard sees only windows whose anchor comes up more than once. Neighbouring windows with one anchor
form a segment; equal segments are a class, which is indexed once, at its earliest place, and streamed once against
the index of its shard. Where its words match a whole window in the index, the earliest place of the match decides:
it makes the class's own windows repeats if it lies before them, and those of all later copies of the class.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import arrow_map, arrow_map_all, dealt, durable, release, ship, slices
from quern.llm.fm_index import FMIndex
from quern.llm.shingles import mix, windows, word_hashes, words_of

#: Words of a window, and of the runs that anchors are taken from.
WINDOW, RUN = 20, 6
#: Words of a shard on average, and segments of a task that groups them by anchor.
SHARD_WORDS, TASK_ROWS = 100_000, 1_000_000
#: Anchors with at least so many segments, and with at least this share of all, are dealt window by window, so that a
#: passage with very many neighbourhoods doesn't meet in one task; there are 1 / HOT_SHARE of them at most.
HOT, HOT_SHARE = 5_000, 1e-6
#: An anchor is counted where a batch of segments has it at least so often and on at least this share.
SEEN, SEEN_SHARE = 16, 1e-3
#: Stands for a null doc_id; it is later than any other.
LATEST = (1 << 63) - 1
_ODD = 0x9E3779B97F4A7C15
#: Places are packed below the upper bits of hashes while the least one of a window is sought.
_PLACE_BITS = np.uint64(24)
#: Kinds of rows: the earliest segment of a class in its batch, a later copy of it, and an anchor with its number.
FORWARD, COPY, COUNTED = 0, 1, 2


def all_words(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, one text after the other, and how many each has."""
    lists = [words_of(x, fold=False) for x in texts]
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return word_hashes().of(list(chain.from_iterable(lists))), sizes


def leftmost_least(x: np.ndarray, width: int) -> np.ndarray:
    """For each stretch of width hashes the place of the least one, by their upper 40 bits, the leftmost of equals."""
    out, mask = [], (np.uint64(1) << _PLACE_BITS) - np.uint64(1)
    stretches = len(x) - width + 1
    for base in range(0, stretches, 1 << 22):
        part = x[base : min(base + (1 << 22), stretches) + width - 1]
        low = (part & ~mask) | np.arange(len(part), dtype=np.uint64)
        reach = 1
        while 2 * reach <= width:
            low = np.minimum(low[:-reach], low[reach:])
            reach *= 2
        if reach < width:
            low = np.minimum(low[: len(low) - (width - reach)], low[width - reach :])
        out.append((low & mask).astype(np.int64) + base)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def contents(h: np.ndarray, start: np.ndarray, end: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Hashes of stretches of words with their anchors: sums of hash * odd ** place, moved to place 0 by the inverse power."""
    powers, back = power(len(h))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * powers[: len(h)])])
    return mix((total[end] - total[start]) * back[start] + (end - start).astype(np.uint64) + mix(anchor))


def segments(h: np.ndarray, sizes: np.ndarray, window: int, run: int) -> tuple[np.ndarray, ...]:
    """Anchor, class, text, first window in its text and number of windows of each segment of the texts whose words' hashes h holds."""
    ends = np.cumsum(sizes)
    if len(h) < window:
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    runs = windows(h, run)
    at = leftmost_least(runs, window - run + 1)
    whose = np.repeat(np.arange(len(sizes)), sizes)[: len(at)]
    starts = np.flatnonzero(np.arange(len(at)) + window <= ends[whose])
    at = at[starts]
    first = np.flatnonzero((np.diff(at, prepend=-1) != 0) | (np.diff(starts, prepend=-2) != 1))
    count = np.diff(np.append(first, len(at)))
    begin, anchor = starts[first], runs[at[first]]
    cls = contents(h, begin, begin + count + window - 1, anchor)
    text = whose[begin]
    return anchor.view(np.int64), cls.view(np.int64), text, begin - (ends - sizes)[text], count


_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2 ** 64, n of them at least and one more; a worker keeps them."""
    if len(_powers[0]) <= n:
        size = 1 << max(12, (n + 1).bit_length())
        for i, base in enumerate((_ODD, pow(_ODD, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers[0], _powers[1]


def classes(cls: np.ndarray, doc: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order of segments by class and place, where in it each class begins, and which of it are later copies (rows of a repeated doc_id aren't)."""
    order = np.lexsort((first, doc, cls))
    cls, doc, first = cls[order], doc[order], first[order]
    at = np.flatnonzero(np.append(True, cls[1:] != cls[:-1])) if len(cls) else np.zeros(0, np.int64)
    earliest = np.repeat(at, np.diff(np.append(at, len(cls))))
    return order, at, (doc != doc[earliest]) | (first != first[earliest])


ROWS = "kind byte, anchor long, cls long, doc long, first int, count int, n long"


def rows_of(parts: list[tuple[int, dict[str, np.ndarray]]]) -> dict[str, np.ndarray]:
    """Columns of ROWS from parts of one kind each; what a part lacks is 0."""
    sizes = [len(next(iter(p.values()))) for _, p in parts]
    out = {c: np.concatenate([p.get(c, np.zeros(m, np.int64)) for m, (_, p) in zip(sizes, parts, strict=True)]) for c in ("anchor", "cls", "doc", "first", "count", "n")}
    return {"kind": np.repeat(np.array([k for k, _ in parts], np.int8), sizes)} | out


def find_segments(docs: DataFrame, window: int, run: int) -> DataFrame:
    """ROWS of docs (doc, text): each batch's classes with their number of segments, the later copies of these, and its common anchors."""

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in slices(batch, 8 << 20):
            anchor, cls, text, first, count = segments(*all_words(part.column(1).to_pylist()), window, run)
            doc = np.asarray(part.column(0))[text]
            order, at, copy = classes(cls, doc, first)
            anchor, cls, doc, first, count = (x[order] for x in (anchor, cls, doc, first, count))
            ahead = {"anchor": anchor[at], "cls": cls[at], "doc": doc[at], "first": first[at], "count": count[at], "n": np.diff(np.append(at, len(cls)))}
            common, times = np.unique(anchor[at], return_counts=True)
            often = times >= max(SEEN, SEEN_SHARE * len(at))
            yield rows_of([(FORWARD, ahead), (COPY, {"cls": cls[copy], "doc": doc[copy], "first": first[copy]}), (COUNTED, {"anchor": common[often], "n": times[often]})])

    return arrow_map(docs.select("doc", "text"), step, ROWS)


def by_anchor(segments_: DataFrame, tasks: int) -> DataFrame:
    """ROWS: of anchors that come up again the earliest segment of each class, and its later copies."""

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        got = list(batches)
        if not got:
            return
        columns = {c: np.concatenate([np.asarray(b.column(c)) for b in got]) for c in got[0].schema.names}
        order, at, copy = classes(columns["cls"], columns["doc"], columns["first"])
        columns = {c: x[order] for c, x in columns.items()}
        _, which, times = np.unique(columns["anchor"][at], return_inverse=True, return_counts=True)
        own = np.add.reduceat(columns["n"], at)
        live = (times[which] > 1) | (own > 1)
        rows = at[live]
        yield rows_of([(FORWARD, {c: x[rows] for c, x in columns.items()} | {"n": own[live]}), (COPY, {c: columns[c][copy] for c in ("cls", "doc", "first")})])

    return arrow_map_all(segments_.select("anchor", "cls", "doc", "first", "count", "n").repartition(tasks, "anchor"), steps, ROWS)


def candidates(docs: DataFrame, window: int, run: int) -> tuple[DataFrame, DataFrame]:
    """(streamed, copies): classes (anchor, cls, doc, first, count, n, hot) that may hold a repeated window, at their earliest place, and later copies (cls, doc, first) of them."""
    every = durable(find_segments(docs, window, run), "segments")
    forward = every.where(F.col("kind") == FORWARD).drop("kind")
    total = forward.count()
    counted = every.where(F.col("kind") == COUNTED).groupBy("anchor").agg(F.sum("n").alias("times"))
    hot = durable(counted.where(F.col("times") >= max(HOT, HOT_SHARE * total)).select("anchor"), "hot")  # 1 / HOT_SHARE rows at most
    cold = durable(by_anchor(forward.join(F.broadcast(hot), "anchor", "left_anti"), max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_ROWS))), "cold")
    warm = durable(forward.join(F.broadcast(hot), "anchor", "left_semi"), "warm")
    place = F.min(F.struct("doc", "first")).alias("e")
    heads = durable(warm.groupBy("anchor", "cls").agg(place, F.min("count").alias("count"), F.sum("n").alias("n")).select("anchor", "cls", "e.doc", "e.first", "count", "n"), "heads")
    streamed = cold.where(F.col("kind") == FORWARD).drop("kind").withColumn("hot", F.lit(False)).unionByName(heads.withColumn("hot", F.lit(True)))
    at = heads.select("cls", F.col("doc").alias("doc_e"), F.col("first").alias("first_e"))
    later = warm.join(at, "cls").where("doc <> doc_e OR first <> first_e").select("cls", "doc", "first")
    copies = [x.where(F.col("kind") == COPY).select("cls", "doc", "first") for x in (every, cold)]
    out = durable(streamed, "streamed"), durable(copies[0].unionByName(copies[1]).unionByName(later), "copies")
    release(every, cold, warm, heads)
    return out


def cut(texts: DataFrame, shards: int, window: int) -> DataFrame:
    """(shard, cls, doc, first, inner, again, words): the words of each segment of texts (text, own), of hot ones window by window; inner is the place in the class."""

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in slices(batch, 4 << 20):
            h, sizes = all_words(part.column(1).to_pylist())
            lists = part.column(2)
            own = lists.flatten()
            anchor, cls, first, count, n, hot = (np.asarray(own.field(i)) for i in range(6))
            text = np.repeat(np.arange(len(sizes)), np.diff(np.asarray(lists.offsets)))
            inside = first + count + window - 1 <= sizes[text]  # rows of a repeated doc_id may have other texts
            anchor, cls, first, count, n, hot, text = (x[inside] for x in (anchor, cls, first, count, n, hot.astype(bool), text))
            begin = (np.cumsum(sizes) - sizes)[text] + first
            same = contents(h, begin, begin + count + window - 1, anchor.view(np.uint64)).view(np.int64) == cls
            anchor, cls, first, count, n, hot, text, begin = (x[same] for x in (anchor, cls, first, count, n, hot, text, begin))
            pieces = np.where(hot, count, 1)
            which = np.repeat(np.arange(len(cls)), pieces)
            inner = np.arange(len(which)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            length = np.where(hot, window, count + window - 1)[which]
            start = begin[which] + inner
            data = h[np.arange(length.sum()) + np.repeat(start - (np.cumsum(length) - length), length)]
            seed = mix(anchor.view(np.uint64))[which]
            if hot.any():
                seed = np.where(hot[which], mix(seed ^ mix(windows(h, window)[start])), seed)
            offsets = np.concatenate([[0], np.cumsum(length * 8)]).astype(np.int32)
            words = pa.Array.from_buffers(pa.binary(), len(which), [None, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())])
            doc = np.asarray(part.column(0))[text]
            yield {"shard": (seed % np.uint64(shards)).astype(np.int64), "cls": cls[which], "doc": doc[which], "first": (first[which] + inner), "inner": inner, "again": (n > 1)[which], "words": words}

    return arrow_map(texts.select("doc", "text", "own"), step, "shard long, cls long, doc long, first int, inner int, again boolean, words binary")


def index_shard(table: pa.Table, window: int = WINDOW) -> pa.Table:
    """(cls, doc, first, count) of a shard's segments: runs of their windows that come up earlier, and, with a null doc and places in the class, those that its later copies repeat.

    The segments are indexed in the order of their places. A window is matched where the statistic of its last word
    reaches the window's length.
    """
    names = ("cls", "doc", "first", "inner", "again")
    cls, doc, first, inner, again = (table.column(c).to_numpy() for c in names)
    order = np.lexsort((inner, cls, first, doc))
    once = np.append(True, (np.diff(cls[order]) != 0) | (np.diff(inner[order]) != 0))  # rows of a repeated doc_id may come up again
    order = order[once]
    cls, doc, first, inner, again = (x[order] for x in (cls, doc, first, inner, again))
    words = table.column("words").combine_chunks().take(pa.array(order))
    bounds = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1] // 8
    symbols = np.unique(np.frombuffer(words.buffers()[2], np.uint64)[bounds[0] : bounds[-1]], return_inverse=True)[1] + 2
    sizes = np.diff(bounds)
    text = np.ones(len(symbols) + len(sizes), np.int64)  # 1 stands after each segment
    text[np.arange(len(symbols)) + np.repeat(np.arange(len(sizes)), sizes)] = symbols
    begins = np.cumsum(sizes + 1) - sizes - 1
    counts = sizes - window + 1
    owner = np.repeat(np.arange(len(sizes)), counts)
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    ends = begins[owner] + place + window - 1
    index = FMIndex(text)
    length, low, high = index.matching(text, ends, window, np.where(again[owner], 1, 2))
    matched = np.flatnonzero(length == window)
    owner, place = owner[matched], place[matched]
    found = index.earliest(low[matched], high[matched])
    source = np.searchsorted(begins, found, side="right") - 1
    late = (doc[source] < doc[owner]) | ((doc[source] == doc[owner]) & (first[source] + found - begins[source] < first[owner] + place))

    def runs(owner: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        new = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | (np.diff(place, prepend=-2) != 1))
        return owner[new], place[new], np.diff(np.append(new, len(owner)))

    own, at, count = runs(owner[late], place[late])
    copied = again[owner]
    own2, at2, count2 = runs(owner[copied], place[copied])
    return pa.table(
        {
            "cls": pa.array(np.concatenate([cls[own], cls[own2]])),
            "doc": pa.concat_arrays([pa.array(doc[own]), pa.nulls(len(own2), pa.int64())]),
            "first": pa.array(np.concatenate([first[own] + at, inner[own2] + at2]).astype(np.int32)),
            "count": pa.array(np.concatenate([count, count2]).astype(np.int32)),
        }
    )


def repeated_runs(docs: DataFrame, texts: DataFrame, window: int = WINDOW, run: int = RUN) -> DataFrame:
    """(doc, first, count) of docs (doc, text): runs of windows that start earlier elsewhere. texts are docs dealt by doc."""
    streamed, copies = candidates(docs, window, run)
    total = streamed.agg(F.sum(F.when(F.col("hot"), F.col("count") * window).otherwise(F.col("count") + window - 1))).first()[0] or 0
    lists = streamed.groupBy("doc").agg(F.collect_list(F.struct("anchor", "cls", "first", "count", "n", "hot")).alias("own"))  # bounded by the document
    payload = cut(texts.join(lists, "doc"), max(64, total // SHARD_WORDS), window)
    ship(docs.sparkSession)
    found = durable(payload.groupBy("shard").applyInArrow(lambda table: index_shard(table, window), "cls long, doc long, first int, count int"), "found")
    matched = found.where("doc IS NULL").select("cls", F.col("first").alias("inner"), "count")
    later = copies.join(matched, "cls").select("doc", (F.col("first") + F.col("inner")).alias("first"), "count")
    out = durable(found.where("doc IS NOT NULL").select("doc", "first", "count").unionByName(later), "runs")
    release(streamed, copies, found)
    return out


def covered(n: int, runs: list[dict], window: int) -> np.ndarray:
    """Which of n words a run of windows covers."""
    edge = np.zeros(n + 1, np.int64)
    for r in runs:
        edge[min(n, r["first"])] += 1
        edge[min(n, r["first"] + r["count"] + window - 1)] -= 1
    return np.cumsum(edge)[:n] > 0


def strip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_removed and kept_sha256, the digest of the kept words joined by a space.

    A word goes if a window of `window` words that covers it starts earlier too: in a smaller doc_id, or earlier in
    the same document. Null texts have no words; an empty table gives none. Rows with one doc_id count as one document,
    so equal rows have equal results and none is the earlier one; a null doc_id is the latest. Other columns are
    ignored, whatever their names.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    keyed = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LATEST)).alias("doc"), F.col(text_col).cast("binary").alias("text"))
    texts = dealt(keyed, "doc", "texts")
    runs = repeated_runs(keyed, texts, window)
    by_doc = runs.groupBy("doc").agg(F.collect_list(F.struct("first", "count")).alias("runs"))  # bounded by the document

    def finish(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in slices(batch, 8 << 20):
            sizes, gone, digests = [], [], []
            for text, own in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                kept = all_ = words_of(text, fold=False)
                if own:
                    kept = list(compress(all_, (~covered(len(all_), own, window)).tolist()))
                sizes.append(len(all_))
                gone.append(len(all_) - len(kept))
                digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield {"doc": part.column(0), "n_words": sizes, "n_removed": gone, "kept_sha256": digests}

    out = arrow_map(texts.join(by_doc, "doc", "left").select("doc", "text", "runs"), finish, "doc long, n_words long, n_removed long, kept_sha256 string")
    return out.select(F.nullif("doc", F.lit(LATEST)).cast(kind).alias("doc_id"), "n_words", "n_removed", "kept_sha256")
