"""Jaccard join of shingle sets by parity sketches, and the components of its links.

Each shingle of a set flips one place of a sketch, so two sketches differ in at most as many places as the sets
differ in shingles. Sets that link differ in at most D = floor(size * (1 - t) / t) shingles, so when a sketch is
cut into blocks, at most D blocks differ, and of any D + 1 blocks of either set one is equal in both. Sizes are dealt
to bands, two a doubling, and sets meet in the band of the smaller one.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import BROADCAST_ROWS, arrow_map, arrow_map_all, durable, release, slices
from quern.llm.shingles import mix, windows, word_hashes, words_of

#: Words of a shingle, and the least similarity num / den of a link, unless a caller gives others.
K, NUM, DEN = 3, 90, 100
#: Blocks for each difference that the largest set of a band may have.
SPARE = 1.6
#: Shingles on more than this share of a sample of about HOT_DOCS documents are left out of blocks, HOT_MOST at most.
#: Sets without them differ in no more shingles than before, so this only spares comparisons; results are the same.
HOT_SHARE, HOT_DOCS, HOT_MOST = 0.002, 20_000, 100_000
#: Rows of a task that groups classes by key.
TASK_ROWS = 2_000_000
#: Keys with at least so many classes, and at least this share of all, don't go into one task; there are 1 / BUSY_SHARE
#: of them at most. A key is counted where a batch of documents has it at least so often and for at least this share.
BUSY, BUSY_SHARE = 20_000, 1e-6
SEEN, SEEN_SHARE = 16, 1e-3
#: Orders of classes that keys draw their second hub by: few, so that keys with the same classes share their hubs.
ORDERS = mix(np.arange(1, 5, dtype=np.uint64)).view(np.int64)
#: Classes of a key that a join compares; those of larger keys are compared in squares of about SQUARE by SQUARE classes.
FEW, SQUARE = 64, 1000
#: A set sends blocks without hot shingles if it has more than RARE * (the band's most differences) others.
RARE = 1.7


def apart(n: int, num: int, den: int) -> int:
    """The most shingles in which a set of n may differ from one that it links with."""
    return n * (den - num) // num


def most_apart(band: int, num: int, den: int) -> int:
    """The most differences of a set that sends blocks in a band."""
    return apart(largest(band), num, den)


def band_of(n: int) -> int:
    """The band of a size: band b holds the sizes whose squares are from 2 ** b on, below 2 ** (b + 1)."""
    return (n * n).bit_length() - 1


def largest(band: int) -> int:
    """The largest size of a band."""
    return math.isqrt((2 << band) - 1)


def bands(n: int, num: int, den: int) -> list[tuple[int, int]]:
    """The bands in which a set of n sends blocks, its own and those below that hold a set it may link with; and the most differences from such a set.

    Sets that link differ in at most (n_a + n_b) * (1 - t) / (1 + t) shingles. In its own band a set meets larger ones,
    up to n / t; in a band below only sets of that band matter.
    """
    own = band_of(n)
    out = [(own, apart(n, num, den))]
    for b in range(own - 1, -1, -1):
        top = largest(b)
        if n * num > den * top:
            break
        if band_of(top) == b:  # else no size is in this band
            out.append((b, (n + top) * (den - num) // (den + num)))
    return out


def block_keys(shingles: np.ndarray, differ: int, band: int, scheme: int, num: int, den: int) -> np.ndarray:
    """Keys of the blocks that a set sends in a band where it may differ in `differ` shingles, by all or some of its shingles.

    A block's content is the XOR of its shingles' hashes, a sketch of 64 parities, with their number. Of the differ + 1
    or more blocks that are sent, all hold at least a level's number of shingles, the highest level that leaves so many:
    equal blocks have equal numbers, so the set with the higher level finds its equal block sent by the other one.
    """
    blocks = int(SPARE * most_apart(band, num, den)) + 1
    seed = np.uint64(2 * band + scheme)
    own = ((shingles >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    order = np.argsort(own, kind="stable")
    first = np.flatnonzero(np.diff(own[order], prepend=np.uint64(blocks)))
    filled, sizes = own[order][first], np.diff(np.append(first, len(order)))
    content = np.bitwise_xor.reduceat(shingles[order], first) if len(first) else filled
    least = np.sort(sizes)[::-1][differ] if differ < len(sizes) else 0
    keys = mix(mix(content + seed) ^ mix((filled << np.uint64(24)) + sizes.astype(np.uint64)))[sizes >= least]
    if least == 0 and blocks > len(sizes):  # empty blocks count too where the filled ones don't suffice
        empty = np.setdiff1d(np.arange(blocks, dtype=np.uint64), filled)
        keys = np.concatenate([keys, mix(mix(np.full(len(empty), seed, np.uint64)) ^ mix(empty << np.uint64(24)))])
    return keys


def keys_of(shingles: np.ndarray, hot: np.ndarray, num: int, den: int) -> np.ndarray:
    """Keys of a set in all its bands.

    Linked sets have numbers of rare shingles that differ by their differences at most. With more than a band's bound
    the blocks are made of rare shingles, with up to the bound and the differences of all shingles, and in between of
    both; so two linked sets always have one kind in common.
    """
    rare = shingles[~np.isin(shingles, hot, assume_unique=True)] if len(hot) else shingles
    out = []
    for b, differ in bands(len(shingles), num, den):
        bound = RARE * most_apart(b, num, den) if len(hot) else -1
        if len(rare) > bound:
            out.append(block_keys(rare, differ, b, 0, num, den))
        if len(hot) and len(rare) <= bound + differ:
            out.append(block_keys(shingles, differ, b, 1, num, den))
    return np.unique(np.concatenate(out))


def parity(shingles: np.ndarray) -> np.ndarray:
    """A sketch of 2 to 4 parities for each shingle of the set, 256 at least: a power of two, so that a longer one folds to a shorter one."""
    bits = max(256, 2 << len(shingles).bit_length())
    flips = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").view(np.int64)


def hot_shingles(docs: DataFrame, k: int, id_col: str, text_col: str) -> np.ndarray:
    """Hashes of the commonest shingles in a sample of documents, HOT_MOST at most."""

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in slices(batch, 8 << 20):
            sets = [shingle_set(x, k) for x in part.column(0).to_pylist()]
            own, n = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            yield {"shingle": own[n > 1].view(np.int64), "n": n[n > 1]}  # once in a slice is too rare to matter

    share = min(1.0, HOT_DOCS / max(1, docs.count()))
    drawn = docs.where(F.pmod(F.xxhash64(F.lit("hot"), F.col(id_col)), F.lit(1 << 20)) < share * (1 << 20)).select(F.col(text_col).cast("binary"))
    counts = arrow_map(drawn, step, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    least = max(16, int(HOT_SHARE * min(HOT_DOCS, docs.count())))
    rows = counts.where(F.col("n") >= least).orderBy(F.desc("n"), "shingle").limit(HOT_MOST).collect()
    return np.sort(np.array([r["shingle"] for r in rows], np.int64).view(np.uint64))


def shingle_set(text: bytes | None, k: int) -> np.ndarray:
    return np.unique(windows(word_hashes().of(words_of(text, fold=True)), k))


def sketches(docs: DataFrame, k: int, num: int, den: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, cls, sketch, keys, n_keys, common, times): cls names the set (null: it is empty), so equal sets are one class from here on.

    A class's keys are in its first row of a batch, and the batch's common keys, with their number, in its first row.
    """
    hot = hot_shingles(docs, k, id_col, text_col)

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in slices(batch, 8 << 20):
            out: dict[str, list] = {c: [] for c in ("n", "cls", "sketch", "keys")}
            seen: set[int] = set()
            for text in part.column(1).to_pylist():
                own = shingle_set(text, k)
                cls = digest(own) if len(own) else None
                new = cls is not None and cls not in seen
                seen.add(cls)
                out["n"].append(len(own))
                out["cls"].append(cls)
                out["sketch"].append(parity(own) if new else None)
                out["keys"].append(keys_of(own, hot, num, den).view(np.int64) if new else None)
            sent = [x for x in out["keys"] if x is not None]
            every, times = np.unique(np.concatenate(sent), return_counts=True) if sent else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            often = times >= max(SEEN, SEEN_SHARE * len(sent))
            rest = [None] * (part.num_rows - 1)
            yield {"doc_id": part.column(0), "n_keys": [0 if x is None else len(x) for x in out["keys"]], "common": [every[often], *rest], "times": [times[often], *rest]} | out

    kind = docs.schema[id_col].dataType.simpleString()
    return arrow_map(docs.select(id_col, F.col(text_col).cast("binary")), step, f"doc_id {kind}, n long, cls long, sketch array<long>, keys array<long>, n_keys long, common array<long>, times array<long>")


def shared_keys(rows: DataFrame) -> DataFrame:
    """(key, cls, low, high): keys that several classes send, with the least class and one drawn by one of ORDERS, from sketches().

    Classes are grouped by key in tasks of a bounded number of rows. Busy keys are grouped by partial aggregates and
    joined with their groups instead, where the adaptive plan splits their rows over tasks.
    """
    spark = rows.sparkSession
    total = rows.agg(F.sum("n_keys")).first()[0] or 0
    counted = rows.where("common IS NOT NULL").select(F.explode(F.arrays_zip("common", "times")).alias("x")).groupBy(F.col("x.common").alias("key")).agg(F.sum("x.times").alias("n"))
    busy = durable(counted.where(F.col("n") >= max(BUSY, BUSY_SHARE * total)).select("key"), "busy")  # 1 / BUSY_SHARE rows at most
    keys = rows.where("keys IS NOT NULL").select(F.explode("keys").alias("key"), "cls")

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        got = list(batches)
        if not got:
            return
        key, cls = (np.concatenate([np.asarray(b.column(i)) for b in got]) for i in range(2))
        order = np.lexsort((cls, key))
        key, cls = key[order], cls[order]
        once = np.append(True, (key[1:] != key[:-1]) | (cls[1:] != cls[:-1]))
        key, cls = key[once], cls[once]
        at = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        sizes = np.diff(np.append(at, len(key)))
        turn = ORDERS[key & 3]
        drawn = np.minimum.reduceat(cls ^ turn, at) ^ turn[at]
        several = np.repeat(sizes > 1, sizes)
        yield {"key": key[several], "cls": cls[several], "low": np.repeat(cls[at], sizes)[several], "high": np.repeat(drawn, sizes)[several]}

    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_ROWS))
    calm = arrow_map_all(keys.join(F.broadcast(busy), "key", "left_anti").repartition(tasks, "key"), steps, "key long, cls long, low long, high long")
    mine = durable(keys.join(F.broadcast(busy), "key", "left_semi"), "busy-keys")
    turn = F.get(F.array(*(F.lit(int(x)) for x in ORDERS)), F.col("key").bitwiseAND(F.lit(3)).cast("int"))
    groups = mine.groupBy("key").agg(F.min("cls").alias("low"), F.max("cls").alias("top"), F.min(F.col("cls").bitwiseXOR(turn)).alias("drawn")).where("low < top")
    groups = durable(groups.select("key", "low", F.col("drawn").bitwiseXOR(turn).alias("high")), "groups")
    crowded = mine.distinct().join(groups, "key").select("key", "cls", "low", "high")
    out = durable(calm.unionByName(crowded), "members")
    release(mine, groups)
    return out


def hamming(a: Column, b: Column) -> Column:
    """Places in which two sketches differ, the longer one folded to the shorter one's length."""
    xor = lambda x, y: F.zip_with(x, y, lambda p, q: p.bitwiseXOR(q))
    fold = lambda x, y: F.when(F.size(x) > F.size(y), xor(F.slice(x, F.lit(1), F.size(y)), F.slice(x, F.size(y) + 1, F.size(y)))).otherwise(x)
    return F.aggregate(xor(fold(a, b), fold(b, a)), F.lit(0), lambda total, x: total + F.bit_count(x))


def fits(n_a: Column, n_b: Column, s_a: Column, s_b: Column, num: int, den: int) -> Column:
    """Whether sizes allow a link, and sketches differ in no more places than those of linked sets may."""
    small, large = F.least(n_a, n_b), F.greatest(n_a, n_b)
    return (large * num <= small * den) & (hamming(s_a, s_b) <= F.floor(small * (den - num) / num))


def close(pairs: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that fit."""
    one = classes.select(F.col("cls").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("s_a"))
    two = classes.select(F.col("cls").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("s_b"))
    return pairs.join(one, "a").join(two, "b").where(fits(F.col("n_a"), F.col("n_b"), F.col("s_a"), F.col("s_b"), num, den)).select("a", "b", "n_a", "n_b")


def square(pdf: pd.DataFrame, num: int, den: int) -> pd.DataFrame:
    """Pairs that fit between one or two parts of a key's classes, by sketches as bit matrices; rows of chunk `low` against those of `high`.

    A pair meets in every large key that both classes have (keys, in order); only the first of these reports it.
    """
    low, high = pdf["low"].iloc[0], pdf["high"].iloc[0]
    x, y = pdf[pdf["chunk"] == low], pdf[pdf["chunk"] == high]
    if not len(x) or not len(y):
        return pd.DataFrame([], columns=["a", "b", "n_a", "n_b"]).astype("int64")
    width = min(map(len, pdf["sketch"]), default=1)  # a longer sketch folds to the shortest one's length

    def bits(rows: pd.DataFrame) -> np.ndarray:
        return np.stack([np.bitwise_xor.reduce(np.asarray(s, np.int64).reshape(-1, width), axis=0) for s in rows["sketch"]]).view(np.uint64)

    found, s_x, s_y = [], bits(x), bits(y)
    c_x, c_y, k_x, k_y, n_x, n_y, all_x, all_y = (r[c].to_numpy() for c in ("cls", "comp", "n", "keys") for r in (x, y))
    key = pdf["key"].iloc[0]
    for i in range(len(x)):
        small, large = np.minimum(n_x[i], n_y), np.maximum(n_x[i], n_y)
        differ = np.zeros(len(y), np.int64)
        for w in range(width):
            differ += np.bitwise_count(s_x[i, w] ^ s_y[:, w])
        j = np.flatnonzero((large * num <= small * den) & (differ <= small * (den - num) // num) & (k_x[i] != k_y) & ((c_x[i] < c_y) | (low != high)))
        found += [(min(c_x[i], c_y[b]), max(c_x[i], c_y[b])) for b in j if np.intersect1d(all_x[i], all_y[b], assume_unique=True)[0] == key]
    sizes = dict(zip(pdf["cls"], pdf["n"], strict=True))
    return pd.DataFrame([(a, b, sizes[a], sizes[b]) for a, b in found], columns=["a", "b", "n_a", "n_b"]).astype("int64")


def compared(members: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b, n_a, n_b): pairs that fit among classes of one key that are of different components; members has key, cls and comp.

    Only fitting pairs leave the comparison. Keys with few classes are compared in a join; the others in squares of a
    bounded number of classes, each a task of its own, so that no key meets in one task.
    """
    sizes = members.groupBy("key").agg(F.min("comp").alias("__low"), F.max("comp").alias("__high"), F.count("*").alias("size")).where("__low < __high").select("key", "size")
    sizes = durable(sizes, "sizes")  # so that a large key's rows can be split in the join
    known = durable(members.join(sizes, "key").join(classes, "cls"), "apart")
    few = known.where(F.col("size") <= FEW)
    side = lambda x: few.select("key", F.col("cls").alias(x), F.col("comp").alias(f"comp_{x}"), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"s_{x}"))
    other = F.col("comp_a") != F.col("comp_b")
    joined = side("a").join(side("b"), "key").where((F.col("a") < F.col("b")) & other & fits(F.col("n_a"), F.col("n_b"), F.col("s_a"), F.col("s_b"), num, den)).select("a", "b", "n_a", "n_b")
    parts = F.ceil(F.col("size") / SQUARE)
    large = known.where(F.col("size") > FEW)
    lists = large.groupBy("cls").agg(F.collect_list("key").alias("keys"))  # bounded by what a class sends
    dealt = large.join(lists, "cls").withColumn("chunk", F.pmod(F.xxhash64("cls"), parts)).withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    dealt = dealt.select("key", F.least("chunk", "with").alias("low"), F.greatest("chunk", "with").alias("high"), "chunk", "cls", "comp", "n", "sketch", "keys")
    squares = dealt.groupBy("key", "low", "high").applyInPandas(lambda pdf: square(pdf, num, den), "a long, b long, n_a long, n_b long")
    return joined.unionByName(squares).distinct()


def digest(shingles: np.ndarray) -> int:
    """The name of a set's class."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def verify(pairs: DataFrame, docs: DataFrame, least: DataFrame, k: int, num: int, den: int, id_col: str, text_col: str) -> DataFrame:
    """The pairs that link, by their whole shingle sets, which one document of each class gives once more.

    Up to BROADCAST_ROWS such documents are broadcast by their ids, so that no text is shuffled; more meet the texts in a
    shuffled join. A class of which no document has an id is found by its name among those without ids.
    """
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    chosen = durable(least.join(wanted, "cls", "left_semi").select("cls", F.col("least").alias("__id")), "chosen")
    n = chosen.count()

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in slices(batch, 8 << 20):
            names = part.column(0).to_pylist()
            sets = [shingle_set(x, k) for x in part.column(1).to_pylist()]
            own = [i for i, (name, s) in enumerate(zip(names, sets, strict=True)) if digest(s) == name]  # rows of a repeated doc_id may have other texts
            yield {"cls": [names[i] for i in own], "shingles": [sets[i].view(np.int64) for i in own]}

    def named(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in slices(batch, 8 << 20):
            yield {"cls": [digest(shingle_set(x, k)) for x in part.column(0).to_pylist()], "text": part.column(0)}

    near = F.broadcast(chosen) if n <= BROADCAST_ROWS else chosen.hint("shuffle_hash")
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).cast("binary").alias("text")).join(near, "__id").select("cls", "text")
    if not chosen.where("__id IS NULL").isEmpty():
        nameless = arrow_map(docs.where(F.col(id_col).isNull()).select(F.col(text_col).cast("binary").alias("text")), named, "cls long, text binary")
        texts = texts.unionByName(nameless.join(near.where("__id IS NULL").select("cls"), "cls", "left_semi"))
    sets = durable(arrow_map(texts, step, "cls long, shingles array<long>"), "sets")
    if sets.count() > n:  # repeated rows
        sets = sets.dropDuplicates(["cls"])
    both = pairs.join(sets.select(F.col("cls").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("cls").alias("b"), F.col("shingles").alias("y")), "b")
    same = F.size(F.array_intersect("x", "y"))
    return both.where(same * den >= (F.col("n_a") + F.col("n_b") - same) * num).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(cls, comp): the least class that links reach, for each class with a link. Labels spread and jump until none changes."""
    both = durable(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = durable(both.groupBy(F.col("a").alias("cls")).agg(F.least(F.min("b"), F.first("a")).alias("comp")), "labels")
    while True:
        heard = both.join(labels.select(F.col("cls").alias("b"), "comp"), "b").groupBy(F.col("a").alias("cls")).agg(F.min("comp").alias("heard"))
        nearer = labels.join(heard, "cls").select("cls", F.col("comp").alias("old"), F.least("comp", "heard").alias("comp"))
        further = labels.select(F.col("cls").alias("comp"), F.col("comp").alias("jump"))
        step = durable(nearer.join(further, "comp").select("cls", "old", F.least("comp", "jump").alias("comp")), "labels")
        labels = step.select("cls", "comp")
        if not step.where("comp <> old").limit(1).count():
            return labels


def link(docs: DataFrame, k: int = K, num: int = NUM, den: int = DEN, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, links): per row of docs doc_id, n and cls, and the pairs of classes (a, b) that are linked and known.

    Links connect what all links connect; pairs within a group that earlier links have already joined are not tested.
    Each key's classes are first compared with the key's least class and with one drawn by the key. Classes of a key
    that are still apart are then compared with each other.
    """
    sent = durable(sketches(docs, k, num, den, id_col, text_col), "sketches")
    classes = durable(sent.where("keys IS NOT NULL").groupBy("cls").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch")), "classes")
    rows = durable(sent.select("doc_id", "n", "cls"), "rows")
    least = durable(rows.where("cls IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("least")), "least")
    members = shared_keys(sent)
    release(sent)
    stars = members.select("cls", F.explode(F.array("low", "high")).alias("hub")).where("cls <> hub").select(F.least("cls", "hub").alias("a"), F.greatest("cls", "hub").alias("b")).distinct()
    tested = durable(close(stars, classes, num, den), "stars")
    links = durable(verify(tested, docs, least, k, num, den, id_col, text_col), "links")
    # What is left: members of a key that are neither of its two hubs, and still apart.
    comps = components(links).withColumnsRenamed({"comp": "__comp"})
    inner = members.where("cls <> low AND cls <> high").select("key", "cls").distinct().join(comps, "cls", "left").select("key", "cls", F.coalesce("__comp", "cls").alias("comp"))
    rest = durable(compared(durable(inner, "inner"), classes, num, den), "near")
    rest = durable(rest.join(tested.select("a", "b"), ["a", "b"], "left_anti"), "rest")
    release(members)
    more = verify(rest, docs, least, k, num, den, id_col, text_col)
    return rows, durable(links.unionByName(more), "links")


def group(docs: DataFrame, k: int = K, num: int = NUM, den: int = DEN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: doc_id, n_shingles, and component_id, the least doc_id that links reach, its own included.

    A null or empty text, or one without words, has no shingles and no links. Equal sets link. Rows that repeat a
    doc_id are rows of their own; null ids stay null and name no component that has another. Other columns are ignored. An empty table gives none.
    """
    rows, links = link(docs, k, num, den, id_col, text_col)
    comps = components(links)
    labelled = durable(rows.join(comps, "cls", "left").select("doc_id", "n", F.coalesce("comp", "cls").alias("comp")), "components")
    least = durable(labelled.where("comp IS NOT NULL").groupBy("comp").agg(F.min("doc_id").alias("least")), "least")
    out = labelled.join(least, "comp", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))
