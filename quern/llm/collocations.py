"""Collocations of each language by best-first branch and bound over counts of phrases.

A phrase grows word by word, and its count only falls as it grows. So counts of short phrases bound the scores of
longer ones, and only phrases that may still be among the best are counted. All of a text's counting happens in its
task, on whole numbers that stand for words; what a task found is added up in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import arrow_map, arrow_map_all, durable, join_small, slices
from quern.llm.shingles import mix

#: Least occurrences of a phrase, places of a language, what scores are multiplied by, and the hundredths of a phrase's
#: occurrences that, within one longer phrase, drop it.
LEAST, TOP, SCALE, SHARE = 10, 2000, 1_000_000, 50
#: Language of documents without one.
UNKNOWN = "und"
#: Cells of a map of phrases at most; phrases that share a cell are only counted in vain.
CELLS = 1 << 24
#: Phrases that a task holds before it hands on what it has counted, and words that it numbers (21 bits).
HELD, WORDS = 1_000_000, 1 << 19
#: Bytes that are split at once; more where no piece or word ends.
PIECE = 4 << 20
#: Flags of phrases of two words: may begin, may end a phrase that is good enough, and is good enough itself.
BEGINS, ENDS, GOOD = 1, 2, 4

_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t.,;:!?\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz \n\n\n\n\n\n\n\n\n")
_BITS, _ODD = 21, np.uint64(0x9E3779B97F4A7C15)


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * _ODD + b)


def stretches(text: bytes, n: int) -> Iterator[bytes]:
    """A text in stretches that have each of its phrases of n words once: cut between pieces, or where a piece is long between words, n - 1 of which are then repeated."""
    at = 0
    while at < len(text):
        size, end = 2 * PIECE, text.find(b"\n", at + PIECE, at + 2 * PIECE)
        while end < 0:
            end = text.rfind(b" ", at, at + size) if at + size < len(text) else len(text)
            if end < len(text) and len(text[at : max(end, at)].split(None, n)) <= n:
                size, end = 2 * size, -1
        part = text[at:end]
        yield part
        cut_inside = end < len(text) and text[end : end + 1] == b" "
        at += len(part.rsplit(None, n - 1)[0]) if cut_inside and n > 1 else len(part) + (end < len(text))


class Counter:
    """Counts phrases of n words in texts of one language at a time, those that known lets through."""

    def __init__(self, n: int, known: np.ndarray | None):
        self.n, self.known = n, known
        self.clear()

    def clear(self) -> None:
        self.ids: dict[bytes, int] = {b"": 0, b"\n": 1}
        self.words: list[bytes] = [b"", b"\n"]
        self.hashes = np.zeros(2, np.uint64)
        self.fresh: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        self.held = 0

    def numbers(self, text: bytes) -> np.ndarray:
        """The text's words as numbers, 1 between pieces; no zeros."""
        split = text.replace(b"\n", b" \n ").split(b" ")
        new = set(split).difference(self.ids)
        self.ids.update(zip(new, range(len(self.words), len(self.words) + len(new))))
        self.words.extend(new)
        out = np.fromiter(map(self.ids.__getitem__, split), np.int64, len(split))
        return out[out != 0]

    def seeds(self, lang: str, w: np.ndarray) -> np.ndarray:
        """Hashes of words with the language."""
        if len(self.hashes) < len(self.words):
            more = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words[len(self.hashes) :]), np.uint64, len(self.words) - len(self.hashes))
            self.hashes = np.concatenate([self.hashes, more])
        return pair_hash(self.hashes[w], np.uint64(xxhash.xxh3_64_intdigest(lang.encode())))

    def flags(self, hashes: np.ndarray) -> np.ndarray:
        return self.known[(hashes & np.uint64(len(self.known) - 1)).astype(np.int64)]

    def add(self, lang: str, text: bytes) -> None:
        w = self.numbers(text)
        inside = w > 1
        if self.n == 1:
            keys, counts = np.unique(w[inside], return_counts=True)
            return self.hold(lang, np.append(keys, 0), np.append(counts, counts.sum()))  # no word stands for all
        if len(w) < self.n:
            return None
        own = self.seeds(lang, w)
        if self.n == 2:
            inside &= self.flags(own) > 0
            keys = (w[:-1] << _BITS | w[1:])[inside[:-1] & inside[1:]]
        else:
            flag = np.where(inside[:-1] & inside[1:], self.flags(pair_hash(own[:-1], own[1:])), 0)
            first, last = flag[:-1], flag[1:]
            good = ((first & BEGINS) > 0) & ((last & ENDS) > 0) | ((first | last) & GOOD > 0)
            keys = (w[:-2] << 2 * _BITS | w[1:-1] << _BITS | w[2:])[good & inside[:-2] & inside[1:-1] & inside[2:]]
        return self.hold(lang, *np.unique(keys, return_counts=True))

    def hold(self, lang: str, keys: np.ndarray, counts: np.ndarray) -> None:
        self.fresh.setdefault(lang, []).append((keys, counts))
        self.held += len(keys)

    def merge(self) -> None:
        for lang, parts in self.fresh.items():
            keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            self.fresh[lang] = [(keys, np.bincount(at, np.concatenate([c for _, c in parts]), len(keys)).astype(np.int64))]
        self.held = sum(len(parts[0][0]) for parts in self.fresh.values())

    def full(self) -> bool:
        if self.held > HELD:
            self.merge()
        return self.held > HELD // 2 or len(self.words) > WORDS

    def handed_on(self) -> Iterator[dict]:
        self.merge()
        vocabulary = np.array(self.words, object)
        for lang, ((keys, counts),) in self.fresh.items():
            for at in range(0, len(keys), 100_000):
                part = keys[at : at + 100_000]
                columns = {f"w{i + 1}": pa.array(vocabulary[part >> _BITS * (self.n - 1 - i) & (1 << _BITS) - 1], pa.binary()).cast(pa.string()) for i in range(self.n)}
                yield columns | {"lang": [lang] * len(part), "count": counts[at : at + len(part)]}
        self.clear()


def counted(docs: DataFrame, n: int, known: Broadcast | None = None) -> DataFrame:
    """(lang, w1, ..., wn, count) of phrases of n words in docs (lang, text) that come up LEAST times or more.

    Of single words all are counted, and a row with an empty word counts them together; of longer phrases those that
    known, a phrase_map() of their words or pairs, lets through.
    """

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        own = Counter(n, known.value if known else None)
        for batch in batches:
            for part in slices(batch, 4 << 20):
                by_lang: dict[str, list[bytes]] = {}
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist(), strict=True):
                    by_lang.setdefault(lang, []).append(text)
                for lang, texts in by_lang.items():
                    for text in stretches(b"\n".join(texts).translate(_FOLD), n):
                        own.add(lang, text)
                        if own.full():
                            yield from own.handed_on()
        yield from own.handed_on()

    names = [f"w{i + 1}" for i in range(n)]
    found = arrow_map_all(docs, steps, ", ".join(f"{c} string" for c in ("lang", *names)) + ", count long")
    return found.groupBy("lang", *names).agg(F.sum("count").alias("count")).where(F.col("count") >= LEAST)


def phrase_map(phrases: DataFrame, flag: Column) -> Broadcast:
    """Flags of phrases (lang, w1 and perhaps w2) by cells of their hashes, for all tasks.

    It has 16 cells a phrase and CELLS at most. Phrases that share a cell share their flags, so what the map holds is
    held surely, and what it doesn't hold may seem to be; exact counts decide afterwards.
    """
    words = [c for c in phrases.columns if c in ("w1", "w2")]
    rows = phrases.select("lang", *words, flag.cast("int").alias("flag")).where("flag > 0")
    size = 1 << max(6, min(CELLS.bit_length() - 1, (16 * rows.count()).bit_length()))

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        digest = lambda c: np.fromiter(map(xxhash.xxh3_64_intdigest, c.cast(pa.binary()).to_pylist()), np.uint64, len(c))
        lang, *own = [digest(batch.column(i)) for i in range(batch.num_columns - 1)]
        seeds = [pair_hash(w, lang) for w in own]
        place = pair_hash(*seeds) if len(seeds) == 2 else seeds[0]
        yield {"cell": (place & np.uint64(size - 1)).astype(np.int64), "flag": batch.column(batch.num_columns - 1)}

    cells = arrow_map(rows, step, "cell int, flag int").groupBy("cell").agg(F.expr("CAST(bit_or(flag) AS TINYINT)").alias("flag")).toArrow()  # CELLS rows at most
    out = np.zeros(size, np.uint8)
    out[cells.column("cell").to_numpy()] = cells.column("flag").to_numpy()
    return phrases.sparkSession.sparkContext.broadcast(out)


def score(a: str, left: str, right: str) -> Column:
    """floor(SCALE * a * a / (left * right)) of columns, exact: decimals of 38 digits hold it for counts up to 10^16."""
    big = lambda c: f"CAST({c} AS DECIMAL(19,0))"
    return F.expr(f"({big(a)} * {big(a)} * {SCALE}) div ({big(left)} * {big(right)})")


def joined(left: DataFrame, right: DataFrame, words: list[str], *values: Column) -> DataFrame:
    """left with the values of the row of right that has left's language and words; right's are w1, w2, as many."""
    own = right.select(F.struct("lang", *(f"w{i + 1}" for i in range(len(words)))).alias("key"), *values)
    return join_small(left.withColumn("key", F.struct("lang", *(F.col(w).alias(f"w{i + 1}") for i, w in enumerate(words)))), own, "key", "inner").drop("key")


def scored_pairs(texts: DataFrame, words: DataFrame) -> DataFrame:
    """(lang, w1, w2, a, l, r, score) and begins and ends, the bounds on scores of longer phrases that begin or end with the pair.

    A phrase of three that begins with the pair has at most a of its occurrences, and its rest no fewer, so its first
    cut scores SCALE * a / l at most; likewise its last cut, if it ends with the pair, SCALE * a / r.
    """
    pairs = counted(texts, 2, phrase_map(words, F.lit(1))).withColumnRenamed("count", "a")
    pairs = joined(joined(pairs, words, ["w1"], F.col("count").alias("l")), words, ["w2"], F.col("count").alias("r"))
    bound = lambda c: F.expr(f"CAST(a AS DECIMAL(25,0)) * {SCALE} div CAST({c} AS DECIMAL(25,0))")
    return durable(pairs.withColumns({"score": score("a", "l", "r"), "begins": bound("l"), "ends": bound("r")}), "pairs")


def thresholds(pairs: DataFrame, wanted: int) -> DataFrame:
    """(lang, least): the score of each language's wanted-th best pair; 0 where it has fewer."""
    cells = pairs.groupBy("lang", "score").count()  # SCALE + 1 a language at most
    place = F.sum("count").over(Window.partitionBy("lang").orderBy(F.desc("score")))
    reached = cells.withColumn("place", place).groupBy("lang").agg(F.max(F.when(F.col("place") >= wanted, F.col("score"))).alias("least"))
    return durable(reached.select("lang", F.coalesce("least", F.lit(0)).alias("least")), "thresholds")


def expanded(texts: DataFrame, pairs: DataFrame, least: DataFrame) -> DataFrame:
    """Phrases that score their language's least or more and survive: lang, phrase, a, l, r, score and least.

    Counted are phrases of three whose bounds on both sides reach the least score, as others can't, and those with a
    pair that reaches it, as they may drop the pair.
    """
    marked = join_small(pairs, least, "lang", "inner")
    reach = lambda c, bit: F.when(F.col(c) >= F.col("least"), bit).otherwise(0)
    known = phrase_map(marked, reach("begins", BEGINS) + reach("ends", ENDS) + reach("score", GOOD))
    three = counted(texts, 3, known).withColumnRenamed("count", "a")
    three = joined(three, pairs, ["w1", "w2"], F.col("a").alias("a12"), F.col("l").alias("a1"))
    three = durable(joined(three, pairs, ["w2", "w3"], F.col("a").alias("a23"), F.col("r").alias("a3")), "triples")
    cuts = three.withColumns({"s1": score("a", "a1", "a23"), "s2": score("a", "a12", "a3")})
    first = F.col("s1") <= F.col("s2")
    pick = lambda x, y: F.when(first, F.col(x)).otherwise(F.col(y))
    long = cuts.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", pick("a1", "a12").alias("l"), pick("a23", "a3").alias("r"), pick("s1", "s2").alias("score"))
    inner = [three.select("lang", F.col(x).alias("w1"), F.col(y).alias("w2"), "a") for x, y in (("w1", "w2"), ("w2", "w3"))]
    widest = durable(reduce(DataFrame.union, inner).groupBy("lang", "w1", "w2").agg(F.max("a").alias("longer")), "longer")
    good = marked.where("score >= least").withColumn("key", F.struct("lang", "w1", "w2"))
    good = join_small(good, widest.select(F.struct("lang", "w1", "w2").alias("key"), "longer"), "key").where(F.coalesce(F.col("longer") * 100 < F.col("a") * SHARE, F.lit(True)))
    short = good.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", "score")
    return durable(join_small(short.unionByName(long), least, "lang", "inner").where("score >= least"), "survivors")


def mine(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", top: int = TOP) -> DataFrame:
    """The best `top` phrases of two or three words of each language: lang, rank, phrase, a, l, r, n and score.

    The frontier of each language is expanded from its best pairs on: all phrases that may reach a least score are
    counted. Where `top` of them survive, all others score less, so these are its best, ties included; elsewhere the
    frontier goes on with a lower score, down to 0, which takes in everything.

    A null language counts as UNKNOWN, a null text as empty. Repeated rows count as often as they come up, texts are
    counted whole, of any length; equal scores are ordered by a, then by the phrase's bytes. An empty table gives none.
    Other columns are ignored, whatever their names.
    """
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).alias("text")).where("text <> ''")
    single = durable(counted(texts, 1), "words")
    totals = durable(single.where("w1 = ''").select("lang", F.col("count").alias("n")), "totals")
    pairs = scored_pairs(texts, single.where("w1 <> ''"))
    found, wanted, rest = [], 2 * top, pairs
    while not rest.isEmpty():
        least = thresholds(rest, wanted)
        best = expanded(texts, rest, least)
        done = best.groupBy("lang").agg((F.count_if(F.lit(True)) >= top).alias("done"))
        state = durable(least.join(done, "lang", "left").select("lang", ((F.col("least") == 0) | F.coalesce("done", F.lit(False))).alias("done")), "state")
        found.append(join_small(best, state.where("done"), "lang", "inner").select("lang", "phrase", "a", "l", "r", "score"))
        open_langs, wanted = state.where("NOT done").select("lang"), wanted * 4
        rest, texts = join_small(rest, open_langs, "lang", "left_semi"), join_small(texts, open_langs, "lang", "left_semi")
    empty = pairs.where("false").select("lang", F.col("w1").alias("phrase"), "a", "l", "r", "score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = reduce(DataFrame.unionByName, found, empty).withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return join_small(ranked, totals, "lang", "inner").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ORACLE = f"""WITH p AS (SELECT lang, list_filter(string_split_regex(x, '[ \t]+'), lambda w: w <> '') AS w FROM (SELECT coalesce(lang, '{UNKNOWN}') AS lang, unnest(string_split_regex(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[.,;:!?\n\x0B\x0C\r]')) AS x FROM documents)),
f AS (SELECT lang, k, p, count(*) AS f FROM (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS p FROM p, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k) GROUP BY ALL),
c AS (SELECT lang, k, p, f AS a, string_split(p, ' ') AS w FROM f WHERE k > 1 AND f >= {LEAST}),
x AS (SELECT lang, p, k, a, j, array_to_string(w[1:j], ' ') AS lp, array_to_string(w[j + 1:k], ' ') AS rp FROM c, (SELECT unnest([1, 2]) AS j) WHERE j < k),
y AS (SELECT x.*, l.f AS l, r.f AS r, CAST({SCALE}::HUGEINT * a * a // (l.f::HUGEINT * r.f) AS BIGINT) AS score FROM x JOIN f l ON l.lang = x.lang AND l.p = lp JOIN f r ON r.lang = x.lang AND r.p = rp),
z AS (SELECT * FROM y QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, j) = 1),
t AS (SELECT lang, p, max(a) AS longer FROM (SELECT lang, array_to_string(w[1:2], ' ') AS p, a FROM c WHERE k = 3 UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM c WHERE k = 3) GROUP BY ALL),
s AS (SELECT z.*, row_number() OVER (PARTITION BY z.lang ORDER BY score DESC, a DESC, z.p) AS rank FROM z LEFT JOIN t ON t.lang = z.lang AND t.p = z.p WHERE k = 3 OR longer IS NULL OR 100 * longer < {SHARE} * a)
SELECT s.lang, rank, p AS phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM s JOIN (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang) USING (lang) WHERE rank <= {TOP}"""
