"""Toxicity: tokens are restored from leetspeak, spacing and repetition by a noisy channel, then scored by learnt words and stems."""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import arrow_map, durable, slices

#: Labelled rows outside the held-out fold that the scorer is fitted on, drawn by a hash of their ids, and entries of
#: its lexicon. The character model counts every text.
FIT_ROWS, LEXICON = 40_000, 20_000
#: A word or stem enters the lexicon if so many toxic documents have it, and its likelihood ratio statistic and log odds are so large.
MIN_DOCS, MIN_G2, MIN_WEIGHT = 4, 24.0, 3.0
STEMS = (4, 5, 6)
#: Letters that a sign may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
#: Signs that may hide any letter, and signs that may stand between letters.
WILD, GAPS = "*#%", " .-_~'`,:;/\\"
#: Costs of the channel, in nats: a sign for a letter, any letter for a wild sign, a dropped gap, another dropped sign, a
#: dropped letter of a run of three or more.
SUBSTITUTED, HIDDEN, DROPPED, LOST, REPEATED = 1.0, 3.0, 0.7, 8.0, 0.3
#: The cost of a gap that is kept as a boundary in a run of single signs, and the signs of such a run that are restored
#: at once; the next ones start half way, so that a word of up to half as many is whole in one of them.
KEPT, WINDOW = 2.0, 80
#: Memory of a worker for tokens; it changes no result.
REMEMBERED = 400_000

#: Signs at a token's ends that are punctuation, not letters in disguise.
HEAD, TAIL = GAPS + '"[]{}<>?&=*#%', GAPS + '"()[]{}<>?&=*#%$!|'

_CLASS = bytes(ord(chr(i).lower()) - 96 if chr(i).isascii() and chr(i).isalpha() else 0 for i in range(256))
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_ODD = re.compile(r"[^\W\d_][^\w\s]*[\d@$!|+(*#%_€£][^\w\s]*[^\W\d_]|[\d@$!|+(€£][a-z]|[a-z][\d@$!|€£]|([a-z])\1\1|[^\W\d_][.\-_~'`,:;/\\*]+[^\W\d_][.\-_~'`,:;/\\*]+[^\W\d_]")
_SPACED = re.compile(r"(?<![^\W_])[a-z0-9@$!|+*#%(](?:[ \t._\-*]++[a-z0-9@$!|+*#%](?![^\W_])){3,}")
_SIGN = re.compile(r"[^ \t._\-*][ \t._\-*]*|^[ \t._\-*]+")
_DOUBLE = re.compile(r"([a-z])\1")


def count_triples(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """How often each triple of letters (0: no letter) comes up in all texts; 27 ** 3 counts, summed in Spark."""

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        total = np.zeros(27**3, np.int64)
        for part in slices(batch, 4 << 20):
            text = b"  ".join(x or b"" for x in part.column(0).to_pylist())
            x = np.frombuffer(b" " + text.translate(_CLASS).replace(b"\0\0", b"\0") + b"\0\0", np.uint8).astype(np.int32)
            x[0] = 0
            total += np.bincount(x[:-2] * 729 + x[1:-1] * 27 + x[2:], minlength=27**3)
        at = np.nonzero(total)[0]
        yield {"triple": at, "n": total[at]}

    counts = arrow_map(docs.select(F.col(text_col).cast("binary")), step, "triple int, n long").groupBy("triple").agg(F.sum("n").alias("n"))
    out = np.zeros(27**3)
    for r in counts.collect():  # 27 ** 3 rows at most
        out[r["triple"]] = r["n"]
    return out.reshape(27, 27, 27)


def log_probs(counts: np.ndarray) -> list:
    """Negative log probabilities of a letter after two others, interpolated with those after one and after none."""
    one = counts.sum(axis=(0, 1)) + 1.0
    one /= one.sum()
    two = counts.sum(axis=0)
    two = (two + 5 * one) / (two.sum(axis=1, keepdims=True) + 5)
    three = (counts + 5 * two[None]) / (counts.sum(axis=2, keepdims=True) + 5)
    return (-np.log(three)).tolist()


def restore(token: str, model: list, spaced: bool = False) -> str:
    """The likeliest letters behind a lower-case token: Viterbi over the lattice of what each sign may stand for.

    A state is the last two letters; letters outside a-z are their own and cost as a boundary does. In a spaced run a
    gap may also stay, as a boundary between words.
    """
    states, before = {(0, 0): (0.0, "")}, ""
    for i, c in enumerate(token):
        if "a" <= c <= "z":
            options = [(c, 0.0)]
        else:
            options = [(x, SUBSTITUTED) for x in LEET.get(c, "")]
            lone = c in WILD and before != c and token[i + 1 : i + 2] != c
            if lone:
                options += [(x, HIDDEN) for x in "abcdefghijklmnopqrstuvwxyz"]
            if c in GAPS or c in WILD or c in LEET:
                options.append(("", DROPPED if c in GAPS else LOST))
            if not options:
                options = [(c, 0.0)]
            if spaced and c in " \t._-*":
                options.append((" ", KEPT))
        if c == before and c not in GAPS and c * 3 in token[max(0, i - 2) : i + 2]:
            options.append(("", REPEATED))
        step: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (cost, text) in states.items():
            for x, extra in options:
                if x == " " and not b:
                    continue
                if x:
                    k = ord(x) - 96 if "a" <= x <= "z" else 0
                    to, total, out = (b, k), cost + extra + model[a][b][k], text + x
                else:
                    to, total, out = (a, b), cost + extra, text
                if to not in step or (total, out) < step[to]:
                    step[to] = (total, out)
        states, before = step, c
    return min((cost + model[a][b][0], text) for (a, b), (cost, text) in states.items())[1]


def undoubled(word: str) -> Iterator[str]:
    """word with some of its double letters made single, in all ways; of more than ten the first ten, as each doubles the ways."""
    at = [m.start() for m in _DOUBLE.finditer(word)][:10]
    for n in range(1, len(at) + 1):
        for drop in itertools.combinations(at, n):
            yield "".join(c for i, c in enumerate(word) if i not in drop)


def windows(run: str) -> Iterator[str]:
    """A run of single signs, in windows that overlap by half if it is long."""
    signs = _SIGN.findall(run)
    for i in range(0, max(1, len(signs) - WINDOW // 2), WINDOW // 2):
        yield "".join(signs[i : i + WINDOW]).strip()


def features(token: str) -> list[str]:
    """A restored token's word and stems; a stem ends in a star."""
    return [token, *(token[:n] + "*" for n in STEMS if len(token) > n)] if len(token) > 2 else []


class Restorer(dict):
    """Maps a raw token to what known() makes of its restored form; a worker keeps what it has seen."""

    def __init__(self, model: list, known=lambda word: word):
        super().__init__()
        self.model, self.known = model, known

    def __missing__(self, token: str):
        core = _EDGE.sub("", token) if not token.isalpha() else token
        bare = token.lstrip(HEAD).rstrip(TAIL)
        value = self.look(restore(bare, self.model) if _ODD.search(bare) else core)
        if len(self) >= REMEMBERED:
            self.clear()
        if len(token) <= 64:
            self[token] = value
        return value

    def look(self, word: str):
        """What is known of a word, or else of the first form with single letters for double ones that is known."""
        value = self.known(word)
        if value is None and _DOUBLE.search(word):
            value = next((v for x in undoubled(word) if (v := self.known(x)) is not None), None)
        return value

    def of(self, text: str) -> set:
        """Values of a text's distinct tokens, and of its runs of spaced letters; Nones are left out."""
        text = text.lower()
        found = {v for v in map(self.__getitem__, set(text.split())) if v is not None}
        for m in _SPACED.finditer(text):
            for part in windows(m[0]):
                found |= {v for w in restore(part, self.model, spaced=True).split() if (v := self.look(w)) is not None}
        return found


def in_fold(doc_id: Column) -> Column:
    """Whether a row is held out: crc32 of the id's text, mod 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, model: list, id_col: str = "doc_id", text_col: str = "text") -> tuple[dict[str, float], float, float]:
    """The lexicon (word or stem: weight) and the slope and offset of the score, from labelled rows outside the held-out fold.

    Rows with a null label don't count; of repeated labels the highest holds. Without rows of both labels the lexicon is
    empty and the score is the share of toxic rows (0 without any).
    """
    usable = labels.where(~in_fold(F.col("doc_id"))).where("toxic IS NOT NULL").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("__toxic"))
    share = min(1.0, FIT_ROWS / max(1, usable.count()))
    drawn = usable.where(F.pmod(F.xxhash64(F.lit("fit"), "doc_id"), F.lit(1 << 20)) < share * (1 << 20)).withColumnRenamed("doc_id", "__id")
    rows = docs.join(F.broadcast(drawn), docs[id_col] == F.col("__id")).select(F.col(text_col).alias("text"), "__toxic")  # about FIT_ROWS rows at most
    rows = durable(rows.groupBy("text").agg(F.max("__toxic").alias("__toxic")), "labelled")  # copies of a text are one witness

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        own, toxic, clean, sizes = Restorer(model), Counter(), Counter(), [0, 0]
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            (toxic if label else clean).update({f for w in own.of(text or "") for f in features(w)})
            sizes[label] += 1
        every = list(toxic.keys() | clean.keys())
        yield {"feature": [*every, ""], "toxic": [*(toxic[f] for f in every), sizes[1]], "clean": [*(clean[f] for f in every), sizes[0]]}

    counts = durable(arrow_map(rows, step, "feature string, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "features")
    sizes = counts.where("feature = ''").collect()
    a, b = (sizes[0]["toxic"], sizes[0]["clean"]) if sizes else (0, 0)
    if not a or not b:
        return {}, 0.0, (20.0 if a else -20.0)
    t, c = F.col("toxic"), F.col("clean")
    part = lambda seen, whole: F.when(seen > 0, seen * F.log(seen * (a + b) / ((t + c) * whole))).otherwise(0.0)
    absent = lambda seen, whole: F.when(whole - seen > 0, (whole - seen) * F.log((whole - seen) * (a + b) / ((a + b - t - c) * whole))).otherwise(0.0)
    g2 = 2 * (part(t, F.lit(a)) + part(c, F.lit(b)) + absent(t, F.lit(a)) + absent(c, F.lit(b)))
    weight = F.log((t + 0.5) / (a + 1)) - F.log((c + 2) / (b + 4))
    best = counts.where((F.col("feature") != "") & (t >= MIN_DOCS) & (t + c < a + b)).select("feature", g2.alias("g2"), weight.alias("weight")).where(f"g2 >= {MIN_G2} AND weight >= {MIN_WEIGHT}").orderBy(F.desc("g2"), "feature").limit(LEXICON)
    lexicon = {r["feature"]: r["weight"] for r in best.collect()}

    def measure(batch: pa.RecordBatch) -> Iterator[dict]:
        own = Restorer(model, known=weigh(lexicon))
        yield {"evidence": [round(sum(v for _, v in own.of(x or "")), 1) for x in batch.column(0).to_pylist()], "toxic": batch.column(1)}

    seen = arrow_map(rows, measure, "evidence double, toxic int").groupBy("evidence").agg(F.count("*").alias("n"), F.sum("toxic").alias("k"))
    points = np.array([(r["evidence"], r["n"], r["k"]) for r in seen.collect()], float)  # a row for each tenth of evidence
    return lexicon, *logistic(*points.T)


def weigh(lexicon: dict[str, float]):
    """A function that gives (word, weight) for a word with an entry, by its heaviest one, and None for others."""

    def known(word: str) -> tuple[str, float] | None:
        found = [lexicon[f] for f in features(word) if f in lexicon]
        return (word, max(found)) if found else None

    return known


def logistic(x: np.ndarray, n: np.ndarray, k: np.ndarray) -> tuple[float, float]:
    """Slope and offset of P(label | evidence) over grouped rows, with a weak pull to slope 0; Newton's method."""
    slope, offset = 0.5, math.log((k.sum() + 0.5) / (n.sum() - k.sum() + 0.5))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -30, 30)))
        w = np.maximum(n * p * (1 - p), 1e-9)
        g = np.array([((k - n * p) * x).sum() - 0.1 * slope, (k - n * p).sum() - 0.01 * offset])
        h = np.array([[(w * x * x).sum() + 0.1, (w * x).sum()], [(w * x).sum(), w.sum() + 0.01]])
        move = np.linalg.solve(h, g)
        slope, offset = slope + float(np.clip(move[0], -1, 1)), offset + float(np.clip(move[1], -1, 1))
        if np.abs(move).max() < 1e-6:
            break
    return slope, offset


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: doc_id, held_out, score in [0, 1] and predicted (score >= 0.5).

    A null text counts as empty; an empty text has no evidence. Scores depend on texts alone, so repeated rows have
    equal ones; other columns are ignored.
    """
    model = log_probs(count_triples(docs, text_col))
    lexicon, slope, offset = learn(docs, labels, model, id_col, text_col)

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in slices(batch):
            evidence = np.array([sum(v for _, v in sorted(own.of(x or ""))) for x in part.column(2).to_pylist()])
            p = 1 / (1 + np.exp(-np.clip(slope * evidence + offset, -30, 30)))
            yield {"doc_id": part.column(0), "held_out": part.column(1), "score": p, "predicted": (p >= 0.5).astype(int)}

    own = Restorer(model, known=weigh(lexicon))
    kind = docs.schema[id_col].dataType.simpleString()
    return arrow_map(docs.select(id_col, in_fold(F.col(id_col)).alias("held_out"), text_col), step, f"doc_id {kind}, held_out boolean, score double, predicted int")
