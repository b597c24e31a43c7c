"""Personal data: exact base formats, and boosted trees over the candidates of high-recall generators."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.common import arrow_map, durable, slices, unique_path
from quern.llm.pii_plants import planted

#: Kinds in the order of their spans at equal starts; the last three are the model's.
KINDS = ("email", "ip", "card", "phone", "secret", "contact", "number")
BASE = KINDS[:4]
#: The model is fitted on about so many texts with planted values, drawn by a hash of their ids (each text several times
#: where there are fewer, ROUNDS times at most), and on about so many candidates; everything else covers all rows.
FIT_DOCS, ROUNDS, FIT_CANDIDATES = 6_000, 100, 30_000
TREES, DEPTH, PRECISION, LEAST = 20, 5, 0.97, 0.6

_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: A text without any of these has no base spans, as each needs one; it may have candidates.
_ANY = re.compile(r"[0-9@]")
#: Generators: what they propose, and the kind of a span chosen from them.
GENERATORS = (
    ("secret", re.compile(r"(?i)(?<![a-z])(?:password|passwd|passphrase|passcode|pwd|secret|token|(?:api|access|private|secret)[ _-]?key)(?:\s*[=:]\s*|\s+(?:is|was)\s+)[\"']?([^\s\"',;]{6,})")),
    # Signed tokens of several parts, keys with a known prefix, and long runs with a digit.
    ("secret", re.compile(r"(?<![A-Za-z0-9_/+-])(eyJ[A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]+)+|(?:gh[pousr]_|AKIA|sk_)[A-Za-z0-9_]{12,}|(?=[A-Za-z_/+-]*[0-9])[A-Za-z0-9_/+-]{16,}={0,2})(?![A-Za-z0-9_/+-])")),
    ("contact", re.compile(r"(?<![^\s\"'(<\[])([^\s@\"'(<\[]+@[^\s@\"')>\]]*[^\s@\"')>\].,;:!?])")),
    ("contact", re.compile(r"(?i)(?<![a-z0-9._%+-])([a-z0-9._%+-]+ ?[\[(]? ?\bat\b ?[\])]? ?[a-z0-9-]+(?: ?[\[(]? ?\bdot\b ?[\])]? ?[a-z0-9-]+)+)")),
    ("contact", re.compile(r"(?i)(?<![a-z0-9._%+-])([a-z0-9.%+-]+_at_[a-z0-9-]+(?:_dot_[a-z0-9-]+)+)(?![a-z0-9_])")),
    ("number", re.compile(r"(?<![A-Za-z0-9])([(]?[0-9](?:[\x20().-]{0,3}[0-9]){5,})(?![A-Za-z0-9])")),
    # Account numbers of 15 to 34 characters, as their standard has it.
    ("number", re.compile(r"(?<![A-Za-z0-9])([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){10,30})(?![A-Za-z0-9])")),
    ("number", re.compile(r"(?<![A-Za-z0-9.])([0-9]+(?:[.:/-][0-9]+)+)(?![A-Za-z0-9])")),
    ("number", re.compile(r"(?<![A-Za-z0-9])([A-Z]{1,2}[0-9]{7,8})(?![A-Za-z0-9])")),  # passports
)
#: What a text must hold for each generator, as its pattern requires it: this saves time and loses nothing.
NEEDS = tuple(map(re.compile, ("[=:]|(?:is|was)\\s", "[0-9]|eyJ|gh[pousr]_|AKIA|sk_", "@", "[dD][oO][tT]", "_[dD][oO][tT]_", "[0-9]", "[0-9]", "[0-9]", "[0-9]")))
#: Words before a candidate that hint at a value of some kind.
HINTS = tuple(
    map(
        re.compile,
        (
            r"(?i)(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|key)(?:\s+(?:is|was))?\W*$", r"(?i)(?:e-?mail|contact|write)\W*(?:to\W*)?$", r"(?i)(?:phone|call|tel|fax|mobile|reach|dial|ring)\W*(?:me|us|him|her|them)?\W*(?:on|at)?\W*$",
            r"(?i)(?:card|account|iban|ssn|id|number|no|passport)\W*$", r"(?i)(?:version|section|v|license|page|by-nc)\W*$", r"(?i)(?:born|birth|birthday|dob)\W*(?:on\W*)?$",
        ),
    )
)
#: Formats that vouch for themselves, and others that do after a hint: what a text itself holds of these isn't taken for a look-alike.
_VOUCHED = re.compile(r"AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|eyJ[A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]+)+|[0-9a-f]{32,64}")
_SPELLED = re.compile(r"(?i).*(?:\b|_)dot(?:\b|_) ?[\])]? ?(?:com|org|net|edu|gov|info|io|[a-z]{2})")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{10,30}")
_LOCAL_PHONE = re.compile(r"[(]?[0-9](?:[\x20().-]{0,3}[0-9]){6,14}")
_ID = re.compile(r"[A-Z]{0,2}[0-9](?:[\x20./-]?[0-9]){5,19}")
#: The end of an address.
_DOMAIN_END = re.compile(r"(?i)(?:(?:\b|_)dot(?:\b|_)|\.)\W*(?:com|org|net|edu|gov|info|io|[a-z]{2})$")
_SIGN = re.compile(r"[=:\"']\s*$")
_DATE = re.compile(r"[0-9]{1,4}([./-])[0-9]{1,2}\1[0-9]{1,4}")
FEATURES = 27


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches; a match holds one @, so each @ is tried once, from the start of its local part."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind in KINDS, end) of the base kinds, in order."""
    if not _ANY.search(text):
        return []
    out = [(s, 0, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(start, end, generator) of all proposals; they may overlap. Proposals of one generator don't."""
    return sorted({(m.start(1), m.end(1), g) for g, (_, p) in enumerate(GENERATORS) if NEEDS[g].search(text) for m in p.finditer(text)})


def describe(text: str, start: int, end: int) -> list[float]:
    """Features of a candidate: its format, then its context."""
    x, n = text[start:end], end - start
    count = lambda test: sum(map(test, x)) / n
    digits = "".join(c for c in x if c.isascii() and c.isdigit())
    shares = [x.count(c) / n for c in set(x)]
    runs = re.split(r"[^0-9A-Za-z]+", x)
    before = text[max(0, start - 24) : start]
    form = [n, len(digits), count(str.isdigit), count(str.isupper), count(str.islower), count(lambda c: c in "0123456789abcdef"), -sum(p * math.log2(p) for p in shares), len(runs), max(map(len, runs)), "@" in x, x.startswith("+"), x.count("."), x.count("-"), x.count(" "), bool(digits) and luhn(digits), bool(re.search(r"[0-9][A-Za-z]|[A-Za-z][0-9]", x)), bool(_DOMAIN_END.search(x)), bool(_DATE.fullmatch(x)), bool(_VOUCHED.fullmatch(x))]
    context = [*(bool(h.search(before)) for h in HINTS), bool(_SIGN.search(before)), text[end : end + 1].isalnum()]
    return [float(v) for v in (*form, *context)]


def iban(x: str) -> bool:
    """Whether x is an account number whose check digits are right (mod 97)."""
    x = x.replace(" ", "")
    return bool(_IBAN.fullmatch(x)) and int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1


def evident(text: str, start: int, end: int) -> bool:
    """Whether a span's own format, or a key or hint before it with a format, speaks for it, whatever proposed it."""
    x, before = text[start:end], text[max(0, start - 24) : start]
    key, _, phone, number, version, born = (bool(h.search(before)) for h in HINTS)
    if _VOUCHED.fullmatch(x) or iban(x) or _SPELLED.fullmatch(x):
        return True
    return not version and (key and len(x) >= 6 and not x[0].isspace() or phone and bool(_LOCAL_PHONE.fullmatch(x)) or number and bool(_ID.fullmatch(x)) or born and bool(_DATE.fullmatch(x)))


def overlap(a: tuple[int, int], b: tuple[int, int]) -> float:
    """Shared characters of two spans as a share of all that they cover."""
    shared = min(a[1], b[1]) - max(a[0], b[0])
    return max(0, shared) / (max(a[1], b[1]) - min(a[0], b[0]))


def examples(text: str, rng: random.Random, held: bool = False) -> list[tuple[str, list[float], float]]:
    """Kinds, features and labels of the candidates in a text with planted values: 1 for those that hit a value or a base span, else 0.

    What the text itself holds of values isn't known, so a candidate of its own with evidence for it is left out.
    """
    whole, true, false = planted(text, rng, held)
    base, out = base_spans(whole), []
    for start, end, generator in candidates(whole):
        touch = lambda spans: any(overlap((start, end), s) > 0 for s in spans)  # noqa: B023, E731
        hit = any(overlap((start, end), s) >= 0.5 for s in (*true, *((s, e) for s, _, e in base)))
        if hit or touch((*true, *false)) or not evident(whole, start, end):
            out.append((GENERATORS[generator][0], describe(whole, start, end), float(hit)))
    return out


class Trees:
    """Boosted trees as arrays, to score many candidates at once inside a task, and the thresholds of kinds."""

    def __init__(self, nodes: list[dict], weights: list[float], thresholds: dict[str, float]):
        self.trees, self.thresholds = [], thresholds
        for k, w in enumerate(weights):
            own = sorted((x for x in nodes if x["tree"] == k), key=lambda x: x["id"])
            cols = [np.array([x[c] for x in own]) for c in ("feature", "cut", "left", "right", "value")]
            self.trees.append((w, *cols))

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for w, feature, cut, left, right, value in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                inner = left[at] >= 0
                down = np.where(x[np.arange(len(x)), np.maximum(feature[at], 0)] <= cut[at], left[at], right[at])
                at = np.where(inner, down, at)
            total += w * value[at]
        return 1 / (1 + np.exp(-2 * total))


def as_arrays(model: GBTClassificationModel, spark: SparkSession) -> Trees:
    path = unique_path(spark, "trees")
    model.write().save(path)
    split = F.col("nodeData.split")
    nodes = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.id", split["featureIndex"].alias("feature"), F.coalesce(F.get(split["leftCategoriesOrThreshold"], 0), F.lit(0.0)).alias("cut"), F.col("nodeData.leftChild").alias("left"), F.col("nodeData.rightChild").alias("right"), F.col("nodeData.prediction").alias("value"))
    return Trees([r.asDict() for r in nodes.collect()], list(model.treeWeights), {})  # 2 ** (DEPTH + 1) nodes a tree at most


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Trees | None:
    """Boosted trees fitted on candidates in texts with planted values, and thresholds calibrated by kind on the fifth of them that is held out.

    Held-out texts have values and look-alikes in forms (keys, leads, formats) that no other text has.

    Planting doesn't depend on what the texts hold, so small and large tables give like models; a null text counts as
    empty. None for an empty table: then no spans are added to the base ones.
    """

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in slices(batch):
            rows, labels, kinds, folds = [], [], [], []
            for text, turn in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                seed = int.from_bytes(hashlib.sha256(f"{turn}:{text}".encode("utf-8", "replace")).digest()[:8], "little")
                for kind, f, y in examples(text, random.Random(seed), seed % 5 == 0):
                    rows.append(f)
                    labels.append(y)
                    kinds.append(kind)
                    folds.append(seed % 5)
            yield {"f": rows, "label": labels, "kind": kinds, "fold": folds}

    n = docs.count()
    if not n:
        return None
    share, turns = min(1.0, FIT_DOCS / n), min(ROUNDS, -(-FIT_DOCS // n))
    drawn = docs.where(F.coalesce(F.pmod(F.xxhash64(F.lit("fit"), F.col(id_col)), F.lit(1 << 20)) < share * (1 << 20), F.lit(False)))
    carriers = drawn.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.explode(F.sequence(F.lit(1), F.lit(turns))).alias("turn"))
    found = durable(arrow_map(carriers, step, "f array<double>, label double, kind string, fold long"), "candidates")
    labels = {r["label"]: r["count"] for r in found.groupBy("label").count().collect()}
    if len(labels) < 2:
        return None
    part = min(1.0, FIT_CANDIDATES / sum(labels.values()))
    rows = found.where(F.pmod(F.xxhash64("fold", "f"), F.lit(1 << 20)) < part * (1 << 20)).withColumn("features", array_to_vector("f")).coalesce(4).cache()
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7).fit(rows.where("fold <> 0"))
    trees = as_arrays(model, docs.sparkSession)
    held = [(r["f"], r["label"], r["kind"]) for r in rows.where("fold = 0").select("f", "label", "kind").collect()]  # a fifth of FIT_CANDIDATES or so
    rows.unpersist()
    score, truth = trees.score(np.array([h[0] for h in held]).reshape(-1, FEATURES)), np.array([h[1] for h in held])
    for kind in dict.fromkeys(k for k, _ in GENERATORS):
        own = np.array([h[2] == kind for h in held], bool)
        trees.thresholds[kind] = calibrate(score[own], truth[own])
    return trees


def calibrate(score: np.ndarray, truth: np.ndarray) -> float:
    """The lowest score above which precision is at least PRECISION, and LEAST at least; 2 (never) if there is none."""
    order = np.argsort(-score, kind="stable")
    right = np.cumsum(truth[order]) / np.arange(1, len(order) + 1)
    last = np.append(score[order][1:] != score[order][:-1], True) if len(order) else np.zeros(0, bool)
    good = np.nonzero((right >= PRECISION) & last)[0]
    return max(LEAST, float(score[order][good[-1]])) if len(good) else 2.0


def find_all(texts: list[str], trees: Trees | None) -> list[list[tuple[int, int, int]]]:
    """All spans (start, place of the kind, end) of each text: the base ones, and chosen candidates.

    Of chosen candidates that overlap, the one with the higher score stays, then the earlier, then the longer one. One
    that overlaps base spans stays if it adds a letter or digit to them.
    """
    found = [base_spans(x) for x in texts]
    if trees is None:
        return found
    proposed = [(i, c) for i, x in enumerate(texts) for c in candidates(x)]
    if not proposed:
        return found
    scores = trees.score(np.array([describe(texts[i], *c[:2]) for i, c in proposed]))
    ranked = sorted((-s, i, c) for s, (i, c) in zip(scores, proposed, strict=True) if s >= trees.thresholds[GENERATORS[c[2]][0]])
    taken: dict[int, list[tuple[int, int, int]]] = {}
    for _, i, (start, end, g) in sorted(ranked, key=lambda r: (r[1], r[0], r[2][0], -r[2][1])):
        own = taken.setdefault(i, [])
        if all(end <= s or e <= start for s, _, e in own) and adds(texts[i], start, end, found[i]):
            own.append((start, KINDS.index(GENERATORS[g][0]), end))
    for i, own in taken.items():
        found[i] = sorted(found[i] + own)
    return found


def adds(text: str, start: int, end: int, base: list[tuple[int, int, int]]) -> bool:
    """Whether a span holds a letter or digit that no base span covers."""
    at = start
    for s, _, e in base:
        if at < s and any(map(str.isalnum, text[at : min(s, end)])):
            return True
        at = max(at, e)
    return at < end and any(map(str.isalnum, text[at:end]))


def render(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """text with each span replaced by its kind in brackets; where spans overlap, the earliest one's mark stands for all."""
    out, end = [], 0
    for s, k, e in spans:
        if s >= end:
            out += [text[end:s], f"[{KINDS[k]}]"]
        end = max(end, e)
    return "".join([*out, text[end:]])


def spans(docs: DataFrame, trees: Trees | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs the counts of kinds, the digest of base spans, and all spans (code points, end exclusive).

    A null text counts as empty, and an empty table gives no rows. Repeated rows give repeated rows; spans with equal
    starts are in the order of KINDS. Other columns are ignored, whatever their names.
    """

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in slices(batch):
            texts = [x or "" for x in part.column(1).to_pylist()]
            every = find_all(texts, trees)
            base = [[s for s in own if s[1] < len(BASE)] for own in every]
            counts = {f"n_{kind}": [sum(s[1] == k for s in own) for own in base] for k, kind in enumerate(BASE)}
            added = {f"n_{kind}": [sum(s[1] == k for s in own) for own in every] for k, kind in enumerate(KINDS) if k >= len(BASE)}
            yield {"doc_id": part.column(0)} | counts | added | {"base_sha256": [hashlib.sha256(render(b).encode()).hexdigest() for b in base], "spans": list(map(render, every))}

    kind = docs.schema[id_col].dataType.simpleString()
    return arrow_map(docs.select(id_col, text_col), step, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_secret long, n_contact long, n_number long")


def redact(docs: DataFrame, trees: Trees | None, text_col: str = "text") -> DataFrame:
    """docs with all spans of its texts replaced by marks; null texts stay null, other columns pass through."""

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        for part in slices(batch):
            texts = part.column(part.schema.get_field_index(text_col)).to_pylist()
            every = find_all([x or "" for x in texts], trees)
            done = [x if x is None else redacted(x, s) for x, s in zip(texts, every, strict=True)]
            yield {name: done if name == text_col else part.column(i) for i, name in enumerate(part.schema.names)}

    return arrow_map(docs, step, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema))
