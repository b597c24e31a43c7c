"""Documents packed into as few token sequences as can be: dominance reduction, then best fit.

How many pieces there are of each length decides the packing, not which ones they are. So the plan is made on the
histogram of lengths (max_len cells, whatever the corpus), in runs of equal sequences, and every piece finds its place
from its length and its rank among the pieces of that length.
"""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quern.llm.common import BROADCAST_ROWS, arrow_map, arrow_map_all, durable, give_back, kept, let_go, slices

#: Tokens of a sequence, and the id that ends each document.
MAX_LEN, END = 4096, 1
#: Forms of words whose ids a worker keeps, and about the bytes of these forms; they change no result.
REMEMBERED, REMEMBERED_BYTES = 1_000_000, 64 << 20
#: Bytes of texts that are encoded at once.
SLICE = 8 << 20
#: Bits of a rank in keys of (length, rank).
_RANK_BITS = 44
#: A run: `items` pieces of one length from rank `first` on, `each` to a sequence from `sequence` on, starting at `offset`.
RUN = np.dtype([("length", "i8"), ("first", "i8"), ("items", "i8"), ("each", "i8"), ("sequence", "i8"), ("offset", "i8")])


def strung(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of flat that begin at starts, sizes long, one after the other; shorter than 2^31 in all."""
    ends = np.cumsum(sizes, dtype=np.int32)
    at = np.repeat(starts - (ends - sizes), sizes)
    at += np.arange(len(at), dtype=np.int32)
    return flat[at]


def joined(words: pa.Array) -> str:
    """Strings, none of them null, with a line break after each."""
    lines = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words.view(pa.binary()))
    return (pc.binary_join(lines, b"\n")[0].as_py() + b"\n" * (len(words) > 0)).decode("utf-8", "replace")


class WordIds:
    """The ids of whole texts, from those of their words' forms.

    The tokenizer drops white space and merges nothing across it, so a text's ids are those of its words, and a batch
    encodes each distinct word once. It also folds case and parts letters, digits and signs, so a plain word (ASCII,
    letters of Latin-1 and common signs, which it only folds and parts) is its forms' ids; any other word is one form.
    Forms lie in one Arrow array and their ids in another, so that what a worker keeps of a million takes a few dozen MB.
    """

    SIGN = "\x00"
    #: What a plain word doesn't hold, the forms of plain words in lower case, and what stands for another word among them.
    OTHER = re.compile("[^\x00-\x7f¡«»¿À-ÖØ-öø-ÿ‐-‧€]")
    FORMS = re.compile("\ue000|\n|'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\na-zß-öø-ÿ0-9]+")
    HELD = "\ue000"
    #: Bytes that the model reads as characters from 256 on (others as Latin-1), but for the line break, which parts forms.
    HIDDEN = re.compile("[\x00-\t\x0b-\x20\x7f-\xa0\xad]")

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.tokenizer.no_truncation()
        self.model = self.tokenizer.model
        (self.sign,) = self._ids(self.SIGN)
        self.byte = {chr(b): chr(256 + k) for k, b in enumerate([*range(33), *range(127, 161), 173])}
        self.clear()

    def clear(self) -> None:
        self.forms = pa.array(["\n"])  # the end of a word, without ids
        self.starts, self.sizes, self.flat = np.zeros(1, np.int32), np.zeros(1, np.int32), np.zeros(0, "<u4")

    def __len__(self) -> int:
        return len(self.forms)

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def plain_ids(self, forms: list[str]) -> Iterator[list[int]]:
        """The ids of forms of plain words, by the model alone."""
        if forms:
            read = self.HIDDEN.sub(lambda x: self.byte[x[0]], "\n".join(forms).encode().decode("latin-1"))
            for form in read.split("\n"):
                yield [token.id for token in self.model.tokenize(form)]

    def other_ids(self, words: list[str]) -> list[list[int]]:
        """The ids of other words: up to 2,000 at once in one text, with a sign between words that none of them holds."""
        out = {w: self._ids(w) for w in words if self.SIGN in w}
        rest = [w for w in words if self.SIGN not in w]
        for at in range(0, len(rest), 2000):
            part = rest[at : at + 2000]
            ids, start = self._ids(f" {self.SIGN} ".join([*part, ""])), 0
            for w, end in zip(part, [i for i, x in enumerate(ids) if x == self.sign], strict=True):
                out[w] = ids[start:end]
                start = end + 1
        return [out[w] for w in words]

    def learn(self, forms: pa.Array) -> None:
        """Adds forms that aren't known."""
        new = joined(forms).split("\n")[:-1]
        other = [x for x in new if self.OTHER.search(x)]
        apart = dict(zip(other, self.other_ids(other), strict=True))
        plain = self.plain_ids([x for x in new if x not in apart] if apart else new)
        ids, sizes = array("I"), array("i")
        for x in new:
            own = apart[x] if x in apart else next(plain)
            ids.extend(own)
            sizes.append(len(own))
        ids, sizes = np.array(ids, "<u4"), np.array(sizes, np.int32)
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes, dtype=np.int32) - sizes], dtype=np.int32)
        self.sizes = np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate([self.flat, ids])
        self.forms = pa.concat_arrays([self.forms, forms])

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words one after the other, and how many each has."""
        lines, other = joined(words), []
        if self.OTHER.search(lines):
            each = lines.split("\n")
            other = [w for w in each if self.OTHER.search(w)]
            held = set(other)
            lines = "\n".join([self.HELD if w in held else w for w in each])
        forms = self.FORMS.findall(lines.lower())
        if other:
            held = iter(other)
            forms = [next(held) if x == self.HELD else x for x in forms]
        coded = pa.array(forms, pa.string()).dictionary_encode()
        if len(self) + len(coded.dictionary) > REMEMBERED or self.forms.nbytes > REMEMBERED_BYTES:
            self.clear()
        found = pc.index_in(coded.dictionary, value_set=self.forms)
        places = found.fill_null(-1).to_numpy(zero_copy_only=False).copy()
        if found.null_count:
            new = places < 0
            places[new] = np.arange(len(self), len(self) + found.null_count)
            self.learn(coded.dictionary.filter(pa.array(new)))
        at = places[coded.indices.to_numpy()]
        sizes = self.sizes[at]
        total = np.cumsum(sizes)[at == 0]
        return strung(self.flat, self.starts[at], sizes), np.diff(total, prepend=0).astype(np.int32)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts (UTF-8 in Arrow; null: empty), one after the other, and how many each has."""
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        flat, own = self.words(coded.dictionary)
        at = coded.indices.to_numpy()
        sizes = own[at]
        before = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        return strung(flat, (np.cumsum(own, dtype=np.int32) - own)[at], sizes), np.diff(before[split.offsets.to_numpy() - split.offsets[0].as_py()])

    def of(self, texts: list[bytes]) -> Iterator[bytes]:
        ids, sizes = self.encode(pa.array(texts, pa.binary()).view(pa.string()))
        for own in np.split(ids, np.cumsum(sizes)[:-1]) if texts else []:
            yield own.tobytes()


@kept
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def pieces(docs: DataFrame, path: str, id_col: str, text_col: str, max_len: int, keep_ids: bool, end: int = END) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, own, its rank in its length and task (part), and its ids if they are kept."""
    most = max(1, (16 << 20) // max_len)  # pieces of an Arrow batch

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        let_go(word_ids)
        known, seen, part_id = word_ids(path), Counter(), TaskContext.get().partitionId()
        for batch in batches:
            for part in slices(batch, SLICE):
                ids, sizes = known.encode(part.column(1).cast(pa.binary()).view(pa.string()))
                ends = np.cumsum(sizes + 1)
                whole = np.full(len(ids) + len(sizes), end, "<u4")
                inside = np.ones(len(whole), bool)
                inside[ends - 1] = False
                whole[inside] = ids
                del ids, inside
                cuts = -(-(sizes + 1) // max_len)  # pieces of each document
                at = np.repeat(np.arange(len(cuts)), cuts)
                k = np.arange(len(at)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
                start = k * max_len
                length = np.minimum(sizes[at] + 1 - start, max_len)
                places = np.concatenate([[0], np.cumsum(length)])
                for first in range(0, len(at), most):
                    one = slice(first, first + most)
                    n, lo = length[one], places[first]
                    raw, offsets = pa.py_buffer(whole[lo : lo + n.sum()]), (4 * (places[first : first + len(n) + 1] - lo)).astype(np.int32)
                    own = []
                    for x in n.tolist():
                        own.append(seen[x])
                        seen[x] += 1
                    pieces = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets), raw])
                    crc = [zlib.crc32(memoryview(raw)[i:j]) for i, j in zip(offsets.tolist(), offsets[1:].tolist())]
                    yield {"doc_id": part.column(0).take(pa.array(at[one])), "piece": k[one], "start": start[one], "length": n, "ids_crc32": crc, "part": [part_id] * len(n), "own": own, "ids": pieces}
        whole = raw = pieces = part = batch = None
        give_back()

    kind = docs.schema[id_col].dataType.simpleString()
    return arrow_map_all(docs.select(id_col, text_col), steps, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, part int, own long" + ", ids binary" * keep_ids)


class Lengths:
    """Counts of pieces by length, with the lengths that are left in order."""

    def __init__(self, counts: np.ndarray):
        self.count = counts.astype(object)  # exact whatever the corpus
        self.left = [w for w in range(1, len(counts)) if counts[w]]

    def take(self, need: Counter, times: int) -> None:
        for w, n in need.items():
            self.count[w] -= n * times
            if not self.count[w]:
                del self.left[bisect_left(self.left, w)]

    def others(self, w: int, v: int) -> int:
        """How many pieces of length v there are beside one of length w."""
        return self.count[v] - (v == w)

    def smallest(self, w: int, k: int, above: int = 0) -> list[int]:
        """The k smallest pieces longer than above, beside one of length w."""
        out: list[int] = []
        for i in range(bisect_right(self.left, above), len(self.left)):
            out += [self.left[i]] * min(k - len(out), self.others(w, self.left[i]))
            if len(out) == k:
                break
        return out

    def largest(self, w: int, room: int) -> int:
        """The largest piece that fits the room beside one of length w; 0 for none."""
        i = bisect_right(self.left, room) - 1
        while i >= 0 and not self.others(w, self.left[i]):
            i -= 1
        return self.left[i] if i >= 0 else 0

    def best_pair(self, w: int, room: int) -> int:
        """The largest sum of two pieces within the room, beside one of length w; 0 for none."""
        best, i, j = 0, 0, len(self.left) - 1
        while i <= j:
            a, b = self.left[i], self.left[j]
            if a + b > room or not self.others(w, b):
                j -= 1
            elif not self.others(w, a) or i == j and self.others(w, a) < 2:
                i += 1
            else:
                best = max(best, a + b)
                i += 1
        return best


def dominating(own: Lengths, w: int, cap: int) -> Counter | None:
    """A set with a piece of length w that dominates all sets with it, after Martello and Toth; None where none is proven.

    A set dominates another if the other's pieces can be dealt to its pieces so that none gets more than its length.
    With k the number of the smallest pieces that fit beside w together and v the largest piece that fits alone: nothing
    fits for k = 0. {w, v} dominates where k = 1 or it fills the sequence, and where k = 2 if no pair fits that is
    longer than v. Where k = 2 and the longest pair is {v, b}, {w, v, b} dominates unless two pieces longer than b fit.
    """
    room = cap - w
    least = own.smallest(w, 3)
    k = sum(sum(least[:i]) <= room for i in range(1, len(least) + 1))
    if k == 0:
        return Counter([w])
    v = own.largest(w, room)
    if k == 1 or v == room:
        return Counter([w, v])
    if k == 2:
        pair = own.best_pair(w, room)
        if pair <= v:
            return Counter([w, v])
        b = pair - v
        if 0 < b < len(own.count) and own.count[b] >= Counter([w, v, b])[b] and own.count[v] >= Counter([w, v, b])[v]:
            longer = own.smallest(w, 2, above=b)
            if len(longer) < 2 or sum(longer) > room:
                return Counter([w, v, b])
    return None


def plan(counts: np.ndarray, cap: int) -> np.ndarray:
    """Runs that place counts[n] pieces of each length n (counts[0] is 0) in sequences of cap tokens.

    Sets that dominate are fixed for good, from the longest piece down and again while any is found; as equal pieces
    go with equal sets, each step fixes as many sets as there are pieces for and uses up a length. What is left goes
    to the fullest sequence with room, longest first, all pieces of a length at once: this splits two groups of equal
    sequences at most and halves the room of the others, so there are no more than 3 * cap * log2(cap) runs.
    """
    own, runs, sequences = Lengths(counts), [], 0
    first = [0] * (cap + 1)

    def run(w: int, times: int, each: int, sequence: int, offset: int) -> None:
        runs.append((w, first[w], times * each, each, sequence, offset))
        first[w] += times * each

    found = True
    while found:
        found = False
        for w in reversed(own.left.copy()):
            while own.count[w] and (need := dominating(own, w, cap)):
                times = min(own.count[v] // n for v, n in need.items())
                own.take(need, times)
                offset, found = 0, True
                for v, n in need.items():
                    run(v, times, n, sequences, offset)
                    offset += v * n
                sequences += times
    groups: dict[int, list[tuple[int, int]]] = {}  # by room: (first sequence, how many)
    rooms: list[int] = []  # in order

    def put(room: int, sequence: int, many: int) -> None:
        if many and room:
            if room not in groups:
                insort(rooms, room)
            groups.setdefault(room, []).append((sequence, many))

    for w in reversed(own.left):
        left = own.count[w]
        while left:
            at = bisect_left(rooms, w)
            if at < len(rooms):
                room = rooms[at]
                sequence, many = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[at]
            else:
                room, sequence, many = cap, sequences, -(-left // (cap // w))
                sequences += many
            each = room // w
            full = min(many, left // each)
            if full:
                run(w, full, each, sequence, cap - room)
                put(room - each * w, sequence, full)
                left -= full * each
            if full < many and left:
                run(w, 1, left, sequence + full, cap - room)
                put(room - left * w, sequence + full, 1)
                left, full = 0, full + 1
            put(room, sequence + full, many - full)
    return np.array(runs, RUN)


def placed(rows: DataFrame, path: np.ndarray) -> DataFrame:
    """rows (with length and rank) with sequence_id and offset, in place of rank, after the runs of a plan."""
    order = np.lexsort((path["first"], path["length"]))
    runs = path[order]
    keys = (runs["length"] << _RANK_BITS) + runs["first"]
    shared = rows.sparkSession.sparkContext.broadcast((keys, runs))  # 3 * max_len * log2(max_len) runs at most

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        keys, runs = shared.value
        column = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        length, rank = column["length"].to_numpy(), column.pop("rank").to_numpy()
        found = runs[np.searchsorted(keys, (length << _RANK_BITS) + rank, "right") - 1]
        at = rank - found["first"]
        yield column | {"sequence_id": found["sequence"] + at // found["each"], "offset": found["offset"] + at % found["each"] * length}

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.drop("rank").schema)
    return arrow_map(rows, step, f"{kept}, sequence_id long, offset long")


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", max_len: int = MAX_LEN, keep_ids: bool = False) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset; with keep_ids also ids (binary).

    path names the tokenizer's file. A document is its ids and END; only longer ones are cut. A null or empty text is
    END alone. Repeated rows are pieces of their own; pieces of equal length may stand in each other's place. An empty
    table gives none. Other columns are ignored, whatever their names. Texts of any length are encoded whole.
    """
    rows = durable(pieces(docs, path, id_col, text_col, max_len, keep_ids), "pieces")
    sizes = durable(rows.groupBy("part", "length").count(), "piece-counts")  # no more rows than pieces
    found = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("count").alias("n")).collect()}  # max_len rows at most
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = durable(sizes.select(F.col("part").alias("part_"), F.col("length").alias("length_"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before")), "piece-starts")
    near = F.broadcast(starts) if starts.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else starts.hint("merge")
    ranked = rows.join(near, (F.col("part") == F.col("part_")) & (F.col("length") == F.col("length_"))).withColumn("rank", F.col("own") + F.col("before"))
    counts = np.array([found.get(n, 0) for n in range(max_len + 1)], object)
    return placed(ranked.select("doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * keep_ids, "rank"), plan(counts, max_len))
