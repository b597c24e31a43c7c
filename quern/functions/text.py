"""Text columns: normalization, markers, scripts and numbers."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator, Mapping, Sequence

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word character, as Unicode-aware regular expressions have it.
WORD = r"[\p{L}\p{N}_]"
#: Words that betray the machinery behind a text; stems may go on, whole words may not.
MARKER_WORDS = ("mock", "fully simulated", "fully_simulated", "fully-simulated")
MARKER_STEMS = ("sentetik", "synthetic", "fixture", "fikstur", "fikstür", "simulated", "simulation", "simulasyon", "simülasyon", "simule", "simüle")
#: Letters of other scripts that stand for units.
UNIT_LETTERS = "µμ"
#: Turkish letters and their plain forms.
TURKISH_FROM, TURKISH_TO = "ıİşŞğĞüÜöÖçÇ", "iisSgGuUoOcC"


def folded(text: Column) -> Column:
    """Lower case, with a dotted capital I as a plain i."""
    return F.replace(F.lower(text), F.lit("i̇"), F.lit("i"))


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(folded(F.coalesce(text, F.lit(""))), F.lit(f"{WORD}+"), F.lit(0))


def normalized(text: Column) -> Column:
    """Lower-case words joined by a space, without compatibility folding; JVM only."""
    return F.array_join(tokens(text), " ")


def compatible(text: str) -> str:
    """Compatibility-folded, case-folded text, with a dotted i as a plain one."""
    return unicodedata.normalize("NFKC", text).casefold().replace("i̇", "i")


_words = re.compile(r"\w+").findall


@F.pandas_udf(T.StringType())
def normalized_nfkc(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Compatibility-folded, case-folded words joined by a space; a null stays null."""
    for s in texts:
        yield s.map(lambda x: x if x is None else " ".join(_words(compatible(x))))


class Shapes:
    """Puts ` <type> ` in place of entities, longest first and each wherever it stands, one after another.

    One automaton over all values finds those that occur in a text, so that only these are replaced, however many there
    are. A value may also come up by a replacement, if a mark holds it or it runs into one; these few are always tried.
    """

    def __init__(self, entities: Mapping[str, Sequence[str]]):
        pairs = [(compatible(v), f" <{kind}> ") for kind, values in entities.items() for v in values]
        self.pairs = sorted(((v, mark) for v, mark in pairs if v), key=lambda p: len(p[0]), reverse=True)
        marks = {mark for _, mark in self.pairs}
        self.found = ahocorasick.Automaton()
        self.always = set()
        for place, (value, _) in enumerate(self.pairs):
            self.found.add_word(value, [*self.found.get(value, []), place])
            if any(value in m or m in value or m.endswith(tuple(value[:k] for k in range(1, len(value)))) or m.startswith(tuple(value[k:] for k in range(1, len(value)))) for m in marks):
                self.always.add(place)
        if self.pairs:
            self.found.make_automaton()

    def of(self, text: str) -> str:
        text = compatible(text)
        if self.pairs:
            for place in sorted(self.always.union(*(places for _, places in self.found.iter(text)))):
                text = text.replace(*self.pairs[place])
        return " ".join(_words(text))


#: Entity values that are sent to every task at most.
ENTITY_VALUES = 1_000_000


def entity_shape(text: Column, entities: Mapping[str, Sequence[str]]) -> Column:
    """Compatibility-folded words with entities replaced by their types; a null stays null. entities has up to ENTITY_VALUES values."""
    if sum(map(len, entities.values())) > ENTITY_VALUES:
        raise ValueError("TOO_MANY_ENTITIES")

    @F.arrow_udf(T.StringType())
    def shaped(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Shapes(entities)  # built once a task
        for batch in texts:
            yield in_stretches(batch, own.of)

    return shaped(text)


#: Characters of texts that are Python's strings at once; it changes no result.
STRETCH = 2_000_000


def in_stretches(texts: pa.Array, change: Callable[[str], str]) -> pa.Array:
    """texts changed one by one, nulls kept; of a batch only a stretch of about STRETCH characters at a time is in Python's strings."""
    ends = np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    out, at = [], 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + STRETCH, "right")))
        out.append(pa.array([x if x is None else change(x) for x in texts.slice(at, upto - at).to_pylist()], pa.string()))
        at = upto
    done = pa.concat_arrays(out) if out else pa.array([], pa.string())
    out.clear()
    pa.default_memory_pool().release_unused()
    return done


def place(text: Column) -> Column:
    """A place name without Turkish letters, case and repeated space."""
    return F.trim(F.regexp_replace(F.lower(F.translate(text, TURKISH_FROM, TURKISH_TO)), r"\s+", " "))


def markers(text: Column) -> Column:
    """Markers in a text, in order and once each; an underscore may touch a marker, a letter or digit may not."""
    inner = "|".join([*MARKER_WORDS, *(stem + WORD + "*" for stem in MARKER_STEMS)])
    pattern = r"(?<![\p{L}\p{N}])(?:" + inner + r")(?![\p{L}\p{N}])"
    return F.array_sort(F.array_distinct(F.regexp_extract_all(folded(F.coalesce(text, F.lit(""))), F.lit(pattern), F.lit(0))))


def foreign_letters(text: Column) -> Column:
    """How many letters are neither Latin ones nor signs of units."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[\p{L}&&[^\p{IsLatin}" + UNIT_LETTERS + "]]")).cast("long")


def numbers(text: Column) -> Column:
    """Numbers in a text, a decimal comma for a point; not those that touch a word on the left."""
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?<![\p{L}\p{N}_])-?[0-9]+(?:[.,][0-9]+)?"), F.lit(0)), lambda x: F.translate(x, ".", ","))


def raw_timestamp(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(r"(?U)\b\d{4}-\d{2}-\d{2}T\d{2}:\d{2}")
