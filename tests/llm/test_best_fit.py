"""Dominance packing: plans against every packing, pieces against the tokenizer's own ids."""

import gc
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from quern.llm import best_fit
from quern.llm.queries import WORD_BPE
from tests.llm.conftest import edge_rows


def optimum(items, cap):
    """The least number of sequences, by trying all packings."""
    best, items = len(items), sorted(items, reverse=True)

    def go(i, filled):
        nonlocal best
        if len(filled) >= best:
            return
        if i == len(items):
            best = len(filled)
            return
        for k in {f: k for k, f in enumerate(filled) if f + items[i] <= cap}.values():
            filled[k] += items[i]
            go(i + 1, filled)
            filled[k] -= items[i]
        go(i + 1, [*filled, items[i]])

    go(0, [])
    return best


def histogram(items, cap):
    counts = Counter(items)
    return np.array([counts[n] for n in range(cap + 1)], object)


def sequences(runs):
    """The pieces of each sequence as (offset, length, rank)."""
    out = defaultdict(list)
    for r in runs.tolist():
        length, first, items, each, sequence, offset = r
        for i in range(items):
            out[sequence + i // each].append((offset + i % each * length, length, first + i))
    return out


def random_items(rng):
    cap = rng.choice([7, 10, 13, 20, 31])
    return [rng.randrange(1, cap + 1) for _ in range(rng.randrange(11))], cap


def test_fixed_sets_keep_the_optimum():
    rng = random.Random(1)
    some = 0
    for _ in range(600):
        items, cap = random_items(rng)
        own, fixed = best_fit.Lengths(histogram(items, cap)), 0
        for w in reversed(own.left.copy()):
            while own.count[w] and (need := best_fit.dominating(own, w, cap)):
                times = min(own.count[v] // n for v, n in need.items())
                own.take(need, times)
                fixed += times
        rest = [w for w in own.left for _ in range(own.count[w])]
        assert fixed + optimum(rest, cap) == optimum(items, cap), (items, cap)
        some += 0 < len(rest) < len(items)
    assert some > 10


def test_plans_place_every_piece_once_without_gaps():
    rng = random.Random(2)
    for n in range(600):
        items, cap = random_items(rng)
        if n % 5 == 0:
            items = items * 50
        counts = histogram(items, cap)
        found = sequences(best_fit.plan(counts, cap))
        placed = Counter((length, rank) for own in found.values() for _, length, rank in own)
        assert placed == Counter((n, k) for n in range(cap + 1) for k in range(counts[n]))
        for own in found.values():
            ends = 0
            for offset, length, _ in sorted(own):
                assert offset == ends
                ends += length
            assert ends <= cap
        if len(items) < 12:
            assert len(found) <= optimum(items, cap) + 1
    assert len(best_fit.plan(histogram([], 9), 9)) == 0


def test_plans_of_large_histograms_are_short_and_near_the_bound():
    rng = random.Random(3)
    counts = np.array([0] + [int(1e9 * rng.random() ** 8) for _ in range(4096)], object)
    runs = best_fit.plan(counts, 4096)
    used = max(int(r["sequence"]) + -(-int(r["items"]) // int(r["each"])) for r in runs)
    assert len(runs) < 20_000
    assert used <= 1.02 * -(-sum(n * c for n, c in enumerate(counts)) // 4096)


@pytest.mark.parametrize("max_len", [4096, 50])
def test_pieces_are_the_tokenizer_s_ids(edge, max_len):
    own = Tokenizer.from_file(WORD_BPE)
    own.encode_special_tokens = True
    rows = best_fit.pack(edge, WORD_BPE, max_len=max_len, keep_ids=True).collect()
    expected = Counter()
    for i, text, *_ in edge_rows():
        ids = [*own.encode(text or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), max_len)):
            raw = np.array(ids[at : at + max_len], "<u4").tobytes()
            expected[i, k, at, len(raw) // 4, zlib.crc32(raw), raw] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in rows) == expected
    filled = defaultdict(list)
    for r in rows:
        filled[r.sequence_id].append((r.offset, r.length))
    for own_pieces in filled.values():
        ends = 0
        for offset, length in sorted(own_pieces):
            assert offset == ends
            ends += length
        assert ends <= max_len
    assert len(filled) <= -(-sum(r.length for r in rows) // max_len) + 2


def test_words_are_encoded_alike_in_any_company():
    rng = random.Random(4)
    known, own = best_fit.WordIds(WORD_BPE), Tokenizer.from_file(WORD_BPE)
    own.encode_special_tokens = True
    signs = ["a", "B", "É", "é", "J̌", " ", "\t", "\n", "\r", "\x0b", "\x0c", "\x1c", "\x85", "\xa0", "'s", "'LL", "1", "²", "-", "<|endoftext|>", "日", "\U0001f600", "́", "\x00", "ﬁ"]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(12))) for _ in range(2000)]
    for text, ids in zip(texts, known.of([x.encode() for x in texts]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == own.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("remembered", [1_000_000, 5])
def test_ids_of_all_characters_and_broken_text(monkeypatch, remembered):
    monkeypatch.setattr(best_fit, "REMEMBERED", remembered)
    rng = random.Random(6)
    known, own = best_fit.WordIds(WORD_BPE), Tokenizer.from_file(WORD_BPE)
    own.encode_special_tokens = True
    signs = [*map(chr, range(0x180)), *map(chr, range(0x2000, 0x2030)), "€", "Σ", "K", "\ue000", "\ufffd", "é", "日本"]
    texts = ["".join(rng.choice(signs + [" ", "'ll", "a", "É"] * 20) for _ in range(rng.randrange(40))) for _ in range(300)] + [f"{x}A{x} É{x}{x}'S{x}" for x in signs]
    for _ in range(2):
        for at in range(0, len(texts), 100):
            part = texts[at : at + 100]
            for text, ids in zip(part, known.of([x.encode() for x in part]), strict=True):
                assert np.frombuffer(ids, "<u4").tolist() == own.encode(text, add_special_tokens=False).ids, repr(text)
    (ids,) = known.of([b"ab\xff\xc3 c\xe2\x82"])
    assert np.frombuffer(ids, "<u4").tolist() == own.encode("ab\ufffd\ufffd c\ufffd", add_special_tokens=False).ids
    assert list(known.of([])) == [] and list(known.of([b"", b" \n"])) == [b"", b""]


def test_words_share_what_is_kept_of_their_forms():
    known = best_fit.WordIds(WORD_BPE)
    words = [f"{case(x)}{sign}" for x in ("été", "los", "über", "señor") for case in (str, str.upper, str.title) for sign in ("", ".", "!!", "&&&", "***", ",---", "$$$")]
    list(known.of([" ".join(words).encode()]))
    assert len(known) < 15 < len(set(words))


def test_kept_words_take_few_bytes():
    rng = random.Random(7)
    words = list({"".join(rng.choice("abcdefghij") for _ in range(9)) for _ in range(40_000)})
    known = best_fit.WordIds(WORD_BPE)
    list(known.of([b"warm up"]))
    tracemalloc.start()
    before = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes()
    list(known.of([" ".join(words).encode()]))
    gc.collect()
    kept = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    tracemalloc.stop()
    assert kept < 80 * len(words)


def test_empty_table(empty):
    assert best_fit.pack(empty, WORD_BPE).count() == 0
