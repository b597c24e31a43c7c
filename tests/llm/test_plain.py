"""Decoding, spectra and peak pairs against plain versions that look at everything."""

import cmath
import itertools
import math
import random

import numpy as np
from pyspark.sql import functions as F

from quern.llm import audio, perplexity, toxicity


def choices(token, i, spaced):
    """What a sign may stand for, with its cost."""
    c, before = token[i], token[i - 1] if i else ""
    if "a" <= c <= "z":
        out = [(c, 0.0)]
    else:
        out = [(x, toxicity.SUBSTITUTED) for x in toxicity.LEET.get(c, "")]
        if c in toxicity.WILD and before != c and token[i + 1 : i + 2] != c:
            out += [(x, toxicity.HIDDEN) for x in map(chr, range(97, 123))]
        if c in toxicity.GAPS:
            out.append(("", toxicity.DROPPED))
        elif c in toxicity.WILD or c in toxicity.LEET:
            out.append(("", toxicity.LOST))
        out = out or [(c, 0.0)]
        if spaced and c in " \t._-*":
            out.append((" ", toxicity.KEPT))
    if c == before and c not in toxicity.GAPS and any(token[k : k + 3] == c * 3 and k <= i - 1 and i <= k + 2 for k in range(len(token))):
        out.append(("", toxicity.REPEATED))
    return out


def cost_of(path, model):
    a = b = 0
    total, text = 0.0, ""
    for x, extra in path:
        if x == " " and not b:
            return math.inf, ""
        total += extra
        if x:
            k = ord(x) - 96 if "a" <= x <= "z" else 0
            total += model[a][b][k]
            a, b, text = b, k, text + x
    return total + model[a][b][0], text


def test_restoring_finds_the_cheapest_reading():
    rng = random.Random(11)
    counts = np.array([[[rng.choice([0, 0, 1, 5, 40]) for _ in range(27)] for _ in range(27)] for _ in range(27)], float)
    model = toxicity.log_probs(counts)
    assert np.allclose(np.exp(-np.array(model)).sum(axis=2), 1)
    for n in range(250):
        spaced = n % 3 == 0
        token = "".join(rng.choice("abcee013$!@(+*-. 'é" if spaced else "abcee013$!@(+*-.'éoo") for _ in range(rng.randrange(1, 6)))
        if n % 5 == 0:
            token = token[:2] + "ooo" + token[2:4]
        best = min(cost_of(path, model) for path in itertools.product(*(choices(token, i, spaced) for i in range(len(token)))))
        got = toxicity.restore(token, model, spaced)
        reached = min(c for c, text in (cost_of(path, model) for path in itertools.product(*(choices(token, i, spaced) for i in range(len(token))))) if text == got)
        assert abs(reached - best[0]) < 1e-9, (token, got, best)


def test_long_spaced_runs_are_restored_whole():
    text = " ".join("you are all the worst people that ever lived in this house".replace(" ", "")) + "."
    found = [m[0] for m in toxicity._SPACED.finditer(text)]
    assert len(found) == 1 and found[0].replace(" ", "") == "youarealltheworstpeoplethateverlivedinthishouse"


def plain_peaks(samples):
    x = [b - 128 for b in samples]
    while len(x) < audio.FRAME or (len(x) - audio.FRAME) % audio.HOP:
        x.append(0)
    hann = [0.5 - 0.5 * math.cos(2 * math.pi * i / (audio.FRAME - 1)) for i in range(audio.FRAME)]
    spectra = []
    for at in range(0, len(x) - audio.FRAME + 1, audio.HOP):
        frame = [a * b for a, b in zip(x[at : at + audio.FRAME], hann, strict=True)]
        spectra.append([abs(sum(v * cmath.exp(-2j * math.pi * k * i / audio.FRAME) for i, v in enumerate(frame))) for k in range(audio.FRAME // 2 + 1)])
    value = lambda t, f: spectra[t][f] if 0 <= t < len(spectra) and 0 <= f < len(spectra[t]) else -1
    out = []
    for t, row in enumerate(spectra):
        mean = sum(row) / len(row)
        out += [(t, f) for f, v in enumerate(row) if v > value(t, f - 1) and v > value(t, f + 1) and v > value(t - 1, f) and v >= value(t + 1, f) and v > audio.OVER_MEAN * mean]
    return out


def test_peaks_and_pairs_equal_plain_transforms():
    rng = random.Random(12)
    for size in (64, 320, 704):
        samples = audio.pad(bytes(rng.choice(b"etaoin shrdlu\n") for _ in range(size - rng.randrange(60))))
        expected = plain_peaks(samples)
        assert list(zip(*(x.tolist() for x in audio.peaks(samples)), strict=True)) == expected
        pairs = []
        for i, (t, f) in enumerate(expected):
            for t2, f2 in expected[i + 1 : i + 1 + audio.FAN_OUT]:
                if t2 - t <= audio.REACH:
                    pairs.append((t, f * 2**13 + f2 * 2**5 + t2 - t))
        times, codes = audio.fingerprint(samples)
        assert list(zip(times.tolist(), codes.tolist(), strict=True)) == sorted(pairs)


def test_slices_are_bounded_by_characters(spark, monkeypatch):
    monkeypatch.setattr(perplexity, "SLICE", 1000)
    monkeypatch.setattr(perplexity, "LEAST_SLICE", 1000)
    docs = spark.createDataFrame([(i, "x" * (5000 if i == 7 else i % 90), "en") for i in range(400)] + [(None, None, None)] * 2, "doc_id long, text string, lang string")
    cut = perplexity.slices_of(docs, "doc_id", "text", "lang", True).select("__slice", "__place", F.length("text").alias("n"), "id", "row.doc_id").collect()
    assert sorted(-1 if r.id is None else r.id for r in cut) == sorted([*range(400), -1, -1]) and all(r.id == r.doc_id for r in cut)
    assert len({(r["__slice"], r["__place"]) for r in cut}) == len(cut)
    for name in {r["__slice"] for r in cut}:
        own = sorted((r["__place"], r.n or 0) for r in cut if r["__slice"] == name)
        assert [p for p, _ in own] == list(range(len(own))) and sum(n for _, n in own[:-1]) < 1000
