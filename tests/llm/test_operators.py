"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, against plain versions."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import audio, bpe, fm_index, packing, parity_join, perplexity, pii, quality_rules, site_lines, substring, toxicity
from quern.llm.queries import RANKS
from tests.llm.conftest import edge_rows, words


def pairs(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.select(*columns).collect()), key=repr)


def test_quality_rules_counts(edge, labels):
    got = quality_rules.judge(edge, labels)
    expected = []
    for i, text, *_ in edge_rows():
        w, lines = words(text), [x for x in (text or "").split("\n") if x.encode().split()]
        triples = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        twice = {t for t in triples if triples.count(t) > 1} if len(triples) < 2000 else set(triples)
        covered = {k + j for k, t in enumerate(triples) if t in twice for j in range(3)}
        chars = sum(len(x.decode()) for x in w)
        expected.append((i, len(w), chars, len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w)))
    assert pairs(got, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == sorted(expected, key=repr)
    assert got.where("kept AND base_failed").count() == 0


def test_quality_rules_certify_only_with_evidence(spark):
    n = 4000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.when(F.col("id") % 4 == 0, F.concat(F.lit("*** "), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(60)), lambda k: F.concat(F.lit("w"), (k + F.col("id") * 61).cast("string"), F.lit("**"))), " "))).otherwise(F.array_join(F.transform(F.sequence(F.lit(1), F.lit(60)), lambda k: F.concat(F.lit("w"), (k + F.col("id") * 61).cast("string"))), " ")).alias("text"))
    labels = spark.range(n).select(F.col("id").alias("doc_id"), (F.col("id") % 4 != 0).cast("int").alias("quality"))
    out = quality_rules.judge(docs, labels)
    assert out.where("kept").count() == n - n // 4
    assert quality_rules.judge(docs, labels.where("doc_id < 40")).where("kept").count() == n  # too few labels certify nothing


def test_binomial_tail(spark):
    from math import comb

    df = spark.createDataFrame([(n, k) for n in (1, 10, 500) for k in (0, 1, 5) if k <= n], "n long, k long")
    for r in df.select("n", "k", quality_rules.at_most(df.n, df.k, 0.02).alias("p")).collect():
        assert abs(r.p - sum(comb(r.n, i) * 0.02**i * 0.98 ** (r.n - i) for i in range(r.k + 1))) < 1e-9


def plain_spans(text):
    out = []
    patterns = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")
    for k, p in enumerate(patterns):
        for m in re.finditer(p, text):
            digits = re.sub(r"[^0-9]", "", m[0])
            if k == 0 or k == 1 and all(int(x) <= 255 for x in m[0].split(".")) or k == 2 and 14 <= len(digits) <= 19 and pii.luhn(digits) or k == 3 and 10 <= len(digits) <= 15:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_pii_base_spans_equal_the_plain_patterns():
    rng = random.Random(2)
    parts = ["a.b@c.de", "@", "x@y", "a@b.c_d@e.f", "1.2.3.4.5", "300.1.1.1", "001.2.3.4", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (705) 555-7016", "+12", "++4912345678901", " ", "..", "9", "-", "\n", "é"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 14)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_pii_whole(edge, empty):
    got = {r.doc_id: r for r in pii.spans(edge, pii.fit(edge)).collect() if r.doc_id == 15}[15]
    assert (got.n_email, got.n_ip, got.n_card, got.n_phone) == (1, 1, 1, 1)
    assert pii.spans(edge, None).count() == len(edge_rows())
    assert pii.spans(empty, pii.fit(empty)).count() == 0
    clean = pii.redact(edge, None)
    assert clean.columns == edge.columns
    text = clean.where("doc_id = 15").first().text
    assert "@" not in text and "[email]" in text and "[card]" in text


def test_pii_model_adds_secrets(spark):
    rng = random.Random(1)
    key = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(20))
    rows = [(i, f"some words password={key()} more" if i % 3 == 0 else f"License Version 2.{i % 9} and by-nc 4.0 {'word' * 6}{i}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in pii.spans(docs, pii.fit(docs)).collect()}
    assert sum("secret" in spans[i] for i in range(0, 600, 3)) > 190
    assert all(not spans[i] for i in range(600) if i % 3)


def test_trees_score_as_the_fitted_model(spark):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    rng = np.random.default_rng(2)
    x = rng.normal(size=(800, 4)).round(1)
    rows = [(r.tolist(), float(r[0] * r[1] + r[2] > 0.3)) for r in x]
    df = spark.createDataFrame(rows, "f array<double>, label double").withColumn("features", array_to_vector("f"))
    model = GBTClassifier(maxIter=8, maxDepth=pii.DEPTH, seed=1).fit(df)
    own = pii.as_arrays(model, spark).score(x)
    assert np.allclose(own, [r.probability[1] for r in model.transform(df).collect()], atol=1e-9)


def case(kind, rng):
    """A value in a form of its own for this test, with what stands around it."""
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    if kind == "secret":
        return rng.choice([("Password: ", word(5) + digits(4), " was"), ("set API_KEY=", word(10) + digits(9) + word(8), ";"), ('token = "', "".join(rng.choice("0123456789abcdef") for _ in range(40)), '"'), ("pwd=", word(9), " and")])
    if kind == "contact":
        return rng.choice([("ask ", f"{word(6)}.{word(5)} at {word(7)} dot com", " for it"), ("", f"{word(6)} (at) {word(5)} (dot) net", " soon"), ("e-mail ", f"{word(3)}ü{word(3)}@{word(6)}.org", " there")])
    return rng.choice([("call ", f"{rng.randrange(210, 980)}-555-{digits(4)}", " today"), ("his ssn ", f"{rng.randrange(100, 890)}-{digits(2)}-{digits(4)}", " is"), ("Phone: ", f"020 {rng.randrange(1000, 9999)} {digits(4)}", " or"), ("account no ", digits(10), " of")])


@pytest.mark.parametrize("n", [40, 1000, 10_000])
def test_pii_recall_by_kind(spark, n):
    rng = random.Random(n)
    vocabulary = ["river", "stone", "window", "garden", "summer", "little", "people", "water", "morning", "evening"]
    text = lambda: " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(5, 60)))
    trees = pii.fit(spark.createDataFrame([(i, text()) for i in range(n)], "doc_id long, text string"))
    clean = ["the manual, version 4.2.19, of 2021-03-04", "pages 12-19 and 3.1415926", "CC BY-NC 4.0 and Apache License, Version 2.0.", "look at window dot garden here", "snake_case_name_of_things_v2", "a secret: none", "ratio 12/30 at 10:20:30", f"{'word' * 6}7"]
    for kind in ("secret", "contact", "number"):
        hit = wrong = 0
        for _ in range(300):
            before, x, after = case(kind, rng)
            whole = f"{text()} {before}{x}{after} {text()}"
            at = whole.index(before + x) + len(before)
            (spans,) = pii.find_all([whole], trees)
            hit += any(pii.overlap((s, e), (at, at + len(x))) >= 0.8 for s, _, e in spans)
            (none,) = pii.find_all([f"{text()} {rng.choice(clean)} {text()}"], trees)
            wrong += bool(none)
        assert hit >= 270 and wrong <= 15, (kind, hit, wrong)


def test_bounds_are_optimal():
    rng = random.Random(3)
    for _ in range(60):
        counts = [rng.choice([0, 0, 1, 5, 40]) for _ in range(rng.randrange(1, 9))]
        k = rng.randrange(1, 4)
        got = packing.best_bounds(counts, k)
        cells = [i + 1 for i, c in enumerate(counts) if c]
        if not cells:
            assert got == []
            continue
        cost = lambda bounds: sum(c * (min(b for b in bounds if b >= i + 1)) for i, c in enumerate(counts) if c)
        best = min(cost(set(x) | {cells[-1]}) for r in range(k) for x in itertools.combinations(range(1, cells[-1] + 1), r))
        assert len(got) <= k and cost(got) == best


def test_packing_is_whole_and_within_budget(edge, empty):
    out = packing.pack(edge, budget=512, max_len=100).toPandas()
    by_doc = sorted((w for w in (len(words(t)) for _, t, *_ in edge_rows()) if w))
    assert sum(out.n_tokens) == sum(by_doc)
    assert (out[out.n_tokens > 0].n_tokens <= out[out.n_tokens > 0].bucket_tokens).all()
    batches = out.dropna(subset=["bucket_tokens"]).groupby(["bucket_tokens", "batch"])
    assert all(len(b) * key[0] <= 512 or len(b) == 1 for key, b in batches)
    assert all(sorted(b.slot) == list(range(len(b))) for _, b in batches)
    assert out[out.n_tokens == 0].batch.isna().all()
    assert packing.pack(empty).count() == 0


def test_batches_hold_every_token_within_budget(edge, empty):
    from tokenizers import Tokenizer

    from quern.llm.best_fit import END
    from quern.llm.queries import WORD_BPE

    encode = Tokenizer.from_file(WORD_BPE).encode
    found, seen = [], set()
    for b in packing.batches(edge, WORD_BPE, budget=512, max_len=100, pad=7).collect():
        assert (b.bucket_tokens, b.batch) not in seen and (len(b.ids) * b.bucket_tokens <= 512 or len(b.ids) == 1)
        seen.add((b.bucket_tokens, b.batch))
        for doc, chunk, n, ids in zip(b.doc_id, b.chunk, b.n_tokens, b.ids, strict=True):
            row = np.frombuffer(ids, "<u4").tolist()
            assert len(row) == b.bucket_tokens and row[n:] == [7] * (len(row) - n)
            found.append((doc is None, doc or 0, chunk, row[:n]))
    wanted = []
    for doc, text, *_ in edge_rows():
        ids = [*encode(text or "", add_special_tokens=False).ids, END]
        wanted += [(doc is None, doc or 0, k, ids[at : at + 100]) for k, at in enumerate(range(0, len(ids), 100))]
    assert sorted(found) == sorted(wanted)
    assert packing.batches(empty, WORD_BPE).count() == 0


def test_toxicity_learns_and_restores(spark, edge, labels, no_labels, empty):
    rng = random.Random(4)
    vocabulary = ["river", "stone", "window", "garden", "summer", "little", "people", "water", "morning", "evening", "paper", "yellow"]
    rows, marks = [], []
    for i in range(900):
        w = [rng.choice(vocabulary) for _ in range(20)]
        toxic = i % 6 == 0
        if toxic:
            w[rng.randrange(20)] = "worthless" if i % 12 else "w0rthl3ss"
        rows.append((i, " ".join(w)))
        marks.append((i, 1, int(toxic)))
    docs, known = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = toxicity.score(docs, known).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r.predicted == (r.doc_id % 6 == 0) for r in held) >= 0.97 * len(held)
    out = toxicity.score(edge, labels)
    assert out.count() == len(edge_rows()) and out.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert toxicity.score(edge, no_labels).where("predicted = 1").count() == 0
    assert toxicity.score(empty, labels).count() == 0


def plain_levels(trusted):
    """Counts of n-grams by order, continuation counts below the highest."""
    pad = lambda x: chr(perplexity.START) * (perplexity.ORDER - 1) + x + chr(perplexity.END)
    k = perplexity.ORDER
    levels = {k: Counter(t[i - k + 1 : i + 1] for t in map(pad, trusted) for i in range(k - 1, len(t)))}
    for order in range(k - 1, 0, -1):
        levels[order] = Counter(g[1:] for g in levels[order + 1])
    return pad, levels


def plain_probability(levels):
    """P(last character | those before) of an n-gram, backing off one character at a time."""

    def cut(k, n):
        c = Counter(levels[k].values())
        y = c[1] / (c[1] + 2 * c[2]) if c[1] else 0.5
        j = min(n, 3)
        return min(max(j - (j + 1) * y * c[j + 1] / c[j], 0.1), j - 0.1) if c[j] and c[j + 1] else 0.5

    def p(g):
        if not g:
            return 1 / (len(levels[1]) + 1)
        own = {h: n for h, n in levels[len(g)].items() if h[:-1] == g[:-1]}
        if not own:
            return p(g[1:])
        total, n = sum(own.values()), own.get(g, 0)
        return (n - cut(len(g), n) if n else 0) / total + sum(cut(len(g), m) for m in own.values()) / total * p(g[1:])

    return p


@pytest.mark.parametrize("small", [False, True])
def test_perplexity_equals_plain_backing_off(spark, monkeypatch, small):
    if small:  # many slices and chunks, and no look-up tables
        monkeypatch.setattr(perplexity, "SLICE", 60)
        monkeypatch.setattr(perplexity, "LEAST_SLICE", 60)
        monkeypatch.setattr(perplexity, "CHUNK", 50)
        monkeypatch.setattr(perplexity, "CELLS", 10)
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcd ") for _ in range(rng.randrange(1, 90))) for _ in range(60)] + ["a 日本語 \U0001f600 a", "x", "\0ab\0", "a b, c\nd"]
    docs = spark.createDataFrame([(i, x, "en") for i, x in enumerate(texts)] + [(90, None, "en"), (91, "", "en"), (0, texts[0], "en"), (None, "ab", None)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(50)] + [(55, 0), (None, 1), (56, None)], "doc_id long, quality int")
    out = perplexity.judge(docs, labels, keep_text=False).collect()
    assert len(out) == len(texts) + 4 and all(r["__log_ppl"] is None and not r["__kept"] for r in out if r.doc_id in (90, 91))
    folds = {r.doc_id: r.held for r in docs.select("doc_id", (F.pmod(F.xxhash64("text"), F.lit(perplexity.HELD)) == 0).alias("held")).collect()}
    pad, levels = plain_levels([x.replace("\0", chr(perplexity.NUL)) for i, x in enumerate(texts) if i < 50 and not folds[i]] + ([] if folds[0] else [texts[0]]))
    p = plain_probability(levels)
    for r in out:
        if r.doc_id is not None and r.doc_id < 90:
            t = pad(texts[r.doc_id].replace("\0", chr(perplexity.NUL)))
            k = perplexity.ORDER
            expected = -sum(math.log(p(t[i - k + 1 : i + 1])) for i in range(k - 1, len(t))) / (len(t) - k + 1)
            assert abs(r["__log_ppl"] - expected) < 1e-6, r


def test_perplexity_frames(edge, labels, no_labels, empty):
    out = perplexity.judge(edge, labels)
    assert out.columns == [*edge.columns, "__n_chars", "__log_ppl", "__limit", "__kept"]
    assert pairs(out, *edge.columns) == pairs(edge, *edge.columns)
    again = perplexity.judge(out.where("doc_id > 5"), labels)
    assert again.columns == out.columns and again.where("__kept IS NULL").count() == 0
    assert perplexity.judge(edge, no_labels).where("NOT __kept AND text <> ''").count() == 0
    assert perplexity.judge(empty, labels).count() == 0


def test_site_lines(spark, empty):
    rows = [(i, "a", f"footer\nown line {i}\n\nshared {i % 30}") for i in range(60)] + [(100 + i, "b", "footer\nx") for i in range(5)] + [(200, None, None), (201, "a", ""), (300, "c", "footer"), (301, "c", "footer\nx")]
    docs = spark.createDataFrame([(*r, 1, 2, "x", 7) for r in rows], "doc_id long, source string, text string, host long, lines long, __lines string, __key int")
    out = {r.doc_id: r for r in site_lines.drop_boilerplate(docs).collect()}
    assert out[3].text == "own line 3\n\nshared 3" and (out[3]["__n_lines"], out[3]["__n_dropped"]) == (3, 1)
    assert out[100].text == ""  # on each of few pages
    assert out[300].text == "footer"  # on two pages only
    again = site_lines.drop_boilerplate(site_lines.drop_boilerplate(docs)).columns
    assert again == [*docs.columns, "__n_lines", "__n_dropped"]
    assert out[200].text is None and out[201].text == ""
    assert set(docs.columns) < set(site_lines.drop_boilerplate(docs).columns)
    assert site_lines.drop_boilerplate(empty).count() == 0


def test_media_round_trip(edge, empty):
    for r in audio.media(edge).collect():
        payload = audio.from_wav(bytes(r.media))
        assert len(payload) % 64 == 0 and len(payload) > 0 and len(r.times) == len(r.codes)
    got = {r.doc_id: r for r in audio.digests(edge).collect() if r.doc_id in (5, 12)}
    assert got[5].payload_bytes == 64 and got[5].tail_crc32 == zlib.crc32(bytes(64))
    assert got[12].n_bytes == 20_000 and got[12].payload_sha256 == hashlib.sha256(b"x" * 20_000 + bytes(20_032 - 20_000)).hexdigest()
    assert audio.digests(empty).count() == 0


def test_peaks_do_not_depend_on_blocks(monkeypatch):
    raw = random.Random(6).randbytes(20_000)
    whole = audio.fingerprint(raw)
    monkeypatch.setattr(audio, "BLOCK", 7)
    for a, b in zip(whole, audio.fingerprint(raw), strict=True):
        assert (a == b).all()


def plain_strip(rows):
    seen, out = {}, {}
    for i, text in sorted(rows):
        w = words(text)
        gone = [False] * len(w)
        for s in range(len(w) - 19):
            k = tuple(w[s : s + 20])
            if seen.setdefault(k, (i, s)) != (i, s):
                gone[s : s + 20] = [True] * 20
        kept = [x for x, g in zip(w, gone, strict=True) if not g]
        out[i] = (i, len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


@pytest.mark.parametrize("hot", [False, True])
def test_substrings_equal_the_plain_version(spark, edge, empty, monkeypatch, hot):
    if hot:  # every anchor of a batch is common, so all are dealt window by window
        monkeypatch.setattr(substring, "HOT", 1)
        monkeypatch.setattr(substring, "SEEN", 1)
        monkeypatch.setattr(substring, "SEEN_SHARE", 0)
    rng = random.Random(21)
    rows = [(r[0], r[1]) for r in edge_rows() if r[0] is not None]
    passage = [f"p{rng.randrange(50)}" for _ in range(90)]
    for k in range(60):  # cuts of one passage among other words, some of them twice in a text, and copies of whole texts
        cut = rng.randrange(60)
        own = [f"q{rng.randrange(30)}" for _ in range(rng.randrange(40))] + passage[cut : cut + rng.randrange(15, 60)] * rng.choice([1, 1, 2])
        rows += [(2000 + k, " ".join(own + ["r", "s"] * rng.choice([0, 3, 30])))] + ([(3000 - k, " ".join(own))] if k % 3 == 0 else [])
    expected = plain_strip(dict(rows).items())
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = substring.strip(docs).collect()
    assert len(got) == len(rows) and [tuple(r) for r in got if tuple(r) != expected[r.doc_id]] == []
    assert sum(r.n_removed > 0 for r in got) > 50
    assert substring.strip(edge).count() == len(edge_rows())
    assert substring.strip(empty).count() == 0


def test_batches_agree_on_segments(monkeypatch):
    rng = np.random.default_rng(5)
    h = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    alone = substring.segments(h, np.array([400]), 20, 6)
    other = np.concatenate([rng.integers(0, 1 << 63, 150, dtype=np.uint64), h, h[:30]])
    among = substring.segments(other, np.array([150, 0, 400, 30]), 20, 6)
    own = among[2] == 2
    assert [x.tolist() for x in (alone[0], alone[1], alone[3], alone[4])] == [among[i][own].tolist() for i in (0, 1, 3, 4)]
    assert sum(alone[4]) == 381 and sum(among[4][among[2] == 0]) == 131 and sum(among[4][among[2] == 3]) == 11
    values = rng.integers(0, 4, 300, dtype=np.uint64) << np.uint64(30)
    for width in (1, 2, 7, 15, 16):
        assert substring.leftmost_least(values, width).tolist() == [i + int(np.argmin(values[i : i + width])) for i in range(300 - width + 1)]


def test_fm_index_against_plain_search():
    rng = np.random.default_rng(1)
    for n, most in ((30, 3), (200, 3), (200, 6)):
        text = rng.integers(1, 5, n)
        index = fm_index.FMIndex(text)
        order = sorted(range(n + 1), key=lambda i: text[i:].tolist())
        assert index.locate(np.arange(n + 1)).tolist() == order
        stream = np.concatenate([text[5:20], rng.integers(1, 5, 40)])
        ends = np.arange(most - 1, len(stream))
        for times in (1, 2):
            length, low, high = index.matching(stream, ends, most, np.full(len(ends), times))
            for e, got, a, b in zip(ends.tolist(), length.tolist(), low.tolist(), high.tolist(), strict=True):
                places = lambda k: [s for s in range(n - k + 1) if text[s : s + k].tolist() == stream[e - k + 1 : e + 1].tolist()]  # noqa: B023, E731
                assert got == max(k for k in range(most + 1) if k == 0 or len(places(k)) >= times)
                if got == most:
                    assert sorted(index.locate(np.arange(a, b)).tolist()) == places(most)
                    assert index.earliest(np.array([a]), np.array([b])).tolist() == places(most)[:1]


def test_bpe_equals_the_library():
    import base64

    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(8)
    for leaf in (2, 16):
        own = bpe.Encoder(RANKS, leaf=leaf)
        for _ in range(400):
            text = "".join(rng.choice(rng.choice(["ab", "etaoin shrdlu", "éèñçß", "  \n\t", "0123456789", "#*$%", "日本語", "aaaa"])) for _ in range(rng.choice([0, 3, 40, 400])))
            ids = np.frombuffer(own.encode(text), "<u4")
            assert ids.tolist() == reference.encode_ordinary(text) and own.decode(ids) == text.encode()


def test_bpe_frames(edge, empty):
    assert all(r.n_tokens == 0 for r in bpe.digests(edge, RANKS).collect() if r.doc_id in (4, 5))
    assert bpe.encode(edge, RANKS).count() == len(edge_rows()) and bpe.digests(empty, RANKS).count() == 0


def plain_groups(rows, k, num, den):
    sets = {}
    for i, text in rows:
        w = [x.lower() for x in words(text)]
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (i, len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize(("k", "num", "den", "busy"), [(3, 90, 100, False), (5, 80, 100, True)])
def test_parity_join_equals_all_pairs(spark, edge, empty, k, num, den, busy, monkeypatch):
    monkeypatch.setattr(parity_join, "HOT_SHARE", 0.0001)
    if busy:  # every key goes the way of busy ones, large ones are compared in squares, and no text is broadcast
        for name, value in {"BUSY": 1, "SEEN": 1, "SEEN_SHARE": 0, "FEW": 3, "SQUARE": 5, "BROADCAST_ROWS": 0}.items():
            monkeypatch.setattr(parity_join, name, value)
    rng = random.Random(k)
    rows = [(r[0], r[1]) for r in edge_rows() if r[0] is not None]
    for g in range(6):
        base = [f"g{g}w{rng.randrange(300)}" for _ in range(rng.choice([12, 60, 200]))]
        for j in range(25):
            w = list(base)
            for _ in range(rng.randrange(0, 1 + len(w) // 15)):
                w[rng.randrange(len(w))] = f"z{rng.randrange(99)}"
            rows.append((1000 + 100 * g + j, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = plain_groups(dict(rows).items(), k, num, den)
    got = parity_join.group(docs, k, num, den).collect()
    assert len(got) == len(rows) and all(tuple(r) == expected[r.doc_id] for r in got)
    assert parity_join.group(edge, k, num, den).count() == len(edge_rows())
    assert parity_join.group(empty, k, num, den).count() == 0


def test_linked_sets_share_a_key():
    rng = np.random.default_rng(3)
    for num, den in ((90, 100), (80, 100)):
        for n in (1, 2, 5, 9, 17, 40, 130, 500):
            for _ in range(30):
                a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
                d = parity_join.apart(len(a), num, den)
                cut = int(rng.integers(0, d + 1))
                b = np.union1d(a[cut:], rng.integers(0, 1 << 63, int(rng.integers(0, d - cut + 1)), dtype=np.uint64))
                hot = np.sort(rng.choice(a, int(rng.integers(0, len(a) + 1)), replace=False))
                both = len(np.intersect1d(a, b))
                if den * both >= num * (len(a) + len(b) - both):
                    assert set(parity_join.keys_of(a, hot, num, den)) & set(parity_join.keys_of(b, hot, num, den))
