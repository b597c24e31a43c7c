"""Quality rules whose cutoffs carry a guarantee: labelled holdouts and exact binomial bounds, all in DataFrame functions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import durable, join_small, words

#: Share of good documents that all rules together may reject in a stratum, and the chance that this fails anywhere.
ALPHA, DELTA = 0.02, 0.05
#: Cutoffs in the order in which they are tested, the most lenient first; fixed, so that every labelled row is holdout.
LADDER = tuple(round(1 - 0.05 * i, 2) for i in range(1, 20)) + (0.03, 0.02, 0.01)
#: Up to so many repeated windows are looked up one by one; the result is the same either way.
FEW = 64
RULES = ("symbol_ratio", "dup_line_ratio", "repeat_ratio", "shout_ratio")


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """Per row of docs: counts, rule values and base_failed. A null text counts as empty, and fails."""
    col = F.col
    text = F.coalesce(col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = docs.select(col(id_col).alias("doc_id"), col(stratum_col).alias("stratum"), words(text).alias("w"), lines.alias("lines"), F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"), F.regexp_count(text, F.lit(r"[!?]{2,}")).cast("long").alias("n_shouts"))
    triples = lambda w, n: F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    out = out.select("doc_id", "stratum", "w", "n_symbols", "n_shouts", F.size("w").alias("n"), F.length(F.array_join("w", "")).cast("long").alias("word_chars"), F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"))
    out = out.withColumn("hashes", F.when(col("n") >= 3, triples(col("w"), col("n"))))
    # Only texts in which a window repeats go on; where few windows do, a look-up finds their places, else a sort does.
    some = F.size(F.array_distinct("hashes")) < F.size("hashes")
    out = out.drop("w").withColumn("in_order", F.when(some, F.sort_array("hashes")))
    v = col("in_order")
    out = out.withColumn("twice", F.array_distinct(F.transform(F.filter(F.sequence(F.lit(1), F.size(v) - 1), lambda k: F.get(v, k) == F.get(v, k - 1)), lambda k: F.get(v, k)))).drop("in_order")
    few, many = col("twice").isNotNull() & (F.size("twice") <= FEW), col("twice").isNotNull() & (F.size("twice") > FEW)
    out = out.withColumn("sorted", F.when(many, F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    p = col("sorted")
    same = lambda k, j: F.coalesce(F.get(p, k)["h"] == F.get(p, j)["h"], F.lit(False))
    looked_up = F.filter(F.sequence(F.lit(0), F.size("hashes") - 1), lambda i: F.array_contains("twice", F.get("hashes", i)))
    by_sort = F.sort_array(F.transform(F.filter(F.sequence(F.lit(0), F.size(p) - 1), lambda k: same(k, k + 1) | same(k, k - 1)), lambda k: F.get(p, k)["i"]))
    out = out.withColumn("starts", F.when(many, by_sort).when(few, looked_up)).drop("sorted", "hashes", "twice")
    s = col("starts")
    covered = F.aggregate(F.sequence(F.lit(0), F.size(s) - 1), F.lit(0).cast("long"), lambda a, k: a + F.coalesce(F.least(F.get(s, k + 1) - F.get(s, k), F.lit(3)), F.lit(3)))
    out = out.withColumn("n_words", col("n").cast("long")).withColumn("n_repeat_words", F.when(s.isNotNull(), covered).otherwise(F.lit(0).cast("long")))
    share = lambda a, b: F.when(col(b) > 0, col(a) / col(b)).otherwise(0.0)
    failed = (col("n_words") < 50) | (100 * col("n_repeat_words") > 50 * col("n_words"))
    rules = [share(a, b).alias(r) for r, (a, b) in zip(RULES, (("n_symbols", "word_chars"), ("n_dup_lines", "n_lines"), ("n_repeat_words", "n_words"), ("n_shouts", "n_words")), strict=True)]
    return out.select("doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), *rules)


def at_most(n: Column, k: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k), summed term by term in logarithms."""
    first = n * math.log1p(-p)
    odds = math.log(p) - math.log1p(-p)
    term = lambda acc, i: acc["lp"] + F.log((n - i + 1) / i) + odds
    total = F.aggregate(F.sequence(F.lit(1).cast("long"), k), F.struct(first.alias("lp"), F.exp(first).alias("cdf")), lambda acc, i: F.struct(term(acc, i).alias("lp"), (acc["cdf"] + F.exp(term(acc, i))).alias("cdf")), lambda acc: acc["cdf"])
    return F.when(k == 0, F.exp(first)).otherwise(total)


def cutoffs(scored: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row a stratum with the chosen cutoff of each rule (null: none is certified).

    A cutoff passes if the exact upper bound on the share of good documents above it is at most alpha / rules, at
    confidence 1 - delta / (strata * rules) (Bonferroni); within a stratum and rule the ladder is tested in its
    fixed order up to the first failure, which costs no further correction. All passing cutoffs hold at once; the
    one with the best gain (share of bad documents less share of good ones above it) is taken, the more lenient
    one where gains tie. Rows without a label, and labels without a row, don't count; of repeated labels the
    lowest holds.
    """
    known = labels.where("quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("good"))
    ladder = F.array(*map(F.lit, LADDER))
    below = lambda rule: F.size(F.filter(ladder, lambda cut: F.col(rule) > cut))
    steps = F.array(*(F.struct(F.lit(r).alias("rule"), below(r).alias("above")) for r in RULES))
    seen = scored.where("NOT base_failed").join(known, "doc_id").select("stratum", "good", F.explode(steps).alias("s")).groupBy("stratum", "s.rule", "s.above")
    hist = seen.agg(F.count_if(F.col("good") == 1).alias("good"), F.count_if(F.col("good") == 0).alias("bad"))
    # Of the ladder's 22 steps a value passes the last `above` ones, as cutoffs fall.
    steps = hist.groupBy("stratum", "rule").agg(F.sum("good").alias("n_good"), F.sum("bad").alias("n_bad"), F.collect_list(F.struct("above", "good", "bad")).alias("h"))
    over = lambda which: F.aggregate("h", F.lit(0).cast("long"), lambda a, x: a + F.when(x["above"] >= F.lit(len(LADDER)) - F.col("step"), x[which]).otherwise(0))
    tested = steps.select("stratum", "rule", "n_good", "n_bad", "h", F.posexplode(ladder).alias("step", "cut")).withColumns({"k_good": over("good"), "k_bad": over("bad")}).drop("h")
    level, strata = alpha / len(RULES), tested.select(F.count_distinct(F.coalesce(F.col("stratum").cast("string"), F.lit("\0"))).alias("strata"))
    tested = tested.crossJoin(F.broadcast(strata))  # one row
    fits = F.when((F.col("n_good") == 0) | (F.col("k_good") > F.col("n_good") * level), False).otherwise(at_most(F.col("n_good"), F.col("k_good"), level) <= delta / (F.col("strata") * len(RULES)))
    lenient = Window.partitionBy("stratum", "rule").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    gain = F.when(F.col("n_bad") > 0, F.col("k_bad") / F.col("n_bad")).otherwise(0.0) - F.col("k_good") / F.col("n_good")
    passed = tested.withColumn("ok", fits).withColumn("ok", F.bool_and("ok").over(lenient)).where("ok").withColumn("gain", gain).where("gain > 0")
    best = passed.withColumn("place", F.row_number().over(Window.partitionBy("stratum", "rule").orderBy(F.desc("gain"), "step"))).where("place = 1")
    return best.groupBy("stratum").agg(*(F.max(F.when(F.col("rule") == r, F.col("cut"))).alias(f"cut_{r}") for r in RULES))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """Per row of docs its counts, base_failed, the rule values, and kept.

    kept is false if base_failed, or if a rule's value exceeds its stratum's certified cutoff. A null text counts
    as empty; null strata are a stratum; repeated rows are judged each; a value that equals a cutoff passes; an empty
    labels table certifies nothing, and an empty table gives no rows. Other columns are ignored, whatever their names.
    """
    scored = durable(features(docs, id_col, text_col, stratum_col), "rules")
    chosen = durable(cutoffs(scored, labels, alpha, delta), "cutoffs")
    out = join_small(scored, chosen, "stratum")
    hit = [F.coalesce(F.col(r) > F.col(f"cut_{r}"), F.lit(False)) for r in RULES]
    kept = ~F.col("base_failed")
    for h in hit:
        kept = kept & ~h
    return out.withColumn("kept", kept)


ORACLE = f"""
WITH w AS (
  SELECT doc_id, lang, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls
  FROM documents),
tri AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM tri QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
cov AS (SELECT doc_id, CAST(count(DISTINCT i + j) AS BIGINT) AS n FROM rep, (SELECT unnest([0, 1, 2]) AS j) GROUP BY doc_id),
f AS (
  SELECT w.doc_id, lang, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    coalesce(cov.n, 0) AS n_repeat_words, len(ls) AS n_lines, len(regexp_extract_all(t, '[!?]{{2,}}')) AS n_shouts
  FROM w LEFT JOIN cov ON w.doc_id = cov.doc_id),
r AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    CASE WHEN word_chars > 0 THEN n_symbols / word_chars ELSE 0 END AS symbol_ratio,
    CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_ratio,
    CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END AS repeat_ratio,
    CASE WHEN n_words > 0 THEN n_shouts / n_words ELSE 0 END AS shout_ratio FROM f),
u AS (UNPIVOT (SELECT doc_id, lang, base_failed, symbol_ratio, dup_line_ratio, repeat_ratio, shout_ratio FROM r) ON symbol_ratio, dup_line_ratio, repeat_ratio, shout_ratio INTO NAME rule VALUE v),
lab AS (SELECT doc_id, min(quality) AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
ladder AS (SELECT unnest({list(LADDER)}::DOUBLE[]) AS cut, unnest(range({len(LADDER)})) AS step),
tested AS (
  SELECT lang, rule, step, cut, CAST(count_if(good = 1) AS BIGINT) AS n_good, CAST(count_if(good = 0) AS BIGINT) AS n_bad, CAST(count_if(good = 1 AND v > cut) AS BIGINT) AS k_good, CAST(count_if(good = 0 AND v > cut) AS BIGINT) AS k_bad,
    (SELECT count(DISTINCT coalesce(lang, '')) FROM u JOIN lab USING (doc_id) WHERE NOT base_failed) AS strata
  FROM u JOIN lab USING (doc_id), ladder WHERE NOT base_failed GROUP BY ALL),
fits AS (
  SELECT *, n_good > 0 AND k_good <= n_good * {ALPHA / len(RULES)} AND list_sum(list_transform(range(0, k_good + 1), lambda i: exp(lgamma(n_good + 1) - lgamma(i + 1) - lgamma(n_good - i + 1) + i * ln({ALPHA / len(RULES)}) + (n_good - i) * ln(1 - {ALPHA / len(RULES)})))) <= {DELTA} / (strata * {len(RULES)}) AS ok,
    CASE WHEN n_bad > 0 THEN k_bad / n_bad ELSE 0 END - k_good / n_good AS gain FROM tested),
passed AS (SELECT *, bool_and(ok) OVER (PARTITION BY lang, rule ORDER BY step ROWS UNBOUNDED PRECEDING) AS ok2 FROM fits),
best AS (SELECT lang, rule, cut FROM passed WHERE ok2 AND gain > 0 QUALIFY row_number() OVER (PARTITION BY lang, rule ORDER BY gain DESC, step) = 1)
SELECT r.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT EXISTS (SELECT 1 FROM u JOIN best ON u.lang IS NOT DISTINCT FROM best.lang AND u.rule = best.rule WHERE u.doc_id = r.doc_id AND v > cut) AS kept
FROM r
"""
