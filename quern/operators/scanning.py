"""The duplicate scan: candidates with each other and with references, counted by groups and never listed pair by pair."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.hashing import combined_hash, exact_hash
from quern.operators.duplicates import duplicate_gate
from quern.sources.tables import durable

#: What makes a pair a duplicate for sure: equal words, equal words and schemas after normalization, one source example.
KEYS = ("exact", "combined", "source")
#: Who a record may be compared with: candidates, references, and those of each that have a vector.
SIDES = {"c": "NOT reference", "r": "reference", "cv": "NOT reference AND cls IS NOT NULL", "rv": "reference AND cls IS NOT NULL"}

#: Classes that are sent to every task at most, and numbers that keys are reduced to before links are matched. They change no result.
SENT, CELLS = 200_000, 1 << 14


def signatures(records: DataFrame, references: DataFrame, members: DataFrame | None = None, reference_members: DataFrame | None = None) -> DataFrame:
    """(id, reference, exact, combined, source, cls) of both sides' records (id, query, fingerprints, dataset, example).

    Members (id, cls) name the classes of equal vectors of a side's records; a record without one has no score. An id
    that stands on both sides, or twice on one, is a record for each time.
    """
    q = F.coalesce("query", F.lit(""))
    source = F.when(F.col("dataset").isNotNull() & F.col("example").isNotNull(), F.sha2(F.to_json(F.struct("dataset", "example")), 256))

    def side(own: DataFrame, known: DataFrame | None, reference: bool) -> DataFrame:
        keyed = own.select("id", F.lit(reference).alias("reference"), exact_hash(q).alias("exact"), combined_hash(q, F.col("fingerprints")).alias("combined"), source.alias("source"))
        kind = next((m.schema["cls"].dataType for m in (members, reference_members) if m is not None), "string")
        return keyed.join(known.select("id", "cls"), "id", "left") if known is not None else keyed.withColumn("cls", F.lit(None).cast(kind))

    return durable(side(records, members, False).unionByName(side(references, reference_members, True)), "signatures")


def partners(rows: DataFrame, beside: tuple[str, ...] = ()) -> DataFrame:
    """rows with the number of records on each side that share a key, itself included: sure_c, sure_r, sure_cv, sure_rv.

    Those that share one of three keys are counted by inclusion and exclusion over the groups of one, two and three
    keys, so a group of copies costs one row a key. Groups of one record are left out: it counts itself. With beside,
    only those count that share these columns as well.
    """
    out, alone = rows, {}
    for n in (1, 2, 3):
        for keys in combinations(KEYS, n):
            own = [*beside, *keys]
            name = "_".join(keys)
            some = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in own))
            sums = rows.where(some).groupBy(*own).agg(*(F.count_if(F.expr(side)).alias(f"{name}_{s}") for s, side in SIDES.items()), F.count("*").alias("__n"))
            out = out.join(durable(sums.where("__n > 1").drop("__n"), f"sharing-{name}"), own, "left")
            alone |= {f"{name}_{s}": F.when(some & F.expr(side), 1).otherwise(0) for s, side in SIDES.items()}
    total = lambda s: reduce(lambda a, b: a + b, (F.coalesce(F.col(c := "_".join(keys) + f"_{s}"), alone[c]) * (-1) ** (n - 1) for n in (1, 2, 3) for keys in combinations(KEYS, n)))
    return out.select(*rows.columns, *(total(s).alias(f"sure_{s}") for s in SIDES))


def scan(rows: DataFrame, links: DataFrame | None = None, production: bool = False) -> tuple[DataFrame, DataFrame]:
    """(state, counters) of a scan of signatures(), with links (a, b) between the classes of vectors whose score is high enough.

    state has for each candidate duplicate, comparisons_required (pairs that are no sure duplicates),
    comparisons_evaluated (those with a score on both sides) and the status of its gate. A candidate is a duplicate if it
    has a sure one, shares its class with another or its class has a link. counters has one row: pairs_checked,
    semantic_comparisons and findings_retained, the pairs that are duplicates for sure or by score. Pairs of two
    references are no pairs. Nulls on either side share nothing; an empty query is a query.
    """
    edges = durable(_edges(rows, links), "score-links")
    return state(rows, edges, production), counters(rows, edges)


def _edges(rows: DataFrame, links: DataFrame | None) -> DataFrame:
    return links.select("a", "b") if links is not None else rows.select(F.col("cls").alias("a"), F.col("cls").alias("b")).where("false")


def _counted(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, dict[str, int]]:
    """rows with keys of 16 bytes, the same with their partners, the classes of their vectors, and how many are on each side."""
    rows = durable(rows.withColumns({k: F.unhex(F.substring(F.sha2(k, 256), 1, 32)) for k in KEYS}), "keys")
    totals = rows.agg(*(F.count_if(F.expr(side)).alias(s) for s, side in SIDES.items())).first().asDict()
    classes = durable(rows.where("cls IS NOT NULL").groupBy("cls").agg(*(F.count_if(F.expr(SIDES[s])).alias(f"all_{s}") for s in "cr")), "score-classes")
    return rows, durable(partners(rows), "sure"), classes, totals


def state(rows: DataFrame, links: DataFrame | None = None, production: bool = False) -> DataFrame:
    """The first result of scan() by itself: of the links only their ends are kept."""
    rows, sure, classes, n = _counted(rows)
    required = F.lit(n["c"] + n["r"]) - F.col("sure_c") - F.col("sure_r")
    evaluated = F.when(F.col("cls").isNotNull(), F.lit(n["cv"] + n["rv"]) - F.col("sure_cv") - F.col("sure_rv")).otherwise(0)
    ends = durable(_edges(rows, links).select(F.explode(F.array("a", "b")).alias("cls")).distinct(), "score-ends").withColumn("linked", F.lit(True))
    candidates = sure.where("NOT reference").join(classes, "cls", "left").join(ends, "cls", "left")
    alike = F.coalesce(F.col("all_c") + F.col("all_r") > 1, F.lit(False)) | F.coalesce("linked", F.lit(False))
    found = (F.col("sure_c") + F.col("sure_r") > 1) | alike
    out = candidates.select("id", found.alias("duplicate"), required.alias("comparisons_required"), evaluated.alias("comparisons_evaluated"))
    return out.withColumn("status", duplicate_gate(F.col("duplicate"), F.lit(n["c"] + n["r"] - 1), F.when(F.col("comparisons_evaluated") == F.col("comparisons_required"), n["c"] + n["r"] - 1).otherwise(-1), production))


def counters(rows: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """The second result of scan() by itself."""
    rows, sure, classes, n = _counted(rows)
    edges = durable(_edges(rows, links), "score-edges")
    scored = F.col("cls").isNotNull()
    # Pairs, from what each candidate has: those with a candidate from both ends, so half of them.
    pairs = lambda c, r: F.coalesce(F.sum(c - 1) / 2 + F.sum(r), F.lit(0)).cast("long")
    certain = sure.where("NOT reference").agg(pairs(F.col("sure_c"), F.col("sure_r")).alias("sure"))
    compared = sure.where("NOT reference AND cls IS NOT NULL").agg(pairs(n["cv"] - F.col("sure_cv") + 1, n["rv"] - F.col("sure_rv")).alias("semantic"))
    within = classes.agg(F.coalesce(F.sum(F.col("all_c") * (F.col("all_c") - 1) / 2 + F.col("all_c") * F.col("all_r")), F.lit(0)).cast("long").alias("within"))
    within_sure = partners(rows.where(scored), ("cls",)).where("NOT reference").agg(pairs(F.col("sure_c"), F.col("sure_r")).alias("within_sure"))
    across = crossing(edges, classes.withColumnsRenamed({"all_c": "c", "all_r": "r"}), [])
    near = sharing(edges, rows.where(scored))
    across_sure = [(crossing(near, rows.where(scored).groupBy("cls", *keys).agg(F.count_if(~F.col("reference")).alias("c"), F.count_if("reference").alias("r")), list(keys)), (-1) ** (k - 1)) for k in (1, 2, 3) for keys in combinations(KEYS, k)]
    shared = reduce(lambda x, y: x + y, (total * sign for total, sign in across_sure))
    one = certain.join(compared).join(within).join(within_sure)  # a row each
    checked = n["c"] * (n["c"] - 1) // 2 + n["c"] * n["r"]
    return one.select(F.lit(checked).cast("long").alias("pairs_checked"), F.col("semantic").alias("semantic_comparisons"), (F.col("sure") + F.col("within") - F.col("within_sure") + F.lit(across - shared)).cast("long").alias("findings_retained"))


def _near(table: DataFrame) -> DataFrame:
    """table as a side of a join: broadcast if it has at most SENT rows."""
    return F.broadcast(table) if table.limit(SENT + 1).count() <= SENT else table


def sharing(edges: DataFrame, rows: DataFrame) -> DataFrame:
    """The edges whose classes may share a key: their keys, as numbers below CELLS, do. All that share one are kept."""
    cells = F.array_compact(F.array(*(F.when(F.col(k).isNotNull(), F.pmod(F.xxhash64(F.lit(k), k), F.lit(CELLS)).cast("int")) for k in KEYS)))
    sets = durable(rows.select("cls", F.explode(cells).alias("x")).groupBy("cls").agg(F.collect_set("x").alias("x")), "key-cells")
    own = _near(sets)
    met = edges.join(own.select(F.col("cls").alias("a"), F.col("x").alias("x_a")), "a").join(own.select(F.col("cls").alias("b"), F.col("x").alias("x_b")), "b")
    return durable(met.where(F.arrays_overlap("x_a", "x_b")).select("a", "b"), "sharing-links")


def crossing(edges: DataFrame, sizes: DataFrame, keys: list[str]) -> int:
    """How many pairs with a candidate lie across the edges, sizes (cls, keys, c, r) being those of the classes; with keys only pairs that share them."""
    some = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys), F.lit(True))
    sizes = _near(durable(sizes.where(some), "crossing"))
    x = sizes.select(F.col("cls").alias("a"), F.col("c").alias("c_a"), F.col("r").alias("r_a"), *keys)
    y = sizes.select(F.col("cls").alias("b"), F.col("c").alias("c_b"), F.col("r").alias("r_b"), *keys)
    met = edges.join(x, "a").join(y, ["b", *keys])
    return met.agg(F.coalesce(F.sum(F.col("c_a") * F.col("c_b") + F.col("c_a") * F.col("r_b") + F.col("r_a") * F.col("c_b")), F.lit(0)).alias("n")).first()["n"]


def decided(score: Column, threshold: float) -> Column:
    """The decision on a pair that is no sure duplicate."""
    return F.when(score >= threshold, "possible_duplicate").otherwise("distinct")
