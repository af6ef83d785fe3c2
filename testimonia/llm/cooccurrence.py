"""Items that appear together, and how surprising each pair is.

Counts are exact. The null model is the maximum-entropy bipartite configuration model: item i is in record t with
probability x_i y_t / (1 + x_i y_t), fitted so that item frequencies and record sizes hold on average. Items of one
frequency share x and records of one size share y, so the fit runs on tables of degrees, not of items. A pair's count
is then a sum of independent trials with few distinct probabilities: its upper tail is a Poisson-binomial one, computed
exactly from those classes. The Benjamini-Hochberg rule over all possible pairs gives q values.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from testimonia.sources.shared import written
from testimonia.sources.tables import table

#: Pairs of a record are taken block by block: no row is asked for more than BLOCK * BLOCK pairs.
BLOCK = 64
MIN_COUNT, MIN_LIFT = 4, 5
#: Degree tables larger than this would be no tables of degrees; they have one row per distinct count.
MAX_DEGREES = 200_000
#: Distinct tails up to this number are broadcast, their number being counted first; more are shuffled.
SENT_TAILS = 60_000


def item_name(c):
    """Lower case, trimmed, blanks collapsed."""
    return F.trim(F.regexp_replace(F.lower(c), r"(?U)\s+", " "))


def memberships(spark: SparkSession, directory: str) -> DataFrame:
    """Distinct (record, item) of persons, organisations and names in claims."""
    m = table(spark, directory, "mentions").select("chunk_id", F.explode(F.concat(F.coalesce("person", F.array().cast("array<string>")), F.coalesce("org", F.array().cast("array<string>")))).alias("n"))
    c = table(spark, directory, "claims").select("chunk_id", F.explode(F.col("mentions.name")).alias("n"))
    both = m.unionByName(c).select(F.col("chunk_id").alias("record"), item_name(F.col("n")).alias("item"))
    return both.where("item <> '' and record is not null").distinct()


def pair_counts(members: DataFrame, min_count: int = 1, min_lift: float = 0.0) -> DataFrame:
    """item_a < item_b with n_a, n_b, n_ab and n_records, for pairs with n_ab >= min_count and n_ab * N >= min_lift * n_a * n_b.

    ``members``: record, item; distinct rows, other columns are not read, rows with a null are dropped beforehand. Bounds
    that follow from the two limits drop items before any pair is made: an item in fewer than min_count records, or in
    more than N / min_lift of them, is in no such pair. A record's pairs are made in blocks of its items.
    """
    members = members.select("record", "item")
    degrees = members.groupBy("item").agg(F.count("*").alias("n_item"))
    n_records = members.select("record").distinct().agg(F.count("*").alias("n_records"))
    kept = degrees.where(F.col("n_item") >= min_count).crossJoin(F.broadcast(n_records))  # one row
    kept = kept.where(F.col("n_item") * F.lit(float(min_lift)) <= F.col("n_records")).select("item", "n_item", "n_records")
    coded = kept.select("item", "n_item", "n_records")
    m = members.join(coded, "item").select("record", "item", "n_item", "n_records")
    # an item's block in its record comes from its hash and the record's size: no record is ever in one task
    size = m.groupBy("record").agg(F.ceil(F.count("*") / BLOCK).alias("_n"))
    m = m.join(size, "record").withColumn("_b", F.pmod(F.xxhash64("item"), "_n"))
    blocks = m.groupBy("record", "_b").agg(F.collect_list(F.struct("item", "n_item")).alias("items"), F.first("_n").alias("_n"), F.first("n_records").alias("n_records"))
    left = blocks.select("record", F.col("items").alias("l"), F.col("_b").alias("i"), "n_records", F.explode(F.sequence(F.col("_b"), F.col("_n") - 1)).alias("j"))
    inside = left.where("i = j").select("l", F.col("l").alias("r"), "n_records", F.lit(True).alias("same"))
    across = left.where("i <> j").join(blocks.select("record", F.col("_b").alias("j"), F.col("items").alias("r")), ["record", "j"]).select("l", "r", "n_records", F.lit(False).alias("same"))
    pairs = inside.unionByName(across).select("n_records", "same", F.explode("l").alias("x"), "r").select("n_records", "x", F.explode(F.expr("filter(r, y -> y.item > x.item or (not same and y.item < x.item))")).alias("y"))
    pairs = pairs.select("n_records", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    out = pairs.groupBy(F.col("a.item").alias("item_a"), F.col("b.item").alias("item_b")).agg(F.first("a.n_item").alias("n_a"), F.first("b.n_item").alias("n_b"), F.count("*").alias("n_ab"), F.first("n_records").alias("n_records"))
    return out.where((F.col("n_ab") >= min_count) & (F.col("n_ab") * F.col("n_records") >= F.lit(float(min_lift)) * F.col("n_a") * F.col("n_b")))


def _expected(a: np.ndarray, b: np.ndarray, weight: np.ndarray, cells: int = 4_000_000) -> np.ndarray:
    """For each a the sum of weight * b / (1 + a b) over all b, a block of rows at a time, so that the memory is bounded."""
    step = max(1, cells // max(1, len(b)))
    return np.concatenate([((weight * b)[None, :] / (1 + np.outer(a[i : i + step], b))).sum(1) for i in range(0, len(a), step)]) if len(a) else a


def fit_null(item_deg: np.ndarray, item_mult: np.ndarray, rec_deg: np.ndarray, rec_mult: np.ndarray, rounds: int = 2000, tol: float = 1e-9):
    """x per item degree and y per record degree of the bipartite configuration model, by fixed-point rounds."""
    total = max(1.0, float((item_deg * item_mult).sum()))
    x, y = item_deg / math.sqrt(total), rec_deg / math.sqrt(total)
    for _ in range(rounds):
        nx = item_deg / _expected(x, y, rec_mult)
        ny = rec_deg / _expected(y, nx, item_mult)
        moved = max(np.abs(nx / x - 1).max(initial=0), np.abs(ny / y - 1).max(initial=0))
        x, y = nx, ny
        if moved < tol:
            break
    return x, y


def log10_tail(k: int, probs: np.ndarray, mult: np.ndarray) -> float:
    """log10 P(X >= k) of a sum of ``mult`` trials at each of ``probs``; terms are followed until they vanish.

    Computed from the product of binomial generating functions, all terms positive, scaled by the term at k.
    """
    mean = float((probs * mult).sum())
    if k <= 0:
        return 0.0
    size = int(k + 40 + 4 * math.sqrt(k) + 2 * mean)
    pmf = np.zeros(size + 1)
    pmf[0] = 1.0
    log_scale = 0.0
    for p, m in zip(probs, mult):
        if p <= 0:
            continue
        p = min(p, 1 - 1e-15)
        top = int(min(m, size))
        j = np.arange(top + 1)
        steps = np.log(np.maximum(m - j[:-1], 1e-300)) - np.log(j[1:]) + math.log(p) - math.log1p(-p)
        logs = np.concatenate([[0.0], np.cumsum(steps)]) + m * math.log1p(-p)
        peak = logs.max()
        pmf = np.convolve(pmf, np.exp(logs - peak))[: size + 1]
        log_scale += peak
        s = pmf.max()
        pmf /= s
        log_scale += math.log(s)
    tail = pmf[k:].sum() if k <= size else 0.0
    if tail <= 0:
        return -300.0 * 1.0
    return min(0.0, (math.log(tail) + log_scale) / math.log(10))


def surprising_pairs(members: DataFrame, min_count: int = 1, min_lift: float = 0.0) -> DataFrame:
    """:func:`pair_counts` with expected (under the null), log10_p and q_value.

    Members with a null record or item are dropped, repeats count once, empty tables give no rows. q values count all
    possible pairs of items as tests, ranked over the pairs that the limits leave: with the defaults all pairs that occur,
    which alone gives the Benjamini-Hochberg values. p values are grouped at a thousandth of log10 p, rounded against the pair.
    """
    members = written(members.select("record", "item").where("record is not null and item is not null").distinct(), "members")
    pairs = written(pair_counts(members, min_count, min_lift), "pairs")
    item_deg = members.groupBy("item").agg(F.count("*").alias("d")).groupBy("d").agg(F.count("*").alias("m"))
    rec_deg = members.groupBy("record").agg(F.count("*").alias("d")).groupBy("d").agg(F.count("*").alias("m"))
    items, recs = (t.orderBy("d").limit(MAX_DEGREES + 1).toPandas() for t in (item_deg, rec_deg))  # one row per distinct count
    if max(len(items), len(recs)) > MAX_DEGREES:
        raise ValueError("more distinct degrees than the null model takes")
    di, mi, dr, mr = (a.to_numpy(float) for a in (items.d, items.m, recs.d, recs.m))
    x, y = fit_null(di, mi, dr, mr)
    x_of = dict(zip(di.astype(int).tolist(), x.tolist()))

    def tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for a, c, k in zip(*(b.column(i).to_pylist() for i in range(3))):
                xa, xb = x_of[a], x_of[c]
                probs = (xa * y / (1 + xa * y)) * (xb * y / (1 + xb * y))
                out.append((float((probs * mr).sum()), log10_tail(k, probs, mr)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([o[0] for o in out], pa.float64()), pa.array([o[1] for o in out], pa.float64())], [*b.schema.names, "expected", "log10_p"])

    # a tail depends on the two degrees and the count alone: one row for all pairs that have them in common
    low, high = F.least("n_a", "n_b").alias("_low"), F.greatest("n_a", "n_b").alias("_high")
    kinds = written(pairs.select(low, high, F.col("n_ab").alias("_k")).distinct(), "kinds")
    n_kinds = kinds.count()
    # a tail is a small row and long work: rows are spread by number, not by size
    kinds = kinds.repartition(max(8, min(10_000, n_kinds // 2_000)), "_low", "_high", "_k").mapInArrow(tails, "_low long, _high long, _k long, expected double, log10_p double")
    kinds = written(kinds, "tails")
    kinds = F.broadcast(kinds) if n_kinds <= SENT_TAILS else kinds
    keyed = pairs.select("item_a", "item_b", "n_a", "n_b", "n_ab", "n_records", low, high, F.col("n_ab").alias("_k"))
    scored = written(keyed.join(kinds, ["_low", "_high", "_k"]).drop("_low", "_high", "_k"), "scored")
    scored = scored.withColumn("_bin", F.ceil(F.col("log10_p") * 1000))
    n_items = float(mi.sum())
    tests = max(1.0, n_items * (n_items - 1) / 2)
    bins = scored.groupBy("_bin").agg(F.count("*").alias("n"))  # at most 300,000 bins, whatever the number of pairs
    rank = F.sum("n").over(Window.orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0))
    bins = bins.withColumn("_r", F.least(F.lit(1.0), F.pow(F.lit(10.0), F.col("_bin") / 1000) * tests / rank))
    bins = bins.withColumn("q_value", F.min("_r").over(Window.orderBy(F.col("_bin").desc()).rowsBetween(Window.unboundedPreceding, 0)))
    return scored.join(bins.select("_bin", "q_value"), "_bin").drop("_bin")


def p5_found(spark: SparkSession, directory: str) -> DataFrame:
    """All pairs that occur are counted and scored under the null; of these the exact limits take theirs."""
    scored = surprising_pairs(memberships(spark, directory))
    often = (F.col("n_ab") >= MIN_COUNT) & (F.col("n_ab") * F.col("n_records") >= MIN_LIFT * F.col("n_a") * F.col("n_b"))
    return scored.where(often).select(F.col("item_a").alias("name_a"), F.col("item_b").alias("name_b"))


def p5_surprise(spark: SparkSession, directory: str) -> DataFrame:
    """All pairs that occur, with expected counts, tails and q values."""
    return surprising_pairs(memberships(spark, directory))
