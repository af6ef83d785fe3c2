"""Near-duplicate documents by an LSH forest and exact verification.

Each document's running words give its set of word sequences, of which a signature of TREES * DEPTH minimum hashes is
kept. Every tree is one sorted order of all documents, by DEPTH hashes of the signature. Documents whose longest common
prefix in an order has all DEPTH hashes stand next to each other and form a region of it.

The depth adapts to each region. Neighbours in a region of at most REGION documents are candidates for each other. A
larger region is sorted anew in BRANCHES further orders, each by one more hash; a pair of similarity J is found again in
BRANCHES * J of them on average, so pairs of J = 0.55 multiply (1.65) while pairs below a third die out. Where the orders
do not part a region, its documents are alike, and all of them are compared, block by block. So no pair is given up
because its region is full: at J = 0.55 a pair is missed with (1 - 0.55 ** DEPTH * 0.849) ** TREES = 0.008 at most,
0.849 being the chance that a branching process with three trials of 0.55 never dies.

Neighbours are compared by sketches of two bits a hash inside the task that holds the region, so that only likely pairs
leave it. These are verified exactly: the sets, cut into buckets by hash, are joined bucket by bucket and intersections
added. Documents with equal sets are compared once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from testimonia.llm.scans import HYPHENS, _known_of, distinct_pages, page_body, with_known_edges
from testimonia.sources.shared import written
from testimonia.sources.tables import table

WORDS, SIMILARITY = 3, 0.55
TREES, DEPTH, BRANCHES = 32, 3, 3
#: Documents of a region that are compared with each other without a deeper order.
REGION = 1024
#: Deeper orders of a full region; what is still full below them is compared whole.
LEVELS = 8
#: Documents of a region of alike documents that one task compares with as many others.
BLOCK = 512
#: Pages of a document that are hashed together, and parts into which a document's set is cut for verification.
PAGES, BUCKETS = 256, 8
_SIGNS = re.compile(r"[^\w\s]|_")
_PLAIN_SIGNS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def running_words(lines: list[str]) -> tuple[list[str], bool]:
    """Words of letters and digits only, in lower case, cut words joined; and whether the last one is cut by the end."""
    out = []
    for x in lines:
        if len(x) > 1 and x[-1] in HYPHENS and x[-2].isalnum():
            out.append(x[:-1])
        else:
            out.append(x)
            out.append("\n")
    is_cut = bool(out) and out[-1] != "\n"
    text = "".join(out).lower()
    return (text.encode().translate(None, _PLAIN_SIGNS).decode() if text.isascii() else _SIGNS.sub("", text)).split(), is_cut


def sequence_hashes(words: np.ndarray, n: int = WORDS) -> np.ndarray:
    """Hashes of the sequences of n successive words, from the words' hashes; a shorter text is one sequence."""
    if not len(words):
        return words
    n = min(n, len(words))
    h = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        h = (h ^ words[i : len(words) - n + 1 + i]) * _MIX
        h ^= h >> np.uint64(29)
    return h


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) > 500_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_240)
    k = TREES * DEPTH
    return rng.integers(1, 2**32, k, dtype=np.uint64) | np.uint64(1), rng.integers(0, 2**32, k, dtype=np.uint64)


_A, _B = (x.astype(np.uint32) for x in _permutations())


def signature(hashes: np.ndarray) -> np.ndarray:
    """TREES * DEPTH minimum hashes of 32 bits; the largest value where there is nothing."""
    low = np.full(len(_A), 0xFFFFFFFF, np.uint32)
    x = ((hashes ^ (hashes >> np.uint64(32))) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    for i in range(0, len(x), 1024):  # pieces that stay in the cache
        y = np.multiply(x[i : i + 1024, None], _A)
        y += _B
        np.minimum(low, y.min(axis=0), out=low)
    return low


def sketch(sig: np.ndarray) -> list[int]:
    """Two bits of each minimum hash, in words of 64, first all high bits, then all low ones: documents of similarity J
    agree in both bits of a share J + (1 - J) / 4."""
    out = []
    for shift in (31, 30):
        bits = np.zeros(-(-len(sig) // 64) * 64, np.uint8)
        bits[: len(sig)] = ((sig * np.uint32(0x9E3779B1)) >> np.uint32(shift)).astype(np.uint8) & 1
        out += np.packbits(bits).view(np.int64).tolist()
    return out


def _hashed(words: list[str], known: dict) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


PART = "doc_id string, blk int, n long, xor long, sum long, sig array<int>, sketch array<bigint>, words string, cut boolean"
_PART_TYPES = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.string(), pa.bool_()]


def block_parts(pages: DataFrame) -> DataFrame:
    """Per document and block of PAGES pages: size, fingerprint and signature of its sequences, and its words (joined by blanks).

    One exchange by (document, block) and one sort serve to drop repeated pages, which then follow each other, to order
    them and to read words across pages.
    """
    keyed = pages.where("doc_id is not null and text is not null").select("doc_id", F.col("page_no").cast("int").alias("page_no"), "text")
    keyed = keyed.withColumn("blk", F.coalesce(F.floor(F.col("page_no") / PAGES), F.lit(-1)).cast("int")).repartition("doc_id", "blk")
    keyed, sent = with_known_edges(keyed, pages)
    keyed = keyed.select("doc_id", "page_no", "text", "known", "blk").repartition("doc_id", "blk") if sent is None else keyed
    keyed = keyed.select("doc_id", "page_no", "text", "known", "blk").sortWithinPartitions("doc_id", "blk", "page_no", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forms = sent.value if sent is not None else None
        hashes, out = WordHashes(), []
        now, words, cut, seen = None, [], False, None

        def part() -> tuple:
            h = np.unique(sequence_hashes(_hashed(words, hashes)))
            sig = signature(h)
            return (*now, len(h), int(np.bitwise_xor.reduce(h).view(np.int64)), int(h.sum(dtype=np.uint64).view(np.int64)), sig.view(np.int32), sketch(sig), " ".join(words), cut)

        for b in batches:
            for d, p, t, k, blk in zip(*(b.column(i).to_pylist() for i in range(5))):
                if (d, p, t) == seen:  # delivered twice
                    continue
                seen = (d, p, t)
                if (d, blk) != now:
                    if words:
                        out.append(part())
                    now, words, cut = (d, blk), [], False
                w, c = running_words([x for _, x in page_body(t, p, _known_of(k, forms))[1]])
                if w:
                    if cut and words:
                        words[-1] += w.pop(0)
                    words += w
                    cut = c
            if len(out) >= 256:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _PART_TYPES)], _PART_NAMES)
                out = []
        if words:
            out.append(part())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _PART_TYPES)], _PART_NAMES)

    return keyed.mapInArrow(run, PART)


_PART_NAMES = [c.split(" ")[0] for c in PART.split(", ")]


def signatures(parts: DataFrame) -> DataFrame:
    """doc_id, print (a fingerprint of the set), sig and sketch of each document, from its blocks.

    A document of several blocks has the minima of their signatures; it is compared by its words and never taken as
    equal to another by its fingerprint.
    """
    several = written(parts.groupBy("doc_id").agg(F.count("*").alias("c")).where("c > 1").select("doc_id"), "several")
    single = parts.join(several, "doc_id", "left_anti").select("doc_id", F.struct("n", "xor", "sum").alias("print"), "sig", "sketch")
    long = parts.join(several, "doc_id").select("doc_id", "sig")
    lows = long.select("doc_id", F.posexplode("sig").alias("i", "v")).groupBy("doc_id", "i").agg(F.min(F.expr("v + 0L + if(v < 0, 4294967296L, 0L)")).alias("v"))
    signed = F.expr("transform(sort_array(collect_list(struct(i, v))), x -> cast(if(x.v >= 2147483648L, x.v - 4294967296L, x.v) as int))")

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [sketch(np.array(x, np.int32).view(np.uint32)) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(rows, pa.list_(pa.int64()))], ["doc_id", "sig", "sketch"])

    joined = lows.groupBy("doc_id").agg(signed.alias("sig")).mapInArrow(sketched, "doc_id string, sig array<int>, sketch array<bigint>")
    own = F.struct(F.lit(-1).cast("long").alias("n"), F.xxhash64("doc_id").alias("xor"), F.xxhash64("doc_id", F.lit(1)).alias("sum"))
    return single.unionByName(joined.select("doc_id", own.alias("print"), "sig", "sketch"))


def _most_apart(similarity: float, sigmas: float = 4.0) -> int:
    """Positions in which two sketches may differ; four standard errors below the similarity count as excluded (one pair in 30,000 at the similarity itself)."""
    k = TREES * DEPTH
    agree = similarity + (1 - similarity) / 4
    return int((1 - agree) * k + sigmas * (agree * (1 - agree) * k) ** 0.5)


def _near(left: np.ndarray, right: np.ndarray, most: int, rows: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Positions (of left, of right) of the sketches that differ in at most ``most`` places, some rows at a time."""
    half, found = left.shape[1] // 2, ([], [])
    for k in range(0, len(left), rows):
        part = left[k : k + rows]
        apart = np.zeros((len(part), len(right)), np.uint16)
        for i in range(half):
            x = (part[:, None, i] ^ right[None, :, i]) | (part[:, None, i + half] ^ right[None, :, i + half])
            apart += np.bitwise_count(x.view(np.uint64))
        i, j = np.nonzero(apart <= most)
        found[0].append(i + k)
        found[1].append(j)
    return np.concatenate(found[0]), np.concatenate(found[1])


def _pairs_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64())], ["a", "b"])


def _sketches(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _region_pairs(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Likely pairs of the regions (key, id, sketch) of a sorted order; rows of one key stand together, REGION at most."""
    keys, ids, sk = np.zeros(0, np.int64), np.zeros(0, np.int64), None

    def pairs(last: bool) -> Iterator[pa.RecordBatch]:
        nonlocal keys, ids, sk
        # the first row of each region: where the common prefix with the row before it breaks off
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        ends = np.append(first[1:], len(keys))
        done = len(first) if last else len(first) - 1  # the last region may go on in the next batch
        left, right = [], []
        for x, y in zip(first[:done].tolist(), ends[:done].tolist()):
            if y - x > 1:
                i, j = _near(sk[x:y], sk[x:y], most)
                ok = ids[x + i] < ids[x + j]
                left.append(ids[x + i[ok]])
                right.append(ids[x + j[ok]])
        if left:
            yield _pairs_batch(np.concatenate(left), np.concatenate(right))
        cut = ends[done - 1] if done > 0 else 0
        keys, ids, sk = keys[cut:], ids[cut:], sk[cut:] if sk is not None else None

    for b in batches:
        if b.num_rows:
            new = _sketches(b.column(2))
            keys, ids = np.concatenate([keys, b.column(0).to_numpy()]), np.concatenate([ids, b.column(1).to_numpy()])
            sk = new if sk is None or not len(sk) else np.concatenate([sk, new])
            yield from pairs(False)
    yield from pairs(True)


def _block_pairs(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Likely pairs between two blocks (ids and sketches of either) of a region of alike documents."""
    for b in batches:
        for i in range(b.num_rows):
            row = b.slice(i, 1)
            x, y = (row.column(c).flatten().to_numpy(zero_copy_only=False) for c in (0, 2))
            sx, sy = (row.column(c).flatten().flatten().to_numpy(zero_copy_only=False).reshape(n, -1) for c, n in ((1, len(x)), (3, len(y))))
            i_, j_ = _near(sx, sy, most)
            ok = x[i_] != y[j_]
            if ok.any():
                yield _pairs_batch(x[i_[ok]], y[j_[ok]])


def _whole_regions(rows: DataFrame, most: int) -> DataFrame:
    """All likely pairs of regions (key, c, id, sketch) of alike documents: blocks of BLOCK, each against itself and those after it."""
    part = rows.withColumn("n_b", F.ceil(F.col("c") / BLOCK)).withColumn("b", F.pmod(F.xxhash64("id"), "n_b"))
    blocks = part.groupBy("key", "b").agg(F.collect_list(F.struct("id", "sketch")).alias("m"), F.first("n_b").alias("n_b"))
    blocks = blocks.select("key", "b", "n_b", F.col("m.id").alias("ids"), F.col("m.sketch").alias("sketches"))
    left = blocks.select("key", F.col("b").alias("l"), F.explode(F.sequence(F.col("b"), F.col("n_b") - 1)).alias("b"), "ids", "sketches")
    right = blocks.select("key", "b", F.col("ids").alias("r_ids"), F.col("sketches").alias("r_sketches"))
    both = left.join(right, ["key", "b"]).repartition("key", "b", "l").select("ids", "sketches", "r_ids", "r_sketches")
    return both.mapInArrow(lambda it: _block_pairs(it, most), "a long, b long")


def forest_pairs(reps: DataFrame, similarity: float = SIMILARITY, region: int = REGION) -> DataFrame:
    """Distinct likely pairs (a < b) of ``reps`` (id long, sig, sketch): neighbours in the sorted orders of the forest."""
    most, k = _most_apart(similarity), TREES * DEPTH
    labels = F.array(*[F.xxhash64(F.lit(t), *[F.get("sig", F.lit(t * DEPTH + i)) for i in range(DEPTH)]) for t in range(TREES)])
    rows = reps.select("id", F.explode(labels).alias("key"))
    sketches, out = reps.select("id", "sketch"), []
    for level in range(LEVELS + 1):
        # the sizes of the regions come first, so that no full one is ever brought together; labels and ids alone are exchanged
        sizes = rows.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")
        inside = written(rows.join(written(sizes, f"sizes{level}"), "key"), f"regions{level}")
        small = inside.where(F.col("c") <= region).select("key", "id").join(sketches, "id").select("key", "id", "sketch")
        out.append(small.repartition("key").sortWithinPartitions("key", "id").mapInArrow(lambda it: _region_pairs(it, most), "a long, b long"))
        full = inside.where(F.col("c") > region)
        if full.isEmpty():
            break
        if level == LEVELS:
            out.append(_whole_regions(full.join(sketches, "id"), most))
            break
        # further orders of the full regions: one more hash each, another one for every region, level and order
        at = F.pmod(F.xxhash64("key", F.lit(level), "o"), F.lit(k)).cast("int")
        deeper = full.join(reps.select("id", "sig"), "id").select("key", "c", "id", "sig", F.explode(F.sequence(F.lit(0), F.lit(BRANCHES - 1))).alias("o"))
        deeper = written(deeper.select(F.col("key").alias("up"), F.xxhash64("key", F.lit(level), "o", F.get("sig", at)).alias("key"), "c", "id"), f"deeper{level}")
        # the share of a region's pairs that stay together in a further order: their mean similarity
        kept = deeper.groupBy("up", "c", "key").agg(F.count("*").alias("n")).groupBy("up").agg((F.sum(F.col("n") * F.col("n") / BRANCHES) / F.first(F.col("c") * F.col("c"))).alias("share"))
        kept = written(kept, f"shares{level}")
        alike = kept.where(F.col("share") >= 1 / BRANCHES).select(F.col("up").alias("key"))
        out.append(_whole_regions(full.join(alike, "key", "left_semi").join(sketches, "id"), most))
        rows = deeper.join(kept.where(F.col("share") < 1 / BRANCHES).select("up"), "up", "left_semi").select("key", "id")
    pairs = out[0]
    for more in out[1:]:
        pairs = pairs.unionByName(more)
    return pairs.distinct()


def verified(pairs: DataFrame, ids: DataFrame, parts: DataFrame, similarity: float) -> DataFrame:
    """(a, b, similarity) of the pairs whose exact Jaccard similarity is at least ``similarity``; ``ids``: id, doc_id."""
    asked = written(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(ids, "id"), "asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, names = WordHashes(), ["id", "bucket", "hs"]
        types = [pa.int64(), pa.int32(), pa.list_(pa.int64())]
        now, words, cut = None, [], False

        def sets() -> pa.RecordBatch:
            h = np.unique(sequence_hashes(_hashed(words, known)))
            at = (h >> np.uint64(61)).astype(np.int32)
            rows = [(now, i, h[at == i].view(np.int64)) for i in range(BUCKETS)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for b in batches:
            for i, t, c in zip(*(b.column(n).to_pylist() for n in ("id", "words", "cut"))):
                if i != now:
                    if now is not None:
                        yield sets()
                    now, words, cut = i, [], False
                w = t.split(" ")
                if cut and words:
                    words[-1] += w.pop(0)
                words += w
                cut = c
        if now is not None:
            yield sets()

    mine = parts.select("doc_id", "blk", "words", "cut").join(asked, "doc_id").select("id", "blk", "words", "cut")
    mine = mine.repartition("id").sortWithinPartitions("id", "blk")
    sets = written(mine.mapInArrow(run, "id long, bucket int, hs array<bigint>"), "sets")
    a, b = sets.select(F.col("id").alias("a"), "bucket", F.col("hs").alias("ha")), sets.select(F.col("id").alias("b"), "bucket", F.col("hs").alias("hb"))
    met = pairs.join(a, "a").join(b, ["b", "bucket"])
    met = met.select("a", "b", F.size(F.array_intersect("ha", "hb")).alias("i"), (F.size("ha") + F.size("hb")).alias("s"))
    j = F.col("i") / (F.col("s") - F.col("i"))
    return met.groupBy("a", "b").agg(F.sum("i").alias("i"), F.sum("s").alias("s")).withColumn("similarity", j).where(F.col("similarity") >= similarity).select("a", "b", "similarity")


def similar_documents(pages: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(members, links): members has doc_id, class_id and n_links of every document with words; links has class_a < class_b and similarity.

    ``pages``: doc_id, page_no, text; other columns are not read. A class is the documents of one set of sequences,
    named by its smallest doc_id. Null texts and doc_ids, and documents without running words, have no class. Pages
    delivered twice count once; a null page number comes first. Empty tables give no rows.
    """
    parts = written(block_parts(pages), "parts")
    sigs = signatures(parts)
    reps = sigs.groupBy("print").agg(F.min_by(F.struct("doc_id", "sig", "sketch"), "doc_id").alias("r"))
    reps = written(reps.select("r.doc_id", "r.sig", "r.sketch", "print", F.xxhash64("r.doc_id").alias("id")), "classes")
    ids = reps.select("id", "doc_id")
    pairs = written(forest_pairs(reps, similarity), "candidates")
    good = verified(pairs, ids, parts, similarity)
    a, b = ids.select(F.col("id").alias("a"), F.col("doc_id").alias("x")), ids.select(F.col("id").alias("b"), F.col("doc_id").alias("y"))
    links = good.join(a, "a").join(b, "b").select(F.least("x", "y").alias("class_a"), F.greatest("x", "y").alias("class_b"), "similarity")
    links = written(links, "links")
    degree = links.select(F.explode(F.array("class_a", "class_b")).alias("class_id")).groupBy("class_id").agg(F.count("*").alias("n_links"))
    named = sigs.join(reps.select("print", F.col("doc_id").alias("class_id")), "print").select("doc_id", "class_id")
    return named.join(degree, "class_id", "left").select("doc_id", "class_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")), links


def p7_found(spark: SparkSession, directory: str) -> DataFrame:
    members, links = similar_documents(table(spark, directory, "pages"))
    m = members.select("doc_id", "class_id")
    # every pair of documents is a case here: those of one class, and those of two linked classes
    x, y = m.select(F.col("doc_id").alias("x"), F.col("class_id").alias("class_a")), m.select(F.col("doc_id").alias("y"), F.col("class_id").alias("class_b"))
    equal = x.join(y.withColumnRenamed("class_b", "class_a"), "class_a").where("x < y").select("x", "y")
    near = links.join(x, "class_a").join(y, "class_b").select("x", "y")
    return equal.unionByName(near).select(F.least("x", "y").alias("sha_a"), F.greatest("x", "y").alias("sha_b")).distinct()


def p7_classes(spark: SparkSession, directory: str) -> DataFrame:
    """Each document with its class and its number of links."""
    return similar_documents(table(spark, directory, "pages"))[0]
