"""Registry, pages, turns and statistics: scans, filters, aggregates and windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from testimonia.functions import text as T
from testimonia.operators import ordered as O
from testimonia.sources.shared import written


def latest_per_url(registry: DataFrame) -> DataFrame:
    """The last discovery of each url; of equal times the downloaded one, then by hash and title."""
    order = [F.col("discovered_at").desc_nulls_last(), F.coalesce(F.col("downloaded").cast("int"), F.lit(0)).desc(), F.coalesce("sha256", F.lit("")).desc(), F.coalesce("title", F.lit("")).desc()]
    return registry.withColumn("_rn", F.row_number().over(Window.partitionBy("url").orderBy(*order))).where("_rn = 1").drop("_rn")


def registry_filter(registry: DataFrame, **equal: str | None) -> DataFrame:
    """The records whose columns have the values given; a None asks nothing."""
    for name, value in equal.items():
        registry = registry.where(F.col(name) == value) if value is not None else registry
    return registry


def download_states(registry: DataFrame) -> DataFrame:
    """Adds state: video (not downloaded), downloaded, missing (at the source, for good) or pending."""
    missing = F.coalesce("notes", F.lit("")).startswith("Missing at source:")
    return registry.withColumn("state", F.when(F.col("source_type") == "video", "video").when(F.col("downloaded"), "downloaded").when(missing, "missing").otherwise("pending"))


def page_lines(pages: DataFrame) -> DataFrame:
    return pages.distinct().select("doc_id", "page_no", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))


def reflowed(pages: DataFrame) -> DataFrame:
    """Per page the surviving lines joined by blanks."""
    lines = F.filter(F.transform(F.split("text", "\n", -1), lambda x: F.trim(x)), lambda x: ~T.is_furniture(x))
    return pages.distinct().select("doc_id", "page_no", F.trim(F.regexp_replace(F.array_join(lines, " "), r"\s+", " ")).alias("text")).where("text <> ''")


def _label(c: str = "speaker"):
    return F.upper(F.trim(F.coalesce(c, F.lit(""))))


def clean_turns(turns: DataFrame) -> DataFrame:
    """Turns with a text, labels trimmed and in capitals; a row delivered twice counts once, keys and a hash of the text being compared."""
    t = turns.where("text is not null").select("doc_id", "turn_no", _label().alias("speaker"), "text", "page_start", "page_end")
    return t.groupBy("doc_id", "turn_no", "speaker", "page_start", "page_end", F.xxhash64("text").alias("_h")).agg(F.first("text").alias("text")).drop("_h")


def turn_words(turns: DataFrame) -> DataFrame:
    """doc_id, turn_no, speaker, words and asks (whether the text ends in a question mark) of :func:`clean_turns`; no text is exchanged."""
    t = turns.where("text is not null").select("doc_id", "turn_no", _label().alias("speaker"), T.word_count(F.col("text")).alias("words"), F.rtrim("text").endswith("?").alias("asks"), F.xxhash64("text").alias("_h"), "page_start", "page_end")
    return t.distinct().drop("page_start", "page_end")


def speaker_words(turns: DataFrame) -> DataFrame:
    return turn_words(turns).groupBy("doc_id", "speaker").agg(F.sum(F.col("words").cast("long")).alias("words"), F.count("*").alias("turns"))


def counsel(turns: DataFrame, least_docs: int = 10) -> DataFrame:
    """Labels with the suffix of senior counsel, or in many documents."""
    t = turns.where("text is not null").select("doc_id", _label().alias("speaker")).where("speaker <> ''").distinct()
    return t.groupBy("speaker").agg(F.count("*").alias("docs")).where(T.is_senior_counsel(F.col("speaker")) | (F.col("docs") >= least_docs))


def witnesses(turns: DataFrame, least_answers: int = 5) -> DataFrame:
    """Per document the speaker of the most answers, of equals the one who answered first: turns after another speaker's question, not by bench or counsel."""
    t = turn_words(turns).where("speaker <> ''")
    t = O.preceding(t, ["doc_id"], "turn_no", ["_h", "speaker"], F.struct("speaker", "asks"), "_p")
    a = t.where(F.col("_p.asks") & (F.col("_p.speaker") != F.col("speaker")) & ~T.is_bench(F.col("speaker")))
    a = a.join(counsel(turns).select("speaker"), "speaker", "left_anti")
    c = a.groupBy("doc_id", "speaker").agg(F.count("*").alias("answers"), F.min("turn_no").alias("_first"))
    best = c.groupBy("doc_id").agg(F.min(F.struct((-F.col("answers")).alias("n"), "_first", "speaker")).alias("b"))
    return best.select("doc_id", F.col("b.speaker").alias("speaker"), (-F.col("b.n")).alias("answers")).where(F.col("answers") >= least_answers)


def labels_carried(turns: DataFrame) -> DataFrame:
    """doc_id, turn_no and the last label up to each turn."""
    t = turn_words(turns)
    return O.last_seen(t, ["doc_id"], "turn_no", ["_h", "speaker"], F.nullif("speaker", F.lit("")), "label").select("doc_id", "turn_no", "label")


def roles(turns: DataFrame) -> DataFrame:
    """Words by role: bench, witness, counsel."""
    s = written(speaker_words(turns), "speakers").where("speaker <> ''").join(witnesses(turns).select("doc_id", F.col("speaker").alias("w")), "doc_id", "left")
    role = F.when(T.is_bench(F.col("speaker")), "bench").when(F.col("speaker") == F.col("w"), "witness").otherwise("counsel")
    r = s.groupBy(role.alias("role")).agg(F.sum("words").alias("words"))
    total = r.agg(F.sum("words").alias("total"))
    return r.crossJoin(F.broadcast(total)).select("role", "words", (100.0 * F.col("words") / F.col("total")).alias("share"))  # one row


def active(registry: DataFrame) -> DataFrame:
    """Records with a file that no other one supersedes."""
    return registry.where("downloaded and coalesce(local_path, '') <> '' and coalesce(superseded_by, '') = '' and sha256 is not null")


def day_series(chunks: DataFrame) -> DataFrame:
    """Per day with a valid date: the number of chunks and of characters."""
    c = chunks.distinct().withColumn("d", F.expr("try_to_date(hearing_date, 'yyyy-MM-dd')")).where("d is not null and day_no is not null")
    return c.groupBy("d").agg(F.countDistinct("chunk_id").alias("chunks"), F.sum(F.length("text").cast("long")).alias("chars"))


def candidate_keys(registry: DataFrame) -> DataFrame:
    """doc_id, key, side: two documents are candidates if they share a key, and have different sides where sides are set (0 and 1).

    Keys are a commission's day, its date, and a day with the day after it; so the disjunction is an equality.
    """
    r = registry.where("sha256 is not null").select("commission_slug", F.col("sha256").alias("doc_id"), "day_no", "hearing_date").distinct()
    key = lambda kind, c: F.xxhash64(F.lit(kind), "commission_slug", c)
    none = F.lit(None).cast("int")
    day, date = F.col("day_no"), F.when(F.col("hearing_date") != "", F.col("hearing_date"))
    keys = [(key("day", day), none, day), (key("date", date), none, date), (key("next", day), F.lit(0), day), (key("next", day - 1), F.lit(1), day)]
    rows = F.filter(F.array(*[F.when(known.isNotNull(), F.struct(k.alias("key"), side.alias("side"))) for k, side, known in keys]), lambda x: x.isNotNull())
    return r.select("doc_id", F.explode(rows).alias("k")).select("doc_id", "k.key", "k.side").distinct()


def _meet(left: DataFrame, right: DataFrame, on: list[str], a: str, b: str) -> DataFrame:
    """Rows of both that share ``on`` and fit by their sides, each pair of ``a`` and ``b`` in one order, but for sides, where it comes as they are."""
    both = left.join(right, on)
    return both.where((F.col("sa").isNull() & F.col("sb").isNull() & (F.col(a) < F.col(b))) | ((F.col("sa") == 0) & (F.col("sb") == 1) & (F.col(a) != F.col(b))))


def candidate_documents(registry: DataFrame) -> DataFrame:
    """Pairs of documents with the same day, the same date or adjacent days."""
    k = candidate_keys(registry)
    x, y = k.select(F.col("doc_id").alias("x"), "key", F.col("side").alias("sa")), k.select(F.col("doc_id").alias("y"), "key", F.col("side").alias("sb"))
    return _meet(x, y, ["key"], "x", "y").select(F.least("x", "y").alias("doc_a"), F.greatest("x", "y").alias("doc_b")).distinct()


SHINGLE_WORDS = 10
#: Names of documents up to this number are broadcast, their number being counted first; more are shuffled.
NAMES = 100_000


def shingles(pages: DataFrame, docs: DataFrame, n: int = SHINGLE_WORDS) -> DataFrame:
    """id (a hash of doc_id), h: hashes of the distinct sequences of n words of each document's text, layout lines left out.

    Sequences go on over page ends: a page takes the first words of the pages that follow it along, no more. A document of
    fewer words is one sequence. ``docs``: doc_id of the documents asked for.
    """
    lines = F.filter(F.transform(F.split("text", "\n", -1), lambda x: F.trim(F.regexp_replace(x, r"(?U)\s+", " "))), lambda x: (x != "") & ~T.is_layout(x))
    words = F.split(F.array_join(lines, " "), " ")
    p = pages.join(docs.distinct(), "doc_id", "left_semi").select("doc_id", "page_no", words.alias("w")).where("w[0] <> ''")
    p = p.groupBy("doc_id", "page_no", F.xxhash64("w").alias("_h")).agg(F.first("w").alias("w"))
    p = O.following(p, ["doc_id"], "page_no", F.slice("w", 1, n - 1), "_after", n - 1)
    p = p.withColumn("_all", F.concat("w", F.slice(F.flatten("_after"), 1, n - 1)))
    last = F.least(F.size("w"), F.size("_all") - n + 1)
    hs = F.when(last > 0, F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.array_join(F.slice("_all", i, n), " "))))
    long = p.select("doc_id", F.explode(F.array_distinct(hs)).alias("h"))
    # a short document has no sequence of n words on any of its pages
    short = p.groupBy("doc_id").agg(F.sum(F.size("w")).alias("k"), F.slice(F.sort_array(F.collect_list(F.struct("page_no", F.slice("w", 1, n).alias("w")))), 1, n).alias("ws")).where(f"k < {n}")
    short = short.select("doc_id", F.xxhash64(F.array_join(F.flatten(F.transform("ws", lambda x: x["w"])), " ")).alias("h"))
    return long.unionByName(short).select(F.xxhash64("doc_id").alias("id"), "h").distinct()


def containment(registry: DataFrame, pages: DataFrame, least: float = 0.6) -> DataFrame:
    """Candidate pairs of documents with pages: the share of each one's sequences that the other has, and whether one repeats the other.

    Sequences are hashed once, and only of documents in a pair. They meet under the keys that make documents candidates,
    so that a sequence which many documents have makes no other pairs than those asked for. A document without words has
    a share of 0.
    """
    have = written(pages.select("doc_id").distinct(), "documents")
    a, b = have.select(F.col("doc_id").alias("doc_a")), have.select(F.col("doc_id").alias("doc_b"))
    # pairs are many, so they go by numbers; names come back at the end
    pairs = candidate_documents(registry).join(a, "doc_a").join(b, "doc_b").select(F.xxhash64("doc_a").alias("a"), F.xxhash64("doc_b").alias("b"))
    pairs = written(pairs, "pairs")
    asked = have.join(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), F.xxhash64("doc_id") == F.col("id"), "left_semi")
    sets = written(shingles(pages, asked), "sets")
    sizes = sets.groupBy("id").agg(F.count("*").alias("n"))
    keys = candidate_keys(registry).select(F.xxhash64("doc_id").alias("id"), "key", "side").distinct()
    under = sets.join(keys, "id").select("id", "key", "side", F.xxhash64("key", "h").alias("kh"))
    x, y = under.select(F.col("id").alias("x"), "key", "kh", F.col("side").alias("sa")), under.select(F.col("id").alias("y"), "kh", F.col("side").alias("sb"))
    met = _meet(x, y, ["kh"], "x", "y").groupBy("x", "y", "key").agg(F.count("*").alias("k"))
    # under each key the count is the whole intersection
    both = met.groupBy("x", "y").agg(F.max("k").alias("k"))
    both = both.select(F.col("x").alias("a"), F.col("y").alias("b"), "k").unionByName(both.select(F.col("y").alias("a"), F.col("x").alias("b"), "k")).groupBy("a", "b").agg(F.max("k").alias("k"))
    na, nb = sizes.select(F.col("id").alias("a"), F.col("n").alias("na")), sizes.select(F.col("id").alias("b"), F.col("n").alias("nb"))
    out = pairs.join(na, "a", "left").join(nb, "b", "left").join(both, ["a", "b"], "left")
    share = lambda n: F.coalesce(F.try_divide(F.col("k").cast("double"), F.col(n)), F.lit(0.0))
    out = out.select("a", "b", share("na").alias("a_in_b"), share("nb").alias("b_in_a"))
    hint = F.broadcast if have.count() <= NAMES else (lambda x: x)
    na, nb = have.select(F.xxhash64("doc_id").alias("a"), F.col("doc_id").alias("doc_a")), have.select(F.xxhash64("doc_id").alias("b"), F.col("doc_id").alias("doc_b"))
    out = out.join(hint(na), "a").join(hint(nb), "b").select("doc_a", "doc_b", "a_in_b", "b_in_a")
    return out.withColumn("is_duplicate", F.greatest("a_in_b", "b_in_a") >= least)
