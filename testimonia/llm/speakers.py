"""Raw transcript rows into clean, ordered speaker turns.

Labels, noise and words are taken out with SQL expressions inside code generation. Speakers are carried forward by
windows over blocks of turns, and consecutive rows of one speaker are joined by gaps-and-islands identifiers; a table
with one row per block carries speaker and identifier across blocks, so that no task holds a whole document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from testimonia.operators.ordered import with_block
from testimonia.sources.shared import written
from testimonia.sources.tables import table

BLOCK = 4096

# Ranks and titles as written, and their short form.
TITLES = {
    "ADVOCATE": "ADV", "ADV": "ADV", "BRIGADIER": "BRIG", "BRIG": "BRIG", "CAPTAIN": "CAPT", "CAPT": "CAPT", "COLONEL": "COL", "COL": "COL",
    "DOCTOR": "DR", "DR": "DR", "GENERAL": "GEN", "GEN": "GEN", "LIEUTENANT-GENERAL": "LT-GEN", "LT-GEN": "LT-GEN", "MAJOR-GENERAL": "MAJ-GEN",
    "MAJ-GEN": "MAJ-GEN", "MISTER": "MR", "MR": "MR", "MISSUS": "MRS", "MRS": "MRS", "MISS": "MISS", "MS": "MS", "PROFESSOR": "PROF", "PROF": "PROF",
    "JUSTICE": "JUSTICE", "JUDGE": "JUDGE", "COMMISSIONER": "COMMISSIONER", "SERGEANT": "SGT", "SGT": "SGT", "MAJOR": "MAJ", "MAJ": "MAJ",
}
# Speakers who are named by what they do.
ROLES = ["CHAIRPERSON", "CHAIRMAN", "CHAIR", "INTERPRETER", "UNIDENTIFIED", "REGISTRAR", "WITNESS", "COMMISSION"]
# Sounds of hesitation.
HESITATION = ["uh", "uhm", "um", "umm", "er", "err", "erm", "hmm", "hm", "mm", "mmm", "ah", "eh", "you know"]

_HEAD = r"(?:\s*(?:>>|\[[\d:]+\]|\([\d:]+\)|<[\d:]+>))*\s*"
_ASIDE = r"\s*(?:\([^)]*\)|\[[^\]]*\]|\{[^}]*\}|<[^>]*>)"
_LABEL = (
    r"(?:(?:CROSS-|RE-)?EXAMINATION(?:\s+IN\s+CHIEF)?\s+BY\s+)?(?:(?i:" + "|".join(sorted((t.replace("-", r"\.?[\s-]+") for t in TITLES), key=len, reverse=True)) + r")\.?\s+[\p{L}\p{N}'.\- ]{2,48}?"
    r"|(?i:THE\s+)?(?i:" + "|".join(ROLES) + r"|CHAIR\s+PERSON)(?i:\s+SPEAKER)?|CHA[\p{L}\p{N}]{4,10})"
)
TEXT_LABEL = rf"^{_HEAD}({_LABEL}(?:{_ASIDE})?)\s*[-–]?\s*:\s"
MARKED = r"\((?![Pp](?:ty|TY|roprietary|ROPRIETARY)\))[^()]*\)|\[[^\[\]]*\]|\{[^{}]*\}|<[^<>]*>|\*[^*\n]{1,40}\*|[♪♫]+|\b\d{1,2}:\d{2}:\d{2}(?:[.,]\d+)?\b"
_PAUSE = r"(?i)(?<![\p{L}\p{N}])(?:" + "|".join(HESITATION) + r")(?![\p{L}\p{N}'’])(?:\s*\.{3})?[,]?(?:\s+[-–—](?=\s))?"


def spoken(text: Column) -> Column:
    """Only the words spoken: without marked sounds, times and hesitation; single blanks."""
    plain = F.regexp_replace(F.regexp_replace(text, MARKED, " "), _PAUSE, " ")
    return F.trim(F.regexp_replace(F.regexp_replace(plain, r"(?U)\s+", " "), r" ([,.;:?!])(?=\s|$)", "$1"))


def has_words(text: Column) -> Column:
    """Whether a letter or digit is left, other than a bare time of day."""
    return F.coalesce(F.regexp_replace(text, r"\b\d{1,2}:\d{2}\b", " ").rlike(r"[\p{L}\p{N}]"), F.lit(False))


def label_text(label: Column) -> Column:
    """The label without marks, headings and asides, upper case; null if nothing is left."""
    s = F.regexp_replace(label, rf"{_ASIDE}|^\s*>>|\*[^*]*\*", " ")
    s = F.upper(F.trim(F.regexp_replace(F.regexp_replace(s, "[.:]", " "), r"(?U)\s+", " ")))
    s = F.regexp_replace(s, r"^(?:CROSS-|RE-)?EXAMINATION(?: IN CHIEF)? BY ", "")
    s = F.regexp_replace(F.regexp_replace(s, r"^THE (?=CHAIR)", ""), r"\s*[-–—]+\s*$", "")
    s = F.regexp_replace(F.trim(s), r" SPEAKER$", "")
    s = F.regexp_replace(s, r"^(LT|LIEUTENANT|MAJ|MAJOR) ?[- ] ?(GEN|GENERAL)\b", "$1-$2")
    return F.when(s.rlike(r"\p{L}"), s)


# A title and its short form, as alternating map entries; both spellings of a compound rank.
_SHORT = {**TITLES, "LIEUTENANT-GEN": "LT-GEN", "LT-GENERAL": "LT-GEN", "MAJOR-GEN": "MAJ-GEN", "MAJ-GENERAL": "MAJ-GEN"}


def with_speaker(rows: DataFrame, label: str = "label") -> DataFrame:
    """Adds title in its short form (empty for a role) and name, folded so that spellings of it agree; null without a label."""
    titles = F.create_map(*[F.lit(x) for kv in _SHORT.items() for x in kv])
    rows = rows.withColumn("title", F.when(F.col(label).contains(" "), F.try_element_at(titles, F.substring_index(label, " ", 1))))
    rows = rows.withColumn("name", F.when(F.col("title").isNotNull(), F.regexp_replace(label, r"^\S+ ", "")).otherwise(F.col(label)))
    # senior counsel are often named without the suffix; letters and figures that scanning confuses fold together
    folded = F.translate(F.regexp_replace(F.regexp_replace("name", r" SC$", ""), r"[^\p{L}\p{N}]", ""), "L10O5S", "IIOOSS")
    rows = rows.withColumn("name", folded)
    chair = F.levenshtein("name", F.lit("CHAIRPERSON"), 2) >= 0
    return rows.withColumn("title", F.coalesce("title", F.lit(""))).withColumn("name", F.when(chair, F.lit("CHAIRPERSON")).otherwise(F.col("name")))


def _deletions(name: Column) -> Column:
    """The name and the name without one letter, for each letter: spellings one edit apart share one of them."""
    cut = F.transform(F.sequence(F.lit(1), F.length(name)), lambda i: F.concat(F.substring(name, 1, i - 1), name.substr(i + 1, F.lit(200))))
    return F.array_distinct(F.concat(F.array(name), cut))


def one_person(labels: DataFrame) -> DataFrame:
    """Maps rare spellings to the frequent one: (doc_id, title, name) to ``as_name``, inside a document and a title.

    Spellings are one if they are one letter apart (another, missing, additional or two exchanged). ``labels`` has one
    row per spelling with its count ``n``; the join is by shared one-letter deletions.
    """
    cand = labels.where(F.length("name") >= 5).select("doc_id", "title", "name", "n", F.explode(_deletions(F.col("name"))).alias("cut"))
    a, b = cand.alias("a"), cand.alias("b")
    pairs = a.join(b, (F.col("a.doc_id") == F.col("b.doc_id")) & (F.col("a.title") == F.col("b.title")) & (F.col("a.cut") == F.col("b.cut")))
    more = (F.col("b.n") > F.col("a.n")) | ((F.col("b.n") == F.col("a.n")) & (F.col("b.name") < F.col("a.name")))
    best = pairs.where(more).groupBy(F.col("a.doc_id").alias("doc_id"), F.col("a.title").alias("title"), F.col("a.name").alias("name"))
    return best.agg(F.max_by("b.name", F.struct("b.n", "b.name")).alias("as_name"))


def labelled(rows: DataFrame) -> DataFrame:
    """Adds title, name (null without a label), label and words (null if nobody spoke) to (doc_id, turn_no, speaker, text, ...)."""
    rows = rows.withColumn("_own", label_text(F.col("speaker")))
    rows = rows.withColumn("_head", F.regexp_extract("text", TEXT_LABEL, 0))
    rows = rows.withColumn("words", spoken(F.expr("substr(text, coalesce(length(_head), 0) + 1)")))
    rows = rows.withColumn("words", F.when(has_words(F.col("words")), F.col("words")))
    rows = rows.withColumn("label", F.coalesce("_own", F.when(F.col("_head") != "", label_text(F.regexp_replace("_head", rf"^{_HEAD}", "")))))
    return with_speaker(rows).drop("_head", "_own")


def marked_turns(rows: DataFrame, keep_words: bool = True) -> DataFrame:
    """Each distinct row of ``rows`` with ``spoke``, ``begins`` (whether it begins a clean turn) and ``who``.

    ``rows``: doc_id, turn_no, speaker, text, page_start, page_end; other columns are not read. Rows where nobody speaks
    begin nothing and have null ``who``. A row without any label goes on with the speaker before it; rows before the
    first label of a document belong to one unknown speaker (null). A null doc_id is a document of its own; a null
    turn_no comes first; equal turn_no are ordered by a hash of label and text. An empty table gives no rows.
    """
    rows = rows.select("doc_id", F.col("turn_no").cast("long").alias("turn_no"), "speaker", "text", "page_start", "page_end")
    rows = with_block(rows, "turn_no", BLOCK).repartition("doc_id", "_blk").distinct().withColumn("_tie", F.xxhash64("speaker", "text"))
    rows = labelled(rows).withColumn("spoke", F.col("words").isNotNull()).drop("speaker", "text", *([] if keep_words else ["words"]))
    # labels and words are taken out once; three branches read them
    rows = written(rows, "labelled").repartition("doc_id", "_blk")
    names = rows.where("spoke and name is not null").groupBy("doc_id", "title", "name").agg(F.count("*").alias("n"))
    same = one_person(names).select(F.col("doc_id").alias("_d"), F.col("title").alias("_t"), F.col("name").alias("_n"), "as_name")
    rows = rows.join(same, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("title") == F.col("_t")) & (F.col("name") == F.col("_n")), "left")
    who = F.when(F.col("name").isNotNull(), F.struct(F.col("title").alias("title"), F.coalesce("as_name", "name").alias("name"), F.col("label").alias("label")))
    rows = rows.withColumn("who", who).drop("as_name", "title", "name", "label", "_d", "_t", "_n")
    order = [F.col("turn_no").asc_nulls_first(), F.col("_tie")]
    w = Window.partitionBy("doc_id", "_blk", "spoke").orderBy(*order)
    rows = rows.withColumn("_in", F.last("who", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("_rn", F.row_number().over(w)).withColumn("_before", F.lag("_in").over(w))
    blocks = rows.where("spoke").groupBy("doc_id", "_blk").agg(F.max_by("_in", "_rn").alias("_last"), F.count("*").alias("_n"))
    across = Window.partitionBy("doc_id").orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_carry", F.last("_last", ignorenulls=True).over(across)).withColumn("_had", F.coalesce(F.sum("_n").over(across), F.lit(0)))
    carried = blocks.select(F.col("doc_id").alias("_d"), F.col("_blk").alias("_b"), "_carry", "_had")
    rows = rows.join(carried, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_blk") == F.col("_b")), "left").drop("_d", "_b")
    # the first row of a block takes the speaker carried from earlier blocks
    rows = rows.withColumn("who", F.when(F.col("spoke"), F.coalesce("_in", "_carry"))).withColumn("_prev", F.coalesce("_before", "_carry"))
    key = lambda c: F.when(F.col(c).isNotNull(), F.struct(F.col(c)["title"], F.col(c)["name"]))
    goes_on = ((F.col("_rn") > 1) | (F.col("_had") > 0)) & key("who").eqNullSafe(key("_prev"))
    return rows.withColumn("begins", F.col("spoke") & ~goes_on).drop("_in", "_before", "_carry", "_had", "_rn", "_prev")


def _island_ids(rows: DataFrame) -> DataFrame:
    """``turn_id``: the number of clean turns begun in the document so far; blocks carry their sums."""
    w = Window.partitionBy("doc_id", "_blk").orderBy(F.col("turn_no").asc_nulls_first(), "_tie").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_in", F.sum(F.col("begins").cast("long")).over(w))
    sums = rows.groupBy("doc_id", "_blk").agg(F.sum(F.col("begins").cast("long")).alias("_n"))
    across = Window.partitionBy("doc_id").orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("doc_id").alias("_d"), F.col("_blk").alias("_b"), F.coalesce(F.sum("_n").over(across), F.lit(0)).alias("_carry"))
    rows = rows.join(sums, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_blk") == F.col("_b")), "left")
    return rows.withColumn("turn_id", F.col("_in") + F.col("_carry")).drop("_in", "_carry", "_d", "_b")


def clean_turns(rows: DataFrame) -> DataFrame:
    """One row per clean turn: doc_id, turn_id (from 1, in order), speaker, text, first_turn_no, page_start, page_end, n_rows.

    ``speaker`` is the label of the turn's first row, without marks; null while nobody has been named. For the rest see
    :func:`marked_turns`.
    """
    ids = _island_ids(marked_turns(rows).where("spoke"))
    grouped = ids.groupBy("doc_id", "turn_id").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("turn_no", F.lit(-(2**62))).alias("o"), F.col("_tie").alias("t"), F.col("words").alias("w"), F.col("who")["label"].alias("l")))).alias("parts"),
        F.min("turn_no").alias("first_turn_no"), F.min("page_start").alias("page_start"), F.max("page_end").alias("page_end"), F.count("*").alias("n_rows"),
    )
    return grouped.select("doc_id", "turn_id", F.col("parts")[0]["l"].alias("speaker"), F.array_join(F.col("parts")["w"], " ").alias("text"), "first_turn_no", "page_start", "page_end", "n_rows")


def caption_rows(cues: DataFrame) -> DataFrame:
    """Cues in the shape of transcript rows, so that labels and noise in captions are handled alike."""
    joined = F.trim(F.regexp_replace(F.array_join("lines", " "), r"<[^>]*>", ""))
    return cues.select("doc_id", F.col("pos").alias("turn_no"), F.lit(None).cast("string").alias("speaker"), joined.alias("text"), F.lit(None).cast("int").alias("page_start"), F.lit(None).cast("int").alias("page_end"))


def p4_found(spark: SparkSession, directory: str) -> DataFrame:
    rows = marked_turns(table(spark, directory, "turns"), keep_words=False)
    return rows.where(~F.col("begins")).select("doc_id", "turn_no").distinct()


def p4_turns(spark: SparkSession, directory: str) -> DataFrame:
    return clean_turns(table(spark, directory, "turns"))


def p4_caption_turns(spark: SparkSession, directory: str) -> DataFrame:
    return clean_turns(caption_rows(table(spark, directory, "cues")))

