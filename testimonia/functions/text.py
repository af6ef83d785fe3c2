"""Scalar text functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Honorifics and ranks that carry no name.
TITLE_TOKENS = "ADV ADVOCATE MR MRS MS MISS DR PROF JUSTICE JUDGE MINISTER GENERAL GEN LT-GEN MAJ-GEN BRIG COL CAPT MAJ SGT SERGEANT CONST W/O LIEUTENANT THE SC ISC".split()
# Labels of the bench.
BENCH = ["CHAIRPERSON", "COMMISSIONER", "THE CHAIRPERSON", "THE COMMISSIONER"]
# Verbs that report speech.
REPORTED_VERBS = (
    "stated testified alleged said told claimed denied confirmed clarified explained described recounted maintained submitted argued suggested "
    "asserted indicated conceded agreed disputed responded answered estimated recalled reported"
).split()
# Substrings that decide the stance of a predicate, tested in this order.
STANCES = {
    "deny": ["denied", "denies", "disputed", "rejected", "vehemently"],
    "question": ["asked", "whether", "questioned", "put to", "do you", "did you", "you say", "correct?"],
    "assert": ["stated", "testified", "said", "confirmed", "alleged", "claimed", "maintained", "described", "indicated", "accepted", "conceded", "agreed"],
}
# Lines of layout: a number alone, the running header, a page mark.
FURNITURE = [r"^\s*\d{1,3}\s*$", r"^\s*\d{1,2}\s+[A-Z]+\s+\d{4}\s*[–-]\s*DAY\s+\d+\s*$", r"(?i)^\s*Page\s+\d+\s+of\s+\d+\s*$"]
# Lines that are layout where two publications of one sitting are compared.
LAYOUT = r"^Page \d+ of \d+$|^\d{1,3}$|–\s*DAY \d+\s*$"
# The forms of a speaker's label in running text: a title and capitals, a role, a heading of examination.
_TITLE = r"(?:ADVOCATE|ADV|MRS|MR|MISS|MS|DR|PROF|LT[-\s]?GEN|MAJ[-\s]?GEN|BRIG|GENERAL|GEN|COL|CAPT|MAJ|SGT|CONST|W/O|LIEUTENANT)"
_ROLE = r"(?:THE\s+)?(?:CHAIRPERSON|COMMISSIONER|WITNESS|INTERPRETER|REGISTRAR)"
_HEADING = r"(?:CROSS[-\s]?|RE[-\s]?)?EXAMINATION(?:\s+IN\s+CHIEF)?\s+BY\s+[A-Z][A-Z .'\-]*?(?:\s*\(CONTINUES?\))?"
LABEL = rf"{_TITLE}\s+[A-Z][A-Z .'\-]*?|{_ROLE}|{_HEADING}"
LABEL_PATTERN = rf"(?:^|(?<=\s))({LABEL})\s*:\s"
# A role with a surname, which is no label to the detector above.
ROLE_SURNAME_PATTERN = r"(?:^|(?<=\s))((?:COMMISSIONER|CHAIRPERSON|WITNESS|INTERPRETER|REGISTRAR)\s+[A-Z][A-Z .'\-]*?)\s*:\s"
# What makes a claim strong.
STRONG = r"(?i)\b(deni|paid|pay|fund|own|met|meet|arrang|instruct|bribe|appoint|award|sign|interdict|kill|threat|influenc|corrupt|recruit|assist|transfer)"
# Words of allegation.
ALLEGATION = r"(?i)\b(stated|testified|alleged|allegation|said|told|instructed|claimed|denied|reported|accused|according to)\b"
WORD = r"(?U)\b[\w'-]+\b"


def normalise(s: Column) -> Column:
    """Upper case; other signs than letters, figures and hyphens become blanks; single blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.upper(s), r"[^A-Z0-9\- ]+", " "), r"\s+", " "))


def loose(s: Column) -> Column:
    """As :func:`normalise`, but hyphens go too and null is empty."""
    return F.trim(F.regexp_replace(F.upper(F.coalesce(s, F.lit(""))), r"[^A-Z0-9]+", " "))


def strip_titles(normalised: Column) -> Column:
    titles = F.array(*[F.lit(t) for t in TITLE_TOKENS])
    return F.array_join(F.filter(F.split(normalised, " "), lambda x: (x != "") & ~F.array_contains(titles, x)), " ")


def word_count(s: Column) -> Column:
    return F.regexp_count(s, F.lit(WORD))


def is_furniture(line: Column) -> Column:
    t = F.trim(line)
    out = t == ""
    for p in FURNITURE:
        out = out | t.rlike(p)
    return out


def is_bench(label: Column) -> Column:
    out = F.lit(False)
    for b in BENCH:
        out = out | label.startswith(b)
    return out


def is_senior_counsel(label: Column) -> Column:
    return label.rlike(r"\bSC\b")


def modality(predicate: Column) -> Column:
    p = F.lower(F.coalesce(predicate, F.lit("")))
    out = F.lit("other")
    for name, keys in reversed(STANCES.items()):
        hit = F.lit(False)
        for k in keys:
            hit = hit | p.contains(k)
        out = F.when(hit, F.lit(name)).otherwise(out)
    return out


def structurally_asserted(speaker: Column, predicate: Column) -> Column:
    """Nobody is named as speaker, or none of the first four words reports speech."""
    head = F.slice(F.split(F.lower(F.trim(predicate)), r"\s+"), 1, 4)
    return (F.trim(F.coalesce(speaker, F.lit(""))) == "") | ~F.arrays_overlap(head, F.array(*[F.lit(v) for v in REPORTED_VERBS]))


def claim_key(chunk: Column, speaker: Column, predicate: Column, start: Column, end: Column) -> Column:
    norm = F.regexp_replace(F.lower(F.trim(predicate)), r"\s+", " ")
    return F.sha2(F.concat(chunk, F.lit("|"), speaker, F.lit("|"), norm, F.lit("|"), start.cast("string"), F.lit(":"), end.cast("string")), 256)


def chunk_id(document: Column, index: Column, text: Column) -> Column:
    return F.sha2(F.concat(document, F.lit(":"), index.cast("string"), F.lit(":"), text), 256)


def judge_key(chunk: Column, arm: str, *parts: Column) -> Column:
    """The passage's first 32 characters, the arm, and 16 of the hash of what is judged; a null part is an empty one."""
    body = F.concat(F.lit('["'), F.concat_ws('","', *[F.coalesce(p, F.lit("")) for p in parts]), F.lit('"]'))
    return F.concat(F.substring(chunk, 1, 32), F.lit(f"__{arm}__"), F.substring(F.sha2(body, 256), 1, 16))


def hearing_key(slug: Column, day: Column, date: Column) -> Column:
    known = day.isNotNull() & (F.coalesce(date, F.lit("")) != "")
    return F.when(known, F.concat(slug, F.lit("-day-"), day.cast("string"), F.lit("-"), date)).otherwise(F.concat(slug, F.lit("-unknown")))


def point_id(name: Column) -> Column:
    """Name-based UUID (version 5) in the URL namespace."""
    h = F.sha1(F.concat(F.unhex(F.lit("6ba7b8119dad11d180b400c04fd430c8")), F.encode(name, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(F.lit(3)).bitwiseOR(F.lit(8))))
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12))


def day_list(s: Column) -> Column:
    """Whole numbers of a list separated by commas; blanks between commas are passed over."""
    return F.transform(F.filter(F.split(s, ","), lambda x: F.trim(x) != ""), lambda x: F.trim(x).cast("int"))


def strict_fault(json: Column, fields: list[str]) -> Column:
    """ok, or what is wrong with an answer that must be a JSON object with these fields and no others."""
    keys = F.json_object_keys(json)
    known = F.array(*[F.lit(f) for f in fields])
    return F.when(keys.isNull(), "no JSON").when(F.size(F.array_except(keys, known)) > 0, "unknown field").when(F.size(F.array_except(known, keys)) > 0, "missing field").otherwise("ok")


def prompt_head(day: Column, date: Column, first: Column, last: Column, speakers: Column) -> Column:
    """What a passage's provenance says above its text; what is not known is None."""
    s = lambda c: F.coalesce(c.cast("string"), F.lit("None"))
    return F.concat(F.lit("Hearing day "), s(day), F.lit(" ("), s(date), F.lit("), pages "), s(first), F.lit("-"), s(last), F.lit(". Speakers: "), F.coalesce(F.array_join(speakers, ", "), F.lit("")), F.lit("."))


def clipped(s: Column, limit: int) -> Column:
    """Blanks collapsed; a longer text is cut hard and marked. Null is empty."""
    t = F.trim(F.regexp_replace(F.coalesce(s, F.lit("")), r"(?U)\s+", " "))
    return F.when(F.length(t) > limit, F.concat(F.substring(t, 1, limit), F.lit("…"))).otherwise(t)


def snippet(s: Column, width: int) -> Column:
    """Blanks collapsed; a longer text is cut between words so that it and " …" have at most ``width`` characters."""
    t = F.trim(F.regexp_replace(s, r"(?U)\s+", " "))
    head = F.regexp_extract(F.concat(F.substring(t, 1, width - 1), F.lit("")), r"^(.*)\s", 1)
    return F.when(F.length(t) <= width, t).otherwise(F.trim(F.concat(head, F.lit(" …"))))


def normalise_label(s: Column) -> Column:
    """A label with single blanks; a heading gives the counsel's name; hyphens without blanks; compound ranks hyphenated."""
    t = F.trim(F.regexp_replace(s, r"\s+", " "))
    heading = r"^(?:CROSS[- ]?|RE[- ]?)?EXAMINATION(?:\s+IN\s+CHIEF)?\s+BY\s+(.*?)(?:\s*\(CONTINUES?\))?$"
    t = F.when(t.rlike(heading), F.trim(F.regexp_extract(t, heading, 1))).otherwise(t)
    t = F.regexp_replace(t, r"\s*-\s*", "-")
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"\bLT GEN\b", "LT-GEN"), r"\bMAJ GEN\b", "MAJ-GEN"))


def cue_line(s: Column) -> Column:
    """A caption line without tags, single blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(s, "<[^>]+>", ""), r"\s+", " "))


def is_layout(line: Column) -> Column:
    return F.trim(line).rlike(LAYOUT)


def predicate_pronoun(predicate: Column) -> Column:
    """Whether a verb that reports speech is followed by a pronoun."""
    return predicate.rlike(r"(?i)\b(?:" + "|".join(REPORTED_VERBS) + r")\b\s+(?:that\s+)?(he|she|they|it|his|her|their)\b")


def claim_strength(predicate: Column) -> Column:
    """2 for a strong word, and up to 1 for the length."""
    return F.when(predicate.rlike(STRONG), 2.0).otherwise(0.0) + F.least(F.length(predicate), F.lit(140)) / 140


def quote_span(text: Column, quote: Column) -> tuple[Column, Column]:
    """(start, end) of a quote in a text, from 0; if it is not there letter by letter, with its blanks as any white space; else null.

    A single blank of the quote stands for one sign of white space, a line feed or tab for a run of them.
    """
    at = F.call_function("locate", quote, text)
    escaped = F.regexp_replace(quote, r"([\\.\[\]{}()*+?^$|#&~-])", r"\\$1")
    pattern = F.regexp_replace(F.regexp_replace(escaped, " ", r"\\s"), r"[\n\t\r\x0b\f]+", r"\\s+")
    found = F.when((at == 0) & quote.rlike(r"\s"), F.regexp_substr(text, pattern))
    again = F.when(found.isNotNull(), F.call_function("locate", found, text))
    start = F.when(at > 0, at - 1).otherwise(again - 1)
    return start, F.when(at > 0, at - 1 + F.length(quote)).otherwise(again - 1 + F.length(found))


# Prices in dollars for a million tokens of input and output.
PRICES = {"large": (5.0, 25.0), "medium": (3.0, 15.0), "small": (1.0, 5.0)}


def cost_usd(usage: dict[str, Column], model: str) -> Column:
    """The cost of a call from its token counts (input, cache_write, cache_read, output); missing counts are 0."""
    a, b = PRICES[model]
    n = lambda k: F.coalesce(usage[k], F.lit(0)) if k in usage else F.lit(0)
    return (n("input") * a + n("cache_write") * a * 1.25 + n("cache_read") * a * 0.1 + n("output") * b) / 1_000_000


def tokens_estimate(s: Column) -> Column:
    return F.greatest(F.lit(1), F.bround(F.length(s) / F.lit(3.6)).cast("long"))


def timestamp_seconds(s: Column) -> Column:
    """[H:]MM:SS.mmm in seconds, null for anything else."""
    p = r"^(?:(\d+):)?(\d{2}):(\d{2})[.](\d{3})$"
    g = lambda i: F.regexp_extract(s, p, i)
    value = F.coalesce(F.nullif(g(1), F.lit("")).cast("int"), F.lit(0)) * 3600 + F.try_to_number(g(2), F.lit("99")) * 60 + F.try_to_number(g(3), F.lit("99")) + F.try_to_number(g(4), F.lit("999")) / 1000
    return F.when(s.rlike(p), value.cast("double"))
