"""Variant spellings of names, linked to the entities they mean.

Each distinct writing is brought to a few comparable forms (title and surname, initial and surname, given name and
surname, the whole writing for aliases, words of an organisation in several orders). Forms that equal a form of an entity
are found by a hash join; names of bodies with shortened words by a join of their words' first letters, confirmed word by word.
The others go through a pigeonhole join: a form of an entity is cut into three segments, one of which survives any
single slip (a letter more, less or another, or two exchanged), so that substrings of the writing, shifted by at most
one place, find it in an inverted index of segments; a banded edit distance verifies what is found.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from testimonia.sources.shared import written
from testimonia.llm.speakers import TITLES
from testimonia.sources.tables import table

SEGMENTS = 3
#: Entity forms up to this number are broadcast, their number being counted first; more are shuffled.
BROADCAST_FORMS = 300_000
# Words that may be left out of a name of a body, and legal forms.
FILLERS = frozenset("the of for and & pty proprietary ltd limited inc plc cc npc".split())
_TITLE = re.compile(r"^(" + "|".join(sorted((re.escape(t).replace(r"\-", r"\.?[\s-]+") for t in [*TITLES, "LT-GENERAL", "MAJ-GENERAL", "LIEUTENANT-GEN", "MAJOR-GEN", "LTGEN", "MAJGEN"]), key=len, reverse=True)) + r")\b\.?\s*", re.I)
_SPLIT = re.compile(r"[^\w&]+|_+")


def plain(text: str) -> str:
    """Lower case, without accents; every white space one blank; quotes plain."""
    text = unicodedata.normalize("NFKD", text.replace("’", "'").replace("‘", "'"))
    return " ".join("".join(c for c in text if not unicodedata.combining(c)).lower().split())


def short_title(word: str) -> str:
    w = re.sub(r"[\s.-]+", "-", word.upper().strip()).strip("-")
    w = {"LT-GENERAL": "LT-GEN", "LIEUTENANT-GEN": "LT-GEN", "MAJ-GENERAL": "MAJ-GEN", "MAJOR-GEN": "MAJ-GEN", "LTGEN": "LT-GEN", "MAJGEN": "MAJ-GEN"}.get(w, w)
    return TITLES.get(w, w)


def bare(text: str) -> str:
    """Without quotes, possessive, punctuation at the ends and blanks around hyphens."""
    t = re.sub(r"'s$", "", plain(text).strip(" ,;:\"'"))
    return re.sub(r"\s*-\s+|\s+-\s*", "-", t.strip(" ,;:\"'"))


def alias_forms(text: str) -> list[tuple[str, str, str, str]]:
    """The whole writing, title included, as written and with a part after a comma first; ``fixed`` is the first word."""
    parts = [p.strip() for p in bare(text).split(",") if p.strip()]
    out = []
    for order in (parts, parts[::-1]) if len(parts) == 2 else (parts,):
        words = [w for p in order for w in _SPLIT.split(p.replace("-", "").replace("'", "")) if w]
        if words:
            out.append(("alias", "", words[0], "".join(words)))
    return out


def person_forms(text: str) -> list[tuple[str, str, str, str]]:
    """(kind, title, fixed, key) of a person's name as written: ``fixed`` must agree exactly, but for a given name, ``key`` may have a slip."""
    t = bare(text)
    title = ""
    parts = [p.strip() for p in t.split(",") if p.strip()]
    if len(parts) == 2 and parts[1] in ("sc",):
        parts = parts[:1]
    for i, p in enumerate(parts):
        if m := _TITLE.match(p):
            if m.end() < len(p) or i > 0:
                title, parts[i] = short_title(m[1]), p[m.end() :]
    swapped = len(parts) == 2 and bool(parts[1] or title)
    words = [w for p in (reversed(parts) if swapped else parts) for w in _SPLIT.split(p.replace("-", "").replace("'", "")) if w]
    if len(words) > 1 and words[-1] == "sc":
        words.pop()
    if not words:
        return []
    out: list[tuple[str, str, str, str]] = []
    joined = "".join(words)
    if len(words) > 1 and len(words[0]) == 1:
        out.append(("init", title, words[0], "".join(words[1:])))
    elif len(words) > 1 and len(words[-1]) == 1:
        out.append(("init", title, words[-1], "".join(words[:-1])))
    else:
        if len(words) > 1:
            out.append(("full", title, words[0], joined))
            if not swapped:
                out.append(("full", title, words[-1], words[-1] + "".join(words[:-1])))
        out.append(("title", title, title, joined) if title else ("bare", "", "", joined))
    out += [(kind, title, fixed, key) for kind, _, fixed, key in alias_forms(text)]
    return out


def body_words(text: str) -> list[str]:
    t = bare(text)
    parts = [p.strip() for p in t.split(",") if p.strip()]
    if len(parts) == 2:
        t = parts[1] + " " + parts[0]
    words = [w for w in _SPLIT.split(re.sub(r"(?<=\w)\.(?=\w\.)", "", t.replace("-", "").replace("'", ""))) if w]
    return [w for w in words if w not in FILLERS]


def initials(words: list[str]) -> str:
    return "".join(w[0] for w in words)


def body_forms(text: str) -> list[tuple[str, str, str, str]]:
    words = body_words(text)
    if not words:
        return []
    out = [("org", "", "", "".join(words))]
    if len(words) > 1:
        out.append(("short", "", initials(words), " ".join(words)))
    short = re.sub(r"^the ", "", bare(text)).replace(".", "").replace(" ", "")
    if short.isalnum() and 2 <= len(short) <= 8:
        out.append(("acronym", "", short, ""))
    return out


def place_forms(text: str) -> list[tuple[str, str, str, str]]:
    key = "".join(w for w in _SPLIT.split(bare(text).replace("-", "")) if w and w != "the")
    return [("place", "", "", key)] if key else []


FORMS = {"person": person_forms, "org": body_forms, "acronym": body_forms, "place": place_forms, "role": place_forms}
FORM_SCHEMA = "kind string, title string, fixed string, key string"


def entity_forms(entities: list[dict]) -> list[tuple[str, str, str, str, str, str]]:
    """(entity_id, type, kind, title, fixed, key) of a batch of entities, with every short form that an alias of any of them shows."""
    nick: dict[str, set[str]] = {}
    people = []
    for e in entities:
        if e["entity_type"] != "person" or not e["name"]:
            continue
        t = bare(e["name"])
        m = _TITLE.match(t)
        words = [w for w in _SPLIT.split((t[m.end() :] if m else t).replace("-", "").replace("'", "")) if w]
        if len(words) > 1 and words[-1] == "sc":
            words.pop()
        if not words:
            continue
        given, surname = words[:-1], words[-1]
        people.append((e["entity_id"], short_title(m[1]) if m else "", given, surname))
        for a in e["aliases"] or []:
            aw = [w for w in _SPLIT.split(bare(a or "").replace("-", "").replace("'", "")) if w]
            if given and len(aw) == 2 and aw[1] == surname and not _TITLE.match(bare(a)):
                nick.setdefault(given[0], set()).add(aw[0])
    out = set()
    for i, title, given, surname in people:
        out.add((i, "person", "bare", title, "", surname))
        if title:
            out.add((i, "person", "title", title, title, surname))
        if given:
            out.add((i, "person", "init", title, given[0][0], surname))
            for g in {given[0], "".join(given), *nick.get(given[0], ())}:
                out.add((i, "person", "full", title, g, g + surname))
    # aliases as written that the name does not give, where one person has them; the others are found by the forms above
    have = {(i, kind, fixed, key) for i, _, kind, _, fixed, key in out}
    owners: dict[str, set[tuple[str, str]]] = {}
    for e in entities:
        for a in (e["aliases"] or []) if e["entity_type"] == "person" else []:
            for _, _, fixed, key in alias_forms(a or "")[:1]:
                given_by_name = any((e["entity_id"], k, f, x) in have for k, _, f, x in person_forms(a))
                owners.setdefault(key, set()).add((e["entity_id"], "" if given_by_name else fixed))
    for key, has in owners.items():
        if len({i for i, _ in has}) == 1:
            out.update((i, "person", "alias", "", fixed, key) for i, fixed in has if fixed)
    for e in entities:
        i, kind = e["entity_id"], e["entity_type"]
        names = [n for n in [e["name"], *(e["aliases"] or [])] if n and n.strip()]
        if kind in ("org", "acronym"):
            for n in names:
                w = body_words(n)
                orders = [w, *([[w[0], *w[2:], w[1]], [*w[2:], *w[:2]], w[1:], [*w[2:], w[1]]] if len(w) >= 4 else [])]
                for o in orders:
                    if o and (len(w) > 1 or not n.isupper()):
                        out.add((i, "org", "org", "", "", "".join(o)))
                    if len(o) > 1:
                        out.add((i, "org", "short", "", initials(o), " ".join(o)))
                short = bare(n).replace(".", "").replace(" ", "")
                if n.isupper() and short.isalnum() and 2 <= len(short) <= 8:
                    out.add((i, "org", "acronym", "", short, ""))
        elif kind in ("place", "role"):
            for n in names:
                out.update((i, kind, *f) for f in place_forms(n))
    return sorted(out)


def forms_of(writings: DataFrame) -> DataFrame:
    """Adds the forms of each ``writing`` of ``type``; writings without one come out without a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(t, w, *f) for t, w in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if w and t in FORMS for f in FORMS[t](w)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], ["type", "writing", "kind", "title", "fixed", "key"])

    return writings.select("type", "writing").mapInArrow(run, "type string, writing string, " + FORM_SCHEMA)


def _bounds(n: Column, i: int) -> tuple[Column, Column]:
    """Place (from 0) and length of segment i of a key of n characters."""
    a, b = F.floor(n * i / SEGMENTS).cast("int"), F.floor(n * (i + 1) / SEGMENTS).cast("int")
    return a, b - a


def segments(forms: DataFrame) -> DataFrame:
    """The inverted index: one row per segment of each entity form, under its length and number."""
    n = F.length("e_key")
    parts = [F.struct(F.lit(i).alias("seg"), F.col("e_key").substr(_bounds(n, i)[0] + 1, _bounds(n, i)[1]).alias("part")) for i in range(SEGMENTS)]
    return forms.where(n >= SEGMENTS).withColumn("e_len", n).withColumn("s", F.explode(F.array(*parts))).select("*", "s.seg", "s.part").drop("s")


def probes(forms: DataFrame) -> DataFrame:
    """The substrings with which a written form is looked up: for each length and segment, at the places a slip allows."""
    n = F.length("key")
    out = []
    for d in (-1, 0, 1):
        for i in range(SEGMENTS):
            a, size = _bounds(n + d, i)
            for shift in (-1, 0, 1):
                ok = (a + shift >= 0) & (a + shift + size <= n) & (size > 0)
                out.append(F.when(ok, F.struct((n + d).alias("e_len"), F.lit(i).alias("seg"), F.col("key").substr(a + shift + 1, size).alias("part"))))
    found = F.array_distinct(F.filter(F.array(*out), lambda x: x.isNotNull()))
    return forms.where(n >= SEGMENTS + 1).withColumn("s", F.explode(found)).select("*", "s.e_len", "s.seg", "s.part").drop("s")


def one_slip(a: Column, b: Column) -> Column:
    """0 or 1 if a and b are equal or one slip apart (also two adjacent letters exchanged), else null."""
    d = F.levenshtein(a, b, 2)
    swapped = F.exists(F.sequence(F.lit(1), F.length(b) - 1), lambda i: F.concat(F.substring(b, 1, i - 1), b.substr(i + 1, F.lit(1)), b.substr(i, F.lit(1)), b.substr(i + 2, F.length(b))) == a)
    return F.when(d.between(0, 1), d).when((d == 2) & (F.length(a) == F.length(b)) & (F.length(b) > 1) & swapped, F.lit(1))


def abbreviated(a: Column, b: Column) -> Column:
    """Slips (0 or 1) if every word of ``a`` is the word of ``b`` at its place or short for it, one word at most having a slip; else null.

    A word is short for another if it begins with its letter and its own letters, two at least, stand in the other one in
    their order. One word must be written in full.
    """
    letters = lambda x: F.sort_array(F.split(x, ""))
    short = lambda x, y: (F.length(x) >= 2) & (F.length(x) < F.length(y)) & F.call_function("rlike", y, F.concat(F.lit("^"), F.regexp_replace(x, "(.)", "$1.*")))
    slip = lambda x, y: (F.length(y) >= 4) & ((F.levenshtein(x, y, 1) >= 0) | ((F.length(x) == F.length(y)) & (F.levenshtein(x, y, 2) >= 0) & (letters(x) == letters(y))))
    x, y = F.split(a, " "), F.split(b, " ")
    # of each pair of words: 0 in full, 1 short, 2 with a slip, 9 another word
    kinds = F.zip_with(x, y, lambda p, q: F.when(p == q, 0).when(short(p, q), 1).when(slip(p, q), 2).otherwise(9))
    n = lambda k: F.size(F.filter(kinds, lambda v: v == k))
    return F.when((F.size(x) == F.size(y)) & (n(0) > 0) & (n(9) == 0) & (n(2) <= 1), n(2))


def resolve(writings: DataFrame, entities: DataFrame) -> DataFrame:
    """(type, writing, entity_id) of the distinct writings that mean one entity.

    ``writings``: type (person, org, place, role), writing. ``entities``: entity_id, name, entity_type, aliases. The
    forms with the fewest slips decide; a writing whose best forms belong to several entities (a shared surname) means
    none, and of equal ones an entity of the title written comes first. A known given name is not taken for a slip of
    another one. Null and blank writings, unknown types and names without letters mean none. Other columns are not read.
    """
    dim = entities.select("entity_id", "name", "entity_type", "aliases").where("entity_id is not null").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = entity_forms([r for b in batches for r in b.to_pylist()])
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], ["entity_id", "e_type", "e_kind", "e_title", "e_fixed", "e_key"])

    # the dimension of entities is one small, reviewed table; its nicknames are learnt from all of its aliases together
    e = written(dim.coalesce(1).mapInArrow(run, "entity_id string, e_type string, e_kind string, e_title string, e_fixed string, e_key string"), "forms")
    n_forms = e.count()
    hint = F.broadcast if n_forms <= BROADCAST_FORMS else (lambda x: x)
    wide = F.broadcast if n_forms * SEGMENTS <= BROADCAST_FORMS else (lambda x: x)  # the index has a row for each segment
    w = writings.select("type", "writing").where("writing is not null and trim(writing) <> ''").distinct()
    forms = written(forms_of(w), "writings")
    same = (F.col("type") == F.col("e_type")) & (F.col("kind") == F.col("e_kind")) & (F.col("fixed") == F.col("e_fixed"))
    cols = ["type", "writing", "title", "entity_id", "e_title"]
    loose = "kind in ('full', 'alias')"  # the first word may have the slip
    full_ok = (F.col("kind") == F.col("e_kind")) & (F.col("type") == F.col("e_type"))
    exact_named = forms.where(f"not {loose} and kind <> 'short'").join(hint(e), same & (F.col("key") == F.col("e_key")))
    exact_full = forms.where(loose).join(hint(e.where(f"e_{loose}")), full_ok & (F.col("key") == F.col("e_key")))
    equal = exact_named.select(*cols).unionByName(exact_full.select(*cols)).withColumn("slips", F.lit(0))
    # shortened words: bodies whose words begin with the same letters, confirmed word by word
    shorter = forms.where("kind = 'short'").join(hint(e.where("e_kind = 'short'")), same).withColumn("slips", abbreviated(F.col("key"), F.col("e_key"))).where("slips is not null")
    exact = written(equal.unionByName(shorter.select(*cols, "slips")).distinct(), "exact")
    rest = forms.where("kind <> 'short'").join(exact.select("type", "writing").distinct(), ["type", "writing"], "left_anti")
    index = segments(e.where("e_kind not in ('acronym', 'short')"))
    hit = probes(rest).join(wide(index), ["e_len", "seg", "part"])
    hit = hit.where((F.col("type") == F.col("e_type")) & (F.col("kind") == F.col("e_kind")) & (F.expr(loose) | (F.col("fixed") == F.col("e_fixed"))))
    hit = hit.select(*cols, "kind", "fixed", "key", "e_fixed", "e_key").distinct().withColumn("slips", one_slip(F.col("key"), F.col("e_key"))).where("slips is not null")
    known = e.where("e_kind = 'full'").select(F.col("e_fixed").alias("known")).distinct()
    other = F.expr(loose) & (F.col("fixed") != F.col("e_fixed"))
    hit = hit.join(hint(known), F.col("fixed") == F.col("known"), "left").where(~(other & F.col("known").isNotNull()))
    # in an alias, a title or an initial is no slip of another one
    head = lambda c: (F.length(c) < 2) | F.upper(c).isin(sorted(TITLES))
    hit = hit.where(~((F.col("kind") == "alias") & (F.col("fixed") != F.col("e_fixed")) & (head("fixed") | head("e_fixed"))))
    found = exact.unionByName(hit.select(*cols, "slips").distinct())
    fits = ((F.col("title") != "") & (F.col("title") == F.col("e_title"))).cast("int")
    level = F.struct(F.col("slips"), (-fits).alias("f"))
    found = found.withColumn("_level", level).groupBy("type", "writing").agg(F.min_by(F.struct("entity_id"), "_level").alias("one"), F.min("_level").alias("_best"), F.collect_set(F.struct("_level", "entity_id")).alias("all"))
    ids = F.array_distinct(F.transform(F.filter("all", lambda x: x["_level"] == F.col("_best")), lambda x: x["entity_id"]))
    return found.withColumn("ids", ids).where(F.size("ids") == 1).select("type", "writing", F.col("ids")[0].alias("entity_id"))


def p6_found(spark: SparkSession, directory: str) -> DataFrame:
    s = table(spark, directory, "surfaces").select(F.lit("surfaces").alias("rec_table"), F.col("surface_id").cast("string").alias("rec_key"), F.lower("entity_type").alias("type"), F.col("surface").alias("writing"))
    c = table(spark, directory, "claims").select(F.lit("claims").alias("rec_table"), F.col("claim_id").alias("rec_key"), F.lit("person").alias("type"), F.col("speaker").alias("writing"))
    # a claim does not say what kind of speaker it has
    kinds = c.drop("type").withColumn("type", F.explode(F.array(*[F.lit(k) for k in ("person", "org", "place", "role")])))
    rows = s.unionByName(kinds)
    return rows.join(resolve(rows, table(spark, directory, "entities")), ["type", "writing"]).select("rec_table", "rec_key", "entity_id").distinct()
