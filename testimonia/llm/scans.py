"""Text from scanned pages: page furniture, words cut at line ends, misread characters.

Furniture is found by evidence: a line near the edge of a page whose folded form (figures and confusable letters in
one class) stands near the edge on most pages of the documents that have it. Words are counted over all running lines.
A rare word and the frequent word that it was before the scanner confused some letters differ by one of a few fixed
anagram-hash differences, so an equality join of hashes finds the pairs and an exact replacement test confirms them.
A line-end hyphen is a cut if the joined word is written elsewhere at least as often as the hyphened one.

The same evidence repairs the text: furniture goes, cut words are joined, misread words get the most frequent right form,
and lines become paragraphs that go on across pages, each with the offsets at which its pages begin.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from testimonia.operators.ordered import following, with_block
from testimonia.sources.shared import written
from testimonia.sources.tables import table

#: Lines from the top and from the bottom of a page that can be furniture by their repetition.
EDGE = 3
#: Known furniture forms up to this number are broadcast, being counted first; beyond it they are joined by shuffle.
BROADCAST_FORMS = 200_000
#: Words that are known to be right, the most frequent ones; they only spare lookups, so the bound changes no result.
KNOWN_WORDS = 20_000
#: A misread word without figures or signs must be this many times rarer than the right one.
RATIO = 12
# What a scanner writes for what stood there.
CONFUSIONS = [
    ("rn", "m"), ("m", "rn"), ("vv", "w"), ("w", "vv"), ("ii", "u"), ("u", "ii"), ("cl", "d"), ("d", "cl"), ("ri", "n"), ("n", "ri"), ("li", "h"), ("h", "li"),
    ("h", "ti"), ("ti", "h"), ("c", "e"), ("e", "c"), ("f", "t"), ("t", "f"), ("b", "h"), ("h", "b"), ("l", "i"), ("i", "l"), ("nn", "m"), ("in", "m"),
    ("0", "o"), ("1", "l"), ("1", "i"), ("5", "s"), ("9", "g"), ("6", "b"), ("8", "b"), ("6", "g"), ("3", "e"), ("4", "a"), ("2", "z"), ("7", "t"),
    ("@", "a"), ("!", "i"), ("!", "l"), ("|", "l"), ("|", "i"),
]
# Signs that end the first part of a cut word: hyphen-minus, soft hyphen, not sign, hyphen, non-breaking hyphen.
HYPHENS = "-­¬‐‑"
WORD = r"[\p{L}\p{N}@|!]+(?:['’-][\p{L}\p{N}@|!]+)*"
WORD_PY = r"(?:[^\W_]|[@|!])+(?:['’-](?:[^\W_]|[@|!])+)*"
_FIGURES = r"[0-9OoDQIl|!]"


_FOLD = str.maketrans({**{c: "#" for c in "0123456789oqdil|!szubgh"}, **{c: "e" for c in "cft"}, "@": "a", **{c: None for c in " \t\r -–—.,:;/()"}})
_NUMBER = re.compile(rf"[\s\-–—.]*{_FIGURES}{{1,4}}[\s\-–—.]*|\s*{_FIGURES}{{1,4}}\s*/\s*{_FIGURES}{{1,4}}\s*")
_NO_NUMBER = re.compile(r"\s*(?:O|o|Do|DO|oo|I\.|Do\.)\s*")
_DECODE = str.maketrans("OoDQIl|!", "00001111")
_HEAD, _TAIL, _REST = re.compile(rf"({WORD_PY})[{HYPHENS}]$"), re.compile(rf"\s*({WORD_PY})"), re.compile(r"\s*\S+")


# the same for lines of ASCII signs, as a table of bytes
_FOLD_BYTES = bytes(ord(_FOLD[i]) if isinstance(_FOLD.get(i), str) else i for i in range(256))
_FOLD_GONE = bytes(i for i in range(128) if i in _FOLD and _FOLD[i] is None)


def fold(line: str) -> str:
    """The line in a form in which scanning errors, numbers, spaces and punctuation make no difference."""
    s = line.lower().replace("rn", "m").replace("ri", "n").replace("vv", "w").replace("cl", "d").replace("ti", "h").replace("fi", "h")
    s = s.encode().translate(_FOLD_BYTES, _FOLD_GONE).decode() if s.isascii() else s.translate(_FOLD)
    while "##" in s:
        s = s.replace("##", "#")
    return s


def numbered_lines(text: str) -> list[tuple[int, str]]:
    """The non-blank lines of a page, without white space at the right, with their numbers from 1."""
    return [(i, s) for i, x in enumerate(text.split("\n"), 1) if (s := x.rstrip())]


def edge_lines(text: str) -> list[tuple[int, str]]:
    """The first EDGE and the last EDGE of the non-blank lines, with their numbers."""
    lines = text.split("\n")
    top: list[tuple[int, str]] = []
    for i, x in enumerate(lines, 1):
        if x and not x.isspace():
            top.append((i, x))
            if len(top) == EDGE:
                break
    end, low = (top[-1][0] if top else 0), []
    for i in range(len(lines), end, -1):
        x = lines[i - 1]
        if x and not x.isspace():
            low.append((i, x))
            if len(low) == EDGE:
                break
    return top + low[::-1]


class _Forms(dict):
    """Hashes of folded lines, None for a number alone; running heads come again and again."""

    def __missing__(self, line: str) -> int | None:
        import xxhash

        if len(self) > 50_000:
            self.clear()
        f = fold(line)
        self[line] = h = xxhash.xxh64_intdigest(f) - (1 << 63) if len(f) > 1 else None
        return h


_forms = _Forms()


def edge_forms(near: list[tuple[int, str]]) -> list[tuple[int, int]]:
    """(line number, hash of its folded form) of edge lines; lines that are a number alone have no form."""
    return [(no, f) for no, x in near if (f := _forms[x]) is not None]


def furniture_numbers(lines: list[tuple[int, str]], near: set[int], page_no: int | None) -> list[int]:
    """Numbers of pages near an edge, and of lines, in tens, anywhere; also if their figures are misread as letters."""
    out = []
    for no, x in lines:
        if len(x) < 24 and _NUMBER.fullmatch(x) and not _NO_NUMBER.fullmatch(x):
            lone = x.strip() == "I"
            figures = "".join(c for c in x if c in "0123456789OoDQIl|!").translate(_DECODE)
            if (no in near and (not lone or page_no == 1)) or (len(figures) == 2 and figures[1] == "0" and figures[0] != "0" and not lone):
                out.append(no)
    return out


def is_open(line: str) -> bool:
    """Whether the line ends in a letter and a hyphen."""
    return len(line) > 1 and line[-1] in HYPHENS and line[-2].isalpha()


def page_body(text: str, page_no: int | None, known) -> tuple[list[int], list[tuple[int, str]]]:
    """(numbers of furniture lines, running lines); ``known`` says whether a form is furniture."""
    lines, near = numbered_lines(text), edge_lines(text)
    gone = {no for no, f in edge_forms(near) if known(no, f)}
    gone.update(furniture_numbers(lines, {no for no, _ in near}, page_no))
    return sorted(gone), [(no, x) for no, x in lines if no not in gone]


def furniture_forms(pages: DataFrame) -> DataFrame:
    """``form``: hashes of folded lines that stand near the edge on most pages of documents of three pages or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            texts = b.column(2).to_pylist()
            forms = [sorted({f for _, f in edge_forms(edge_lines(t))}) for t in texts]
            prints = [xxhash.xxh64_intdigest(t) - (1 << 63) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(prints, pa.int64()), pa.array(forms, pa.list_(pa.int64()))], ["doc_id", "page_no", "print", "f"])

    e = pages.select("doc_id", F.col("page_no").cast("long").alias("page_no"), "text").where("text is not null").mapInArrow(run, "doc_id string, page_no long, print long, f array<bigint>")
    e = e.dropDuplicates(["doc_id", "page_no", "print"])
    # one aggregate gives both: the number of a document's pages stands under a null form
    per_doc = e.where("size(f) > 0").select("doc_id", F.explode(F.concat("f", F.array(F.lit(None).cast("long")))).alias("form")).groupBy("doc_id", "form").agg(F.count("*").alias("n"))
    sizes = per_doc.where("form is null and n >= 3").select("doc_id", F.col("n").alias("n_pages"))
    many = per_doc.where("form is not null").join(sizes, "doc_id")
    forms = many.groupBy("form").agg(F.sum("n").alias("n"), F.sum("n_pages").alias("of"))
    return forms.where("n >= 4 and n >= 0.5 * of").select("form")


def with_known_edges(pages: DataFrame, source: DataFrame) -> tuple[DataFrame, object]:
    """Pages with ``known`` (line numbers known to be furniture, or null), and the known forms if they are few enough to be sent."""
    forms = written(furniture_forms(source), "forms")
    if forms.count() <= BROADCAST_FORMS:
        return pages.withColumn("known", F.lit(None).cast("array<int>")), pages.sparkSession.sparkContext.broadcast({r[0] for r in forms.collect()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(d, p, no, f) for d, p, t in zip(*(b.column(i).to_pylist() for i in range(3))) for no, f in edge_forms(edge_lines(t))]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int32(), pa.int32(), pa.int64()))], ["_d", "_p", "no", "form"])

    edges = pages.select("doc_id", "page_no", "text").mapInArrow(run, "_d string, _p int, no int, form long").join(forms, "form", "left_semi")
    known = edges.groupBy("_d", "_p").agg(F.collect_set("no").alias("known"))
    return pages.join(known, F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("page_no").eqNullSafe(F.col("_p")), "left").drop("_d", "_p"), None


def _known_of(row_known, forms):
    """The test for :func:`page_body`, from the forms sent or from the row's own numbers."""
    if forms is not None:
        return lambda no, f: f in forms
    numbers = set(row_known or ())
    return lambda no, f: no in numbers


BODY = "doc_id string, page_no long, furniture array<int>, nos array<int>, lines string, cuts array<struct<no:int,head:string,tail:string>>, first string"


def running_pages(pages: DataFrame, keep_raw: bool = False) -> DataFrame:
    """Per page: furniture (line numbers); nos and lines, the running lines (one string, split at line
    feeds), in lower case and without words cut by their start or end; cuts, the cut words (tail null where the page ends);
    first, the first running word; with ``keep_raw`` also raw, the running lines as they are."""
    pages, sent = with_known_edges(distinct_pages(pages), pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forms = sent.value if sent is not None else None
        for b in batches:
            out = []
            for d, p, t, k in zip(*(b.column(i).to_pylist() for i in range(4))):
                gone, body = page_body(t, p, _known_of(k, forms))
                nos, lines, cuts = [], [], []
                goes_on = True  # the first line of a page may begin with the rest of a word of the page before
                for i, (no, x) in enumerate(body):
                    x = x.lower()
                    now = x
                    if goes_on:
                        now = _REST.sub("", now, count=1)
                    goes_on = is_open(x)
                    if goes_on:
                        now = now[: now.rfind(" ") + 1]
                        if m := _HEAD.search(x):
                            tail = _TAIL.match(body[i + 1][1].lower()) if i + 1 < len(body) else None
                            if i + 1 == len(body) or tail:
                                cuts.append({"no": no, "head": m[1], "tail": tail[1] if tail else None})
                    nos.append(no)
                    lines.append(now)
                first = _TAIL.match(body[0][1].lower()) if body else None
                out.append((d, p, gone, nos, "\n".join(lines), cuts, first[1] if first else None, *(["\n".join(x for _, x in body)] if keep_raw else [])))
            if out:
                types = (pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.string(), pa.list_(pa.struct([("no", pa.int32()), ("head", pa.string()), ("tail", pa.string())])), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["doc_id", "page_no", "furniture", "nos", "lines", "cuts", "first", *(["raw"] if keep_raw else [])])

    return pages.select("doc_id", "page_no", "text", "known").mapInArrow(run, BODY + (", raw string" if keep_raw else ""))


def word_counts(body: DataFrame) -> DataFrame:
    words = body.select(F.explode(F.regexp_extract_all("lines", F.lit(WORD), F.lit(0))).alias("w"))
    return words.groupBy("w").agg(F.count("*").alias("n"))


def anagram_hash(word: Column) -> Column:
    """The sum of the fifth powers of the characters' codes: equal for anagrams; one confusion changes it by a fixed difference."""
    return F.expr(f"aggregate(transform(split({word}, ''), c -> cast(pmod(ascii(c), 2048) as bigint)), 0L, (a, x) -> a + x * x * x * x * x)")


def _hash_of(s: str) -> int:
    return sum((ord(c) % 2048) ** 5 for c in s)


def misread_words(words: DataFrame) -> DataFrame:
    """(w, right): words of :func:`word_counts` that are a more frequent word with confused characters; the most frequent such word."""
    v = words.where("length(w) between 3 and 60 and w rlike '\\\\p{L}'").withColumn("ah", anagram_hash("w"))
    odd = F.col("w").rlike(r"[0-9@|!]")
    diffs = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(_hash_of(b) - _hash_of(a)).alias("d")) for a, b in CONFUSIONS])
    rare = v.where(odd | (F.length("w") >= 4)).withColumn("c", F.explode(F.filter(diffs, lambda x: F.col("w").contains(x["a"]))))
    rare = rare.select("w", "n", odd.alias("odd"), "c.a", "c.b", (F.col("ah") + F.col("c.d")).alias("ah"))
    good = v.where(~odd & (F.col("n") >= 2)).select(F.col("w").alias("right"), F.col("n").alias("m"), "ah")
    pairs = rare.join(good, "ah").where((F.col("odd") & (F.col("m") > F.col("n"))) | (F.col("m") >= F.lit(RATIO) * F.col("n")))
    at = lambda i: F.concat(F.col("w").substr(F.lit(1), i - 1), F.col("b"), F.col("w").substr(i + F.length("a"), F.length("w")))
    here = F.exists(F.sequence(F.lit(1), F.length("w") - F.length("a") + 1), lambda i: (F.col("w").substr(i, F.length("a")) == F.col("a")) & (at(i) == F.col("right")))
    return pairs.where(here).groupBy("w").agg(F.max_by("right", F.struct("m", "right")).alias("right"))


def distinct_pages(pages: DataFrame) -> DataFrame:
    """doc_id, page_no, text (and known) of the distinct pages with a text; one exchange."""
    return pages.where("text is not null").select("doc_id", F.col("page_no").cast("int").alias("page_no"), "text").distinct()


def cut_words(body: DataFrame) -> DataFrame:
    """doc_id, page_no, no, head, tail: lines that end in a hyphen, with the last word's part and the first word of the next running line."""
    rows = body.where("size(cuts) > 0").select("doc_id", "page_no", F.explode("cuts").alias("c")).select("doc_id", "page_no", "c.no", "c.head", "c.tail")
    # a word cut by the end of a page goes on in the first running line of the next page that has one
    firsts = body.where("size(nos) > 0").select("doc_id", "page_no", "first")
    nexts = following(firsts, ["doc_id"], "page_no", F.col("first"), "nx").select(F.col("doc_id").alias("_d"), F.col("page_no").alias("_p"), F.get("nx", F.lit(0)).alias("t"))
    outer = rows.where("tail is null").drop("tail").join(nexts, F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("page_no").eqNullSafe(F.col("_p"))).select("doc_id", "page_no", "no", "head", F.col("t").alias("tail"))
    return rows.where("tail is not null").unionByName(outer).where("tail rlike '^\\\\p{L}'")


def broken_words(cuts: DataFrame, words: DataFrame) -> DataFrame:
    """The rows of :func:`cut_words` whose joined word is written as one elsewhere, at least as often as with its hyphen; with ``word``."""
    c = cuts.withColumn("word", F.concat("head", "tail")).withColumn("hyphened", F.concat_ws("-", "head", "tail"))
    asked = c.select(F.explode(F.array("word", "hyphened")).alias("w")).distinct()
    known = asked.join(words, "w")
    one, two = known.select(F.col("w").alias("word"), F.col("n").alias("n1")), known.select(F.col("w").alias("hyphened"), F.col("n").alias("n2"))
    c = c.join(one, "word").join(two, "hyphened", "left")
    return c.where("n1 >= coalesce(n2, 0)").drop("n1", "n2", "hyphened")


def misread_places(body: DataFrame, words: DataFrame, bad: DataFrame) -> DataFrame:
    """doc_id, page_no, line_no, w, right: every place of a misread word."""
    lines = body.select("doc_id", "page_no", F.explode(F.arrays_zip("nos", F.split("lines", "\n", -1).alias("lines"))).alias("l"))
    tokens = lines.select("doc_id", "page_no", F.col("l.nos").alias("line_no"), F.explode(F.regexp_extract_all(F.col("l.lines"), F.lit(WORD), F.lit(0))).alias("w"))
    if bad.count() <= BROADCAST_FORMS:
        hits = tokens.join(F.broadcast(bad), "w")
    else:
        known = words.join(bad, "w", "left_anti").orderBy(F.desc("n"), "w").limit(KNOWN_WORDS).select("w")
        hits = tokens.join(F.broadcast(known), "w", "left_anti").join(bad, "w")  # bounded by KNOWN_WORDS
    return hits


def faults(pages: DataFrame) -> DataFrame:
    """(doc_id, page_no, line_no, fault, word, right) of all pages, one row a line; fault is furniture, broken_word or misread.

    ``pages``: doc_id, page_no, text; other columns are not read. Null, empty and blank pages have no lines; a page
    delivered twice counts once; two texts under one number are two pages. A line has one fault: furniture before
    broken_word before misread. An empty table gives no rows.
    """
    body = written(running_pages(pages), "body")
    words = written(word_counts(body), "words")
    bad = written(misread_words(words), "misread")
    none = F.lit(None).cast("string")
    # two texts under one page number are rare; their furniture is one set of line numbers
    by_page = body.where("size(furniture) > 0").groupBy("doc_id", "page_no").agg(F.array_distinct(F.flatten(F.collect_list("furniture"))).alias("furniture"))
    furniture = by_page.select("doc_id", "page_no", F.explode("furniture").alias("line_no"), F.lit("furniture").alias("fault"), none.alias("word"), none.alias("right"))
    broken = broken_words(cut_words(body), words).select("doc_id", "page_no", F.col("no").alias("line_no"), F.lit(2).alias("rank"), F.lit("broken_word").alias("fault"), "word", none.alias("right"))
    hits = misread_places(body, words, bad)
    misread = hits.select("doc_id", "page_no", "line_no", F.lit(3).alias("rank"), F.lit("misread").alias("fault"), F.col("w").alias("word"), "right")
    best = F.min(F.struct("rank", "fault", "word", "right"))
    running = broken.unionByName(misread).groupBy("doc_id", "page_no", "line_no").agg(best.alias("b")).select("doc_id", "page_no", "line_no", "b.fault", "b.word", "b.right")
    return furniture.unionByName(running).withColumn("line_no", F.col("line_no").cast("long"))


#: A line shorter than this part of its page's longest that ends a sentence ends a paragraph.
SHORT = 0.75
# The label with which a speaker's words begin.
SPEAKER = re.compile(r"\s*[A-Z][A-Z .,'’()-]{1,60}:\s")
_FRAGMENTS = "doc_id string, page_no long, text_hash long, starts boolean, closes boolean, inside int, fragments array<struct<n:int,text:string,open:boolean>>"


def _corrected(line: str, fixes: list[tuple[str, str]]) -> str:
    for w, right in fixes:
        def put(m: re.Match, right: str = right) -> str:
            return right.upper() if m[0].isupper() and len(m[0]) > 1 else right[:1].upper() + right[1:] if m[0][:1].isupper() else right

        line = re.sub(rf"(?<![^\W_])(?<![@|!]){re.escape(w)}(?![^\W_])(?![@|!])", put, line, flags=re.I)
    return line


def page_fragments(lines: list[tuple[int, str]], fixes: dict[int, list[tuple[str, str]]], broken: set[int]) -> tuple[bool, bool, list[tuple[int, str, bool]]]:
    """(begins with a paragraph of its own, ends one, [(paragraphs begun before it on the page, text, whether the next part joins without a blank)])."""
    width = max((len(x) for _, x in lines), default=0)
    out: list[tuple[int, str, bool]] = []
    text, is_open, n, closed, starts = "", False, 0, False, False
    for i, (no, x) in enumerate(lines):
        line = _corrected(x, fixes[no]) if no in fixes else x
        own = bool(SPEAKER.match(line)) and not is_open
        if i == 0:
            starts = own
        elif own or (closed and not is_open):
            out.append((n, text, False))
            text, n = "", n + 1
        line = " ".join(line.split())
        text = line if not text else text + line if is_open else f"{text} {line}"
        closed = len(x.rstrip()) < SHORT * width and x.rstrip()[-1:] in ".?!"
        is_open = len(line) > 1 and line[-1] in HYPHENS and line[-2].isalpha()
        if is_open and no in broken:
            text = text[:-1]
    if text:
        out.append((n, text, is_open))
    return starts, closed, out


def paragraphs(pages: DataFrame) -> DataFrame:
    """doc_id, paragraph_no (from 1), page_start, page_end, text and pages (offset in text and page_no of each stretch).

    The running text of each document, repaired: furniture left out, cut words joined, misread words corrected, single
    blanks. A paragraph begins with a speaker's label or after a short line that ends a sentence, and goes on across
    pages. Pages without running words give nothing; for nulls, repeated and empty tables see :func:`faults`.
    """
    body = written(running_pages(pages, keep_raw=True), "body")
    words = written(word_counts(body.select("lines")), "words")
    bad = written(misread_words(words), "misread")
    none = F.lit(None).cast("string")
    cut = broken_words(cut_words(body.drop("raw")), words).select("doc_id", "page_no", "no", none.alias("w"), none.alias("right"))
    wrong = misread_places(body.select("doc_id", "page_no", "nos", "lines"), words, bad).select("doc_id", "page_no", F.col("line_no").alias("no"), "w", "right")
    fixes = cut.unionByName(wrong).distinct().groupBy(F.col("doc_id").alias("_d"), F.col("page_no").alias("_p")).agg(F.sort_array(F.collect_list(F.struct("no", "w", "right"))).alias("fixes"))
    page = body.where("size(nos) > 0").select("doc_id", "page_no", "nos", "raw").join(fixes, F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("page_no").eqNullSafe(F.col("_p")), "left").select("doc_id", "page_no", "nos", "raw", "fixes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        types = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.int32(), pa.list_(pa.struct([("n", pa.int32()), ("text", pa.string()), ("open", pa.bool_())]))]
        for b in batches:
            out = []
            for d, p, nos, raw, found in zip(*(b.column(i).to_pylist() for i in range(5))):
                right: dict[int, list] = {}
                for f in found or ():
                    if f["w"] is not None:
                        right.setdefault(f["no"], []).append((f["w"], f["right"]))
                starts, closes, parts = page_fragments(list(zip(nos, raw.split("\n"))), right, {f["no"] for f in found or () if f["w"] is None})
                if parts:
                    out.append((d, p, xxhash.xxh64_intdigest(raw) - (1 << 63), starts, closes, parts[-1][0], [{"n": n, "text": t, "open": o} for n, t, o in parts]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], [c.split(" ")[0] for c in _FRAGMENTS.replace("struct<n:int,text:string,open:boolean>", "struct").split(", ")])

    part = written(page.mapInArrow(run, _FRAGMENTS), "fragments")
    # what the page before it leaves open, in blocks of pages: the order is turned round, so that what follows came before
    key = part.select("doc_id", "page_no", "text_hash", "starts", "closes", "inside", (-F.coalesce(F.col("page_no"), F.lit(-(2**40)))).alias("back"))
    key = following(key, ["doc_id"], "back", F.col("closes"), "before").withColumn("new", (F.col("starts") | F.coalesce(F.get("before", F.lit(0)), F.lit(True))).cast("long"))
    key = with_block(key, "page_no", 2048)
    inside = Window.partitionBy("doc_id", "_blk").orderBy(F.col("page_no").asc_nulls_first(), "text_hash").rowsBetween(Window.unboundedPreceding, 0)
    begun = F.col("new") + F.col("inside")
    sums = key.groupBy("doc_id", "_blk").agg(F.sum(begun).alias("_s"))
    across = Window.partitionBy("doc_id").orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("doc_id").alias("_d"), F.col("_blk").alias("_b"), F.coalesce(F.sum("_s").over(across), F.lit(0)).alias("_had"))
    key = key.withColumn("_to", F.sum(begun).over(inside)).join(sums, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_blk") == F.col("_b")), "left")
    key = key.select(F.col("doc_id").alias("_d"), F.col("page_no").alias("_p"), F.col("text_hash").alias("_h"), (F.col("_had") + F.col("_to") - F.col("inside")).alias("at"))
    rows = part.join(key, F.col("doc_id").eqNullSafe(F.col("_d")) & F.col("page_no").eqNullSafe(F.col("_p")) & (F.col("text_hash") == F.col("_h")))
    rows = rows.select("doc_id", "page_no", "text_hash", "at", F.explode("fragments").alias("f")).select("doc_id", (F.col("at") + F.col("f.n")).alias("paragraph_no"), F.struct(F.coalesce("page_no", F.lit(-1).cast("long")).alias("p"), F.col("text_hash").alias("h"), F.col("f.n").alias("n"), F.col("f.text").alias("t"), F.col("f.open").alias("o")).alias("f"))
    rows = rows.groupBy("doc_id", "paragraph_no").agg(F.sort_array(F.collect_list("f")).alias("fs"))
    step = F.expr("""aggregate(fs, named_struct('text', '', 'open', true, 'pages', cast(array() as array<struct<offset:int,page_no:bigint>>)),
      (a, f) -> named_struct('text', concat(a.text, if(a.open, '', ' '), f.t), 'open', f.o,
        'pages', concat(a.pages, array(named_struct('offset', length(a.text) + if(a.open, 0, 1), 'page_no', f.p)))))""")
    rows = rows.select("doc_id", "paragraph_no", F.col("fs")[0]["p"].alias("page_start"), F.element_at("fs", -1)["p"].alias("page_end"), step.alias("r"))
    return rows.select("doc_id", "paragraph_no", "page_start", "page_end", F.col("r.text").alias("text"), F.col("r.pages").alias("pages"))


def p2_found(spark: SparkSession, directory: str) -> DataFrame:
    return faults(table(spark, directory, "pages")).select("doc_id", "page_no", "line_no", "fault")


def p2_paragraphs(spark: SparkSession, directory: str) -> DataFrame:
    """The repaired running text of every document, paragraph by paragraph."""
    return paragraphs(table(spark, directory, "pages"))
