"""Keyword-stuffed pages, link lists and tag lists.

The function words of each language are learnt: words that stand in a large part of its documents. Every document then
gives features of density (links), entropy, repetition and function words, and for each language the centre and the
scatter of the features are estimated robustly (medians first, then trimmed moments, by aggregates over all documents).
A document whose Mahalanobis distance is beyond a chi-square limit and that lies out in a spam-directed direction is a
candidate; an exact check follows: more than half of its characters must belong to links, lists and repeated keywords.

Words are counted batch by batch in arrays: text becomes numbers once, and no step of the features runs word by word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from testimonia.sources.shared import written
from testimonia.sources.tables import table

LINK = re.compile(r"<a\s[^>]*>[^<]*</a>|!?\[[^\]\n]*\]\([^)\s]*\)|(?:https?://|www\.)[^\s<>)\]]+|(?<!\w)#\w+|[^\n»|/;,·•]{0,40}»", re.I)
# Signs outside ASCII that part list items, and that stand for a blank or for nothing.
LISTING, BLANK, NOTHING = "·•»", "\u00a0\u2013\u2014\u2026\u201c\u201d\u201e\u00ab", "\u2018\u2019\u00ad\u200b\ufeff"
FEATURES = ["link_share", "repetition", "entropy", "function_share"]
#: The direction of spam in each feature.
TOWARDS = np.array([1.0, 1.0, -1.0, -1.0])
LIMIT = 18.47  # the 0.999 quantile of chi-square with 4 degrees of freedom
SHARE = 0.5
#: A language with fewer documents teaches no function words and is judged by the centre of all documents.
LEAST_DOCS = 50
#: A word in this part of a language's documents is a function word; a document of d distinct words has at most d / COMMON of them on average.
COMMON = 0.25
#: No feature is trusted to vary less in honest texts.
FLOOR = np.array([0.02, 0.04, 0.03, 0.04])
#: Texts of one batch together are cut into groups of about so many characters, to bound memory.
GROUP_CHARS = 4_000_000


def lang_code(c):
    """The first two letters of a language tag in lower case, empty for anything else."""
    return F.coalesce(F.regexp_extract(F.lower(c), r"^([a-z]{2})(?:$|[-_])", 1), F.lit(""))


_TABLE = bytearray(range(256))
for _c in range(128):
    if not chr(_c).isalnum():
        _TABLE[_c] = 32
for _c in b"\n\r;|":
    _TABLE[_c] = 1
for _c in b".?!":
    _TABLE[_c] = 2
_TABLE[0] = 0
_TABLE = bytes(_TABLE)


def tokens_of(texts: list[str]) -> list[bytes]:
    """Words in lower case, 0x01 where list items are parted, 0x02 at full stops, question and exclamation marks, and 0x00 after each text.

    Whole-buffer replacements and one table do the work; signs outside ASCII other than the fixed ones count as letters.
    """
    s = ("\x00".join(texts) + "\x00").lower()
    if not s.isascii():
        for signs, to in ((LISTING, ";"), (BLANK, " "), (NOTHING, "")):
            for c in signs:
                s = s.replace(c, to)
    raw = s.encode("utf-8", "replace").replace(b" / ", b" ; ").replace(b" * ", b" ; ")
    raw = raw.translate(_TABLE, b"'")
    return raw.replace(b"\x00", b" \x00 ").replace(b"\x01", b" \x01 ").replace(b"\x02", b" \x02 ").split()


def own_signs(text: str) -> str:
    """The text without the three signs that :func:`tokens_of` puts in."""
    return text.replace("\x00", " ").replace("\x01", " ").replace("\x02", " ")


class Words:
    """Numbers for words; 0 parts documents, 1 parts list items, 2 ends a sentence."""

    def __init__(self, lists: dict[str, frozenset], most: int = 400_000) -> None:
        self.langs, self.most = sorted(lists), most
        every = sorted(set().union(*lists.values())) if lists else []
        self.row_of = {w.encode(): i + 1 for i, w in enumerate(every)}
        self.is_function = np.zeros((len(every) + 1, len(self.langs)), bool)
        for j, g in enumerate(self.langs):
            self.is_function[[self.row_of[w.encode()] for w in lists[g]], j] = True
        self.reset()

    def reset(self) -> None:
        words = self

        class Ids(dict):
            def __missing__(self, w: bytes) -> int:
                self[w] = i = len(words.length)
                words.length.append(len(w.decode("utf-8", "replace")) + 1)
                words.row.append(words.row_of.get(w, 0))
                words.word.append(w)
                return i

        self.length, self.row, self.word = [0, 1, 1], [0, 0, 0], [b"", b"", b""]
        self.ids = Ids({b"\x00": 0, b"\x01": 1, b"\x02": 2})

    def numbers(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number, text) of each token of the texts."""
        if len(self.length) > self.most:
            self.reset()
        tokens = tokens_of(texts)
        ids = np.fromiter(map(self.ids.__getitem__, tokens), np.int64, len(tokens))
        return ids, np.cumsum(ids == 0) - (ids == 0)


def _groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most GROUP_CHARS characters together; a longer text is a range of its own."""
    at = 0
    while at < len(texts):
        end, chars = at, 0
        while end < len(texts) and (end == at or chars + len(texts[end]) <= GROUP_CHARS):
            chars += len(texts[end])
            end += 1
        yield at, end
        at = end


def learned_words(docs: DataFrame, lang: str = "lang") -> tuple[dict[str, frozenset], dict[str, int]]:
    """Function words of each language with LEAST_DOCS documents or more, and the number of documents of each language code.

    All documents count. A language code is two letters, so there are at most 677; the words kept of one are at most
    1 / COMMON times the distinct words of its average document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words({})
        counts: dict[str, np.ndarray] = {}

        def partial() -> Iterator[pa.RecordBatch]:
            for g, c in counts.items():
                at = np.flatnonzero(c)
                yield pa.RecordBatch.from_arrays([pa.array([g] * len(at)), pa.array([words.word[i].decode("utf-8", "replace") for i in at.tolist()]), pa.array(c[at], pa.int64())], ["lang", "w", "n"])
            counts.clear()

        for b in batches:
            texts, codes = [own_signs(t) for t in b.column(1).to_pylist()], np.array(b.column(0).to_pylist(), object)
            for x, y in _groups(texts):
                if len(words.length) > words.most or sum(map(len, counts.values())) > 20_000_000:
                    yield from partial()
                ids, doc = words.numbers(texts[x:y])
                big = len(words.length)
                # number 0 stands once in each text and counts the texts
                pair = np.unique(doc * big + np.where(ids > 2, ids, 0))
                of, word = pair // big, pair % big
                for g in set(codes[x:y]):
                    c = np.bincount(word[(codes[x:y] == g)[of]], minlength=big)
                    old = counts.get(g)
                    if old is not None:
                        c[: len(old)] += old
                    counts[g] = c
        yield from partial()

    t = docs.where("text is not null and trim(text) <> ''").select(lang_code(F.col(lang)).alias("lang"), "text")
    partial = t.mapInArrow(run, "lang string, w string, n long")
    counts = written(partial.groupBy("lang", "w").agg(F.sum("n").alias("n")), "words")
    sizes = counts.where("w = ''").select("lang", F.col("n").alias("of"))
    n_docs = {r["lang"]: r["of"] for r in sizes.collect()}
    common = counts.where("w <> '' and lang <> '' and w rlike '[^0-9]'").join(F.broadcast(sizes), "lang").where((F.col("of") >= LEAST_DOCS) & (F.col("n") >= F.lit(COMMON) * F.col("of")))
    out: dict[str, set] = {g: set() for g, n in n_docs.items() if g and n >= LEAST_DOCS}
    for r in common.select("lang", "w").collect():
        out[r["lang"]].add(r["w"])
    return {g: frozenset(w) for g, w in out.items()}, n_docs


def _sums(values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(at, values, n)


def group_features(texts: list[str], codes: list[str], words: Words, listed_langs: frozenset) -> tuple:
    """Arrays of the texts: n_chars, code of the language that fits best, FEATURES, list_share.

    The language is the one whose function words make up most of the text, its own code being taken on a tie; a text of a
    language that taught no words is judged by its links and repetitions alone.
    """
    stripped = [t.strip() for t in texts]
    n_chars = np.array([len(t) for t in stripped], np.int64)
    rest = [LINK.sub("\n", t) if "/" in t or "#" in t or "»" in t or "](" in t else t for t in map(own_signs, stripped)]
    linked = n_chars - np.array([len(t) for t in rest], np.int64)
    n = len(texts)
    ids, doc = words.numbers(rest)
    length, row = np.array(words.length, np.int64), np.array(words.row, np.int64)
    is_word = ids > 2
    # a segment ends after a sign; sentences and list items are segments
    seg = (np.cumsum(~is_word) - ~is_word)[is_word]
    ended = (ids == 2)[~is_word]
    w, d = ids[is_word], doc[is_word]
    total = _sums(np.ones(len(w)), d, n)
    big = len(length)
    pair, inverse, count = np.unique(d * big + w, return_inverse=True, return_counts=True)
    pd_, pw = pair // big, pair % big
    # the language by its function words
    best, best_hits = np.full(n, -1), np.zeros(n)
    rows = row[pw]
    hit = rows > 0
    own = np.array([words.langs.index(c) if c in listed_langs else -1 for c in codes])
    for j in range(len(words.langs)):
        hits = _sums(count[hit] * words.is_function[rows[hit], j], pd_[hit], n) + 0.5 * (own == j)
        best = np.where(hits > best_hits, j, best)
        best_hits = np.maximum(hits, best_hits)
    unlisted = np.array([bool(c) and c not in listed_langs for c in codes]) & (best_hits < 0.3 * total)
    best = np.where(unlisted, -1, best)
    f_pair = words.is_function[rows, best[pd_]] if words.langs else np.zeros(len(pair), bool)
    f_pair &= best[pd_] >= 0
    blind = best < 0  # no function words are known for it
    function = np.divide(_sums(count * f_pair, pd_, n), total, out=np.zeros(n), where=total > 0)
    log_total = np.log(np.maximum(total, 2))
    entropy = np.where(total > 1, (np.log(np.maximum(total, 1)) - _sums(count * np.log(count), pd_, n) / np.maximum(total, 1)) / log_total, 1.0)
    # words that stand out: content words much more frequent than they are in texts of its length
    heavy_pair = ~f_pair & (count >= np.maximum(3, 0.03 * total)[pd_])
    f_tok, h_tok = f_pair[inverse], heavy_pair[inverse]
    # words of neighbours that stand together again and again
    next_to = np.flatnonzero(d[1:] == d[:-1]) if len(w) > 1 else np.zeros(0, np.int64)
    kinds = np.unique(w[next_to] * big + w[next_to + 1], return_inverse=True)[1] if len(next_to) else np.zeros(0, np.int64)
    dd, span = d[next_to], kinds.max(initial=0) + 1
    key, back, times = np.unique(dd * span + kinds, return_inverse=True, return_counts=True)
    again = (times >= np.maximum(4, 0.04 * total)[key // span])[back] if len(key) else np.zeros(0, bool)
    r_tok = np.zeros(len(w), bool)
    r_tok[next_to[again]] = True
    r_tok[next_to[again] + 1] = True
    repeated = _sums(r_tok, d, n) / np.maximum(1, total)
    # segments that are no sentences
    seg_ids, at, k = np.unique(seg, return_inverse=True, return_counts=True)
    fw, hv, rp = (_sums(x, at, len(seg_ids)) / np.maximum(k, 1) for x in (f_tok, h_tok, r_tok))
    chars = _sums(length[w], at, len(seg_ids))
    seg_doc = np.zeros(len(seg_ids), np.int64)
    seg_doc[at] = d
    ended, seen = ended[seg_ids], ~blind[seg_doc]
    is_list = ((fw < np.where(k >= 8, 0.25, 0.12)) & ~ended & seen) | (hv >= 0.45) | ((hv >= 0.25) & (fw < 0.3) & seen) | ((rp >= 0.45) & ~ended)
    in_words = _sums(chars, seg_doc, n)
    in_lists = _sums(np.where(is_list, chars, 0), seg_doc, n)
    share = np.minimum(1.0, (linked + in_lists) / np.maximum(1, linked + in_words))
    lang = np.array([words.langs[b] if b >= 0 else "" for b in best], object)
    function = np.where(blind, 0.3, function)
    return n_chars, lang, np.clip(linked / np.maximum(1, n_chars), 0, 1), repeated, entropy, function, share


def scored(docs: DataFrame, lists: dict[str, frozenset], lang: str = "lang") -> DataFrame:
    """doc_id, lang (the one that fits), n_chars, FEATURES and list_share of each document with a text that is not blank."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(lists)  # bounded, see learned_words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, listed = Words(sent.value), frozenset(sent.value)
        for b in batches:
            texts, codes = b.column(2).to_pylist(), b.column(1).to_pylist()
            for x, y in _groups(texts):
                n, g, *f = group_features(texts[x:y], codes[x:y], words, listed)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(x, y - x), pa.array(g, pa.string()), pa.array(n, pa.int64()), *(pa.array(c, pa.float64()) for c in f)], ["doc_id", "lang", "n_chars", *FEATURES, "list_share"])

    docs = docs.where("text is not null").select("doc_id", lang_code(F.col(lang)).alias("lang"), "text")
    return docs.mapInArrow(run, f"doc_id {kind}, lang string, n_chars long, " + ", ".join(f"{f} double" for f in [*FEATURES, "list_share"])).where("n_chars > 0")


def _moments(rows: DataFrame) -> dict:
    k = len(FEATURES)
    aggs = [F.count("*").alias("n"), *[F.avg(f).alias(f"m{i}") for i, f in enumerate(FEATURES)]]
    aggs += [F.avg(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"c{i}_{j}") for i in range(k) for j in range(i, k)]
    out = {}
    for r in rows.groupBy("lang").agg(*aggs).collect():  # one row per language, 677 at most
        m = np.array([r[f"m{i}"] for i in range(k)])
        c = np.array([[r[f"c{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)]) - np.outer(m, m)
        out[r["lang"]] = (r["n"], m, c)
    return out


def _with_distance(rows: DataFrame, models: dict) -> DataFrame:
    """Adds distance (squared, from the centre of the row's language) and towards_spam; one small table row per language."""
    k = len(FEATURES)
    flat = [(g, *m.tolist(), *np.asarray(inv).ravel().tolist()) for g, (m, inv) in models.items()]
    names = ["lang", *(f"_m{i}" for i in range(k)), *(f"_v{i}_{j}" for i in range(k) for j in range(k))]
    t = rows.sparkSession.createDataFrame(flat, ", ".join(f"{c} {'string' if c == 'lang' else 'double'}" for c in names))
    rows = rows.join(F.broadcast(t), "lang")
    z = [F.col(f) - F.col(f"_m{i}") for i, f in enumerate(FEATURES)]
    d = sum((z[i] * F.col(f"_v{i}_{j}") * z[j] for i in range(k) for j in range(k)), F.lit(0.0))
    side = sum((z[i] * F.sqrt(F.col(f"_v{i}_{i}")) * F.lit(float(TOWARDS[i])) for i in range(k)), F.lit(0.0))
    return rows.withColumn("distance", d).withColumn("towards_spam", side).drop(*names[1:])


def judged(docs: DataFrame, lang: str = "lang", steps: int = 2) -> DataFrame:
    """doc_id, lang (the one that fits), n_chars, FEATURES, list_share, distance, towards_spam, is_outlier and is_spam.

    Null, empty and blank texts get no row. Other columns than doc_id, text and ``lang`` are not read. A document is
    judged by the language whose function words it holds, whatever its label; where none fits, and in languages of fewer
    than LEAST_DOCS documents, by the centre of all documents. An empty table gives no rows.
    """
    lists, _ = learned_words(docs, lang)
    rows = written(scored(docs, lists, lang), "features")
    k = len(FEATURES)
    middle = [F.percentile_approx(f, 0.5, 2000).alias(f"a{i}") for i, f in enumerate(FEATURES)]
    quart = [F.percentile_approx(f, F.array(F.lit(0.25), F.lit(0.75)), 2000).alias(f"q{i}") for i, f in enumerate(FEATURES)]

    def start(r) -> tuple[np.ndarray, np.ndarray]:
        m = np.array([r[f"a{i}"] for i in range(k)], float)
        s = np.maximum(FLOOR, np.array([(r[f"q{i}"][1] - r[f"q{i}"][0]) / 1.349 for i in range(k)]))
        return m, np.diag(1 / s**2)

    # the grouping sets give each language and, under null, all documents
    found = rows.rollup("lang").agg(F.count("*").alias("n"), *middle, *quart).collect()
    whole = next((start(r) for r in found if r["lang"] is None and r["n"]), (np.zeros(k), np.eye(k)))
    models = {r["lang"]: start(r) if r["n"] >= LEAST_DOCS and r["lang"] else whole for r in found if r["lang"] is not None}
    for _ in range(steps):
        for g, (n, m, c) in _moments(_with_distance(rows, models).where(F.col("distance") <= LIMIT)).items():
            if n >= LEAST_DOCS and g:
                models[g] = (m, np.linalg.inv(c + np.diag(FLOOR**2)))
    rows = _with_distance(rows, models)
    out = (F.col("distance") > LIMIT) & (F.col("towards_spam") > 0)
    return rows.withColumn("is_outlier", out).withColumn("is_spam", out & (F.col("list_share") > SHARE))


def p10_found(spark: SparkSession, directory: str) -> DataFrame:
    return judged(table(spark, directory, "documents")).where("is_spam").select("doc_id")


def p10_scores(spark: SparkSession, directory: str) -> DataFrame:
    return judged(table(spark, directory, "documents"))
