"""Fixtures with known results, and operators against brute force."""

import random
import textwrap
import uuid

import pytest
from pyspark.sql import functions as F

from testimonia.functions import text as T
from testimonia.operators import corpus, graph, ordered, parsing


def test_word_count_and_titles(spark):
    r = spark.createDataFrame([("It's a half-open door - no?", "CAPT ROE"), ("", "MISS FEN ISC")], "a string, b string")
    assert [tuple(x) for x in r.select(T.word_count(F.col("a")), T.strip_titles(T.normalise(F.col("b")))).collect()] == [(5, "ROE"), (0, "FEN")]


def test_point_id_is_a_name_based_uuid(spark):
    assert spark.range(1).select(T.point_id(F.lit("abc"))).first()[0] == str(uuid.uuid5(uuid.NAMESPACE_URL, "abc"))


def test_timestamps(spark):
    rows = [("07:08.090", 428.09), ("10:00:00.001", 36000.001), ("7:08.090", None), ("07:08", None), ("", None), (None, None)]
    r = spark.createDataFrame([(x,) for x, _ in rows], "s string").select(T.timestamp_seconds(F.col("s")))
    assert [x[0] for x in r.collect()] == [v for _, v in rows]


def test_furniture(spark):
    rows = [("3 MAY 2031 – DAY 7", True), ("pAGE 44 OF 45", True), (" 999 ", True), ("1000", False), ("on page 3 of 9", False), (" ", True)]
    r = spark.createDataFrame([(x,) for x, _ in rows], "s string").select(T.is_furniture(F.col("s")))
    assert [x[0] for x in r.collect()] == [v for _, v in rows]


def test_a_word_that_two_entities_own_resolves_to_none(spark):
    """Two bodies share a word of their names; a form made of it alone must not resolve, though one of them has it as what is left of an alias."""
    e = spark.createDataFrame([("o:1", "Harbour Office", "org", ["THE HARBOUR"]), ("o:2", "Harbour Trust", "org", ["HT"]), ("p:1", "Miss Ida Quill", "person", ["MISS QUILL"]), ("p:2", "Dr Quill Ash", "person", None)], "entity_id string, name string, entity_type string, aliases array<string>")
    s = spark.createDataFrame([("org", "harbour"), ("org", "the  HARBOUR"), ("org", "H.T."), ("org", "ht"), ("person", "Quill"), ("person", "miss quill"), ("person", "Ida Quill"), ("person", "Ash"), ("person", None)], "type_group string, surface string")
    got = {r["surface"]: r["entity_id"] for r in graph.resolved(s, e).collect()}
    assert got == {"harbour": None, "the  HARBOUR": "o:1", "H.T.": None, "ht": "o:2", "Quill": None, "miss quill": "p:1", "Ida Quill": "p:1", "Ash": None, None: None}


def test_point_parity_fails_where_points_are_missing_or_superseded(spark):
    chunks = spark.createDataFrame([("c1", "a"), ("c1", "a"), ("c2", "a"), ("c3", "b")], "chunk_id string, doc_sha256 string")
    reg = spark.createDataFrame([("a", None), ("b", "a")], "sha256 string, superseded_by string")
    points = lambda *ids: spark.createDataFrame([(i,) for i in ids], "point_id string")
    got = [tuple(graph.point_parity(points(*p), chunks, reg).first()) for p in (["p1", "p2"], ["p1", "p1"], ["p1", "p2", "p3"])]
    assert got == [(2, 2, 0, True), (1, 2, 0, False), (3, 2, 0, False)]


def test_containment_does_not_depend_on_page_breaks(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [(d, n, " ".join(words[i : i + size])) for d, size in (("a", 15), ("b", 7)) for n, i in enumerate(range(0, 60, size), 1)]
    pages = spark.createDataFrame(rows, "doc_id string, page_no int, text string")
    reg = spark.createDataFrame([("s", "a", 1, ""), ("s", "b", 1, "")], "commission_slug string, sha256 string, day_no int, hearing_date string")
    assert tuple(corpus.containment(reg, pages).first()) == ("a", "b", 1.0, 1.0, True)


def test_merges(spark):
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(1, "b"), (2, "c"), (2, "d")], "k int, v string")
    assert sorted(map(tuple, graph.first_write_wins(old, new, ["k"], "v").collect())) == [(1, "a"), (2, "c")]
    assert sorted(map(tuple, graph.last_write_wins(old, new, ["k"], "v").collect())) == [(1, "b"), (2, "d")]


TURN = "doc_id string, turn_no int, speaker string, text string, page_start int, page_end int"


def _pack(rows, limit):
    """Passages of (speaker, text) rows by brute force; a row over the limit is split by the operator's own sentences."""
    out, now = [], []
    for i, (s, t) in enumerate(rows):
        x = f"{s}: {t}"
        if len(x) > limit:
            out += [now] * bool(now) + [[f"{s}: {p}"] for p in parsing._split_sentences(t, limit - len(s) - 2)]
            now = []
        elif now and len("\n".join([*now, x])) > limit:
            out, now = [*out, now], [x]
        else:
            now.append(x)
    return ["\n".join(g) for g in [*out, now] if g]


@pytest.mark.parametrize("size", [3, 7, 2048])
def test_packed_turns_against_brute_force_over_blocks(spark, monkeypatch, size):
    rng = random.Random(size)
    rows = [("AB"[i % 2] * 3, " ".join(rng.choice(["one two.", "three four five?", "six"]) for _ in range(rng.choice([1, 2, 5, 40])))) for i in range(90)]
    df = spark.createDataFrame([("d", i, s, t, i, i) for i, (s, t) in enumerate(rows)] + [("e", 0, None, "lone", None, None), ("e", 1, "X", None, 1, 1)], TURN)
    monkeypatch.setattr(ordered, "SIZE", size)
    for f in (ordered.greedy_starts, ordered.running_sum):
        monkeypatch.setattr(f, "__defaults__", (*f.__defaults__[:-1], size))
    got = parsing.packed_turns(df, 200).orderBy("doc_id", "chunk_index").collect()
    assert [r["text"] for r in got if r["doc_id"] == "d"] == _pack(rows, 200) and [r["chunk_index"] for r in got if r["doc_id"] == "d"] == list(range(len(got) - 1))
    assert all(len(r["text"]) <= 200 for r in got) and [r["text"] for r in got if r["doc_id"] == "e"] == [": lone"]


def test_turns_over_page_ends(spark):
    pages = [("d", 1, "3 MAY 2031 – DAY 7\nbefore anybody speaks\nMISS FEN:   I looked at\n44\nit twice, DR\nROE told me so. MAJ"), ("d", 2, "GEN  OAK -ASH:  And\nPage 2 of 9\nthen? RE-EXAMINATION BY ADV YEW (CONTINUES):  No"), ("d", 3, " \n"), ("d", 4, "more. NOT A LABEL: the end. THE WITNESS: "), ("e", 1, None), ("d", 4, "more. NOT A LABEL: the end. THE WITNESS: ")]
    got = parsing.detected_turns(spark.createDataFrame(pages, "doc_id string, page_no int, text string")).orderBy("turn_no").collect()
    assert [tuple(r)[1:] for r in got] == [(1, "MISS FEN", "I looked at it twice, DR ROE told me so.", 1, 1), (2, "MAJ-GEN OAK-ASH", "And then?", 1, 2), (3, "ADV YEW", "No more. NOT A LABEL: the end.", 2, 4)]


def test_segments_never_cut_a_cue(spark):
    cues = spark.createDataFrame([("v", i, float(i), i + 0.5, t) for i, t in enumerate(["ab cd", "ef", "x" * 30, "gh", "", "ij kl mn"])], "doc_id string, pos int, start_s double, end_s double, text string")
    got = parsing.caption_segments(cues, 12).orderBy("segment_index").collect()
    assert [(r["text"], r["time_start"], r["time_end"], r["n_cues"]) for r in got] == [("ab cd ef", 0.0, 1.5, 2), ("x" * 30, 2.0, 2.5, 1), ("gh ij kl mn", 3.0, 5.5, 2)]


def test_vtt(spark):
    text = "\ufeffWEBVTT - title\n\nNOTE 00:01.000 is no cue\n\n7\n00:01.500 --> 00:02.000 line:0\nfirst <c>line</c>\n \nsecond  line\n\n00:99 --> 00:03.000\nlost\n\n00:03.000 --> 01:00:04.000\n\n00:05.000 --> 00:06.000\r\nlast"
    got = parsing.vtt_cues(spark.createDataFrame([("a", text), ("b", None)], "path string, text string")).collect()
    assert [tuple(r) for r in got] == [("a", 0, 1.5, 2.0, ["first line", "second line"]), ("a", 1, 5.0, 6.0, ["last"])]


def test_captions_shown_twice(spark):
    c = spark.createDataFrame([("v", 0, 0.0, 1.0, ["a b"]), ("v", 1, 1.0, 2.0, ["a b", "c<00:01>d"]), ("v", 2, 2.0, 3.0, None), ("v", 3, 2.0, 3.0, ["e"])], "doc_id string, pos int, start_s double, end_s double, lines array<string>")
    assert [r["text"] for r in parsing.rolling_lines(c).orderBy("pos").collect()] == ["a b", "cd", "e"]


def test_snippets(spark):
    rows = [("one  two three", 9, "one two …"), ("one two", 9, "one two"), ("abcdefghijkl m", 9, "…"), ("one two three", 13, "one two three"), ("one two threes", 13, "one two …")]
    for text, width, want in rows:
        assert spark.createDataFrame([(text,)], "s string").select(T.snippet(F.col("s"), width)).first()[0] == want == textwrap.shorten(text, width, placeholder=" …").strip()


def test_quote_spans(spark):
    rows = [("a (b) c", "(b)", (2, 5)), ("a\nb", "a b", (0, 3)), ("a  b", "a b", None), ("x a \n\t b.", "a\nb", (2, 8)), ("x a\t\nb.", "a\nb", (2, 6)), ("p.q", "p q", None), ("none", "else", None)]
    start, end = T.quote_span(F.col("t"), F.col("q"))
    got = spark.createDataFrame([r[:2] for r in rows], "t string, q string").select(start, end).collect()
    assert [None if r[0] is None else tuple(r) for r in got] == [w for _, _, w in rows]
