"""Operators of claims, evaluation, loads, sources and providers on small fixtures with known results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from testimonia import reports, sinks
from testimonia.functions import links as L
from testimonia.operators import claims as CL, evaluation as E, graph as G, loading as LD, providers as PV
from testimonia.sources import files as S, html as H

ENT = "entity_id string, name string, entity_type string, aliases array<string>"
CLAIM = "claim_id string, chunk_id string, speaker string, text string, quote string, certainty string, mentions array<struct<name:string,role:string,labels:array<string>>>"


@pytest.fixture(scope="module")
def store(spark):
    return spark.createDataFrame([("p:fen", "Miss Una Fen", "person", ["MISS FEN"]), ("p:roe", "Capt Jon Roe", "person", ["COMMISSIONER ROE"]), ("o:hb", "Harbour Board", "org", ["HB"]), ("l:key", "Keyford", "place", None)], ENT)


@pytest.fixture(scope="module")
def chunks(spark):
    text = "MISS FEN: The Harbour Board kept no books. COMMISSIONER ROE: I saw them  burnt. THE WITNESS: So did I."
    return spark.createDataFrame([("c1", text), ("c1", text), ("c2", "nobody speaks here"), ("c3", None)], "chunk_id string, text string")


def _claims(spark, rows):
    return spark.createDataFrame([(i, c, s, t, q, "asserted", m) for i, c, s, t, q, m in rows], CLAIM)


def test_claim_rows(spark, store, chunks):
    m = lambda n, r, *l: (n, r, list(l))
    rows = [
        ("a", "c1", "Miss  Fen", "said that HB kept none", "kept no books", [m("HB", "object", "Organisation"), m("Harbour  Board", "subject", "Organisation"), m("Someone", "subject", "Person")]),
        ("b", "c1", " witness x ", "stated it", "saw them burnt", [m("Keyford", None, "Place"), m("Chair", "subject")]),
        ("c", "c1", " ", "stated it", "I saw", None), ("d", "c1", "MISS FEN", "stated it", "invented", []), ("e", "c3", "MISS FEN", "stated it", "any", []),
    ]
    claims = _claims(spark, rows + rows[:1])
    states = {r["claim_id"]: (r["state"], r["speaker_id"], r["speaker_unresolved"]) for r in CL.claim_states(claims, chunks, store).collect()}
    assert states["a"] == ("ok", "p:fen", False) and states["b"] == ("no_quote", "raw:WITNESS X", True) and states["c"][0] == "no_speaker" and states["d"][0] == states["e"][0] == "no_quote"
    core, mentions = CL.claim_rows(claims, chunks, store)
    r = core.collect()
    assert len(r) == 1 and (r[0]["quote_start"], r[0]["quote_end"]) == (28, 41) and r[0]["unresolved_subjects"] == ["Someone"] and len(r[0]["key"]) == 64
    assert [tuple(x) for x in mentions.collect()] == [("a", "o:hb", "subject")]
    assert {tuple(x) for x in CL.subject_ids(claims, store).collect()} == {("a", "o:hb"), ("a", "raw:SOMEONE"), ("b", "ref:Chair")}
    s = CL.sweep(claims, CL.subject_ids(claims, store)).first()
    assert (s["claims"], s["structural_flags"], s["dangling_subjects"], s["pronouns"], s["gate_ok"]) == (5, 1, 1, 4, False)
    assert CL.claim_rows(claims.limit(0), chunks, store)[0].count() == 0


def test_attribution_buckets(spark, store, chunks):
    rows = [("match", "c1", "MISS FEN", "t", "kept no books", None), ("parser_gap", "c1", "Commissioner Roe", "t", "saw them  burnt", None), ("model_wrong", "c1", "Commissioner Roe", "t", "no books", None), ("quote_unrecoverable", "c1", "MISS FEN", "t", "nowhere", None), ("indeterminate", "c2", "MISS FEN", "t", "speaks", None)]
    buckets = CL.attribution(_claims(spark, rows), chunks, store)
    assert {r["claim_id"]: r["bucket"] for r in buckets.collect()} == {r[0]: r[0] for r in rows}
    r = CL.attribution_rate(buckets).first()
    assert (r["total"], r["comparable"], r["error_rate"]) == (5, 2, 0.5)
    spans = sorted(tuple(x)[1:] for x in CL.label_spans(chunks).collect())
    assert [s[2] for s in spans] == ["MISS FEN", "COMMISSIONER ROE", "THE WITNESS"] and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_dereference_takes_the_last_of_a_ref(spark):
    e = spark.createDataFrame([("c", "e1", 1, "A", "person"), ("c", "e1", 2, "B", "org")], "chunk_id string, ref string, pos int, name string, type string")
    r = spark.createDataFrame([("c", "e1"), ("c", "e2"), ("x", "e1")], "chunk_id string, ref string")
    assert {(x["chunk_id"], x["ref"]): x["name"] for x in CL.dereferenced(r, e).collect()} == {("c", "e1"): "B", ("c", "e2"): None, ("x", "e1"): None}


def test_soft_matches_are_greedy_in_order(spark):
    side = lambda *rows: spark.createDataFrame([("c", i, p, s) for i, (p, s) in enumerate(rows)], "chunk_id string, pos int, predicate string, subjects array<string>")
    got = lambda a, b: tuple(E.match_claims(a, b).first())[1:]
    said = "said that the gate was left open"
    assert got(side((said, ["a"])), side(("said the gate was left open", ["b", "a"]))) == (1, 0, 0)
    assert got(side((said, ["a"])), side(("zzz qqq xxx", ["a"]))) == (0, 1, 1) and got(side((said, ["a"])), side((said, ["b"]))) == (0, 1, 1)
    # the first claim takes the best candidate, the second what is left
    assert got(side((said, ["a"]), (said + " at night", ["a"])), side((said, ["a"]))) == (1, 1, 0)
    assert E.match_claims(side((said, ["a"])).limit(0), side((said, ["a"]))).first()["invented"] == 1


def test_precision_skips_passages_that_one_arm_lacks(spark):
    side = lambda *rows: spark.createDataFrame(list(rows), "chunk_id string, id string")
    ref, cand = side(("1", "a"), ("1", "b"), ("2", "a"), ("3", "a")), side(("1", "a"), ("1", "raw:X"), ("3", "c"))
    r = E.prf(E.arms(ref, cand)).first()
    assert (r["tp"], r["fp"], r["fn"]) == (1, 2, 2) and r["prec"] == 1 / 3 and r["rec"] == 1 / 3 and abs(r["f1"] - 1 / 3) < 1e-12
    sample = spark.createDataFrame([("1", "control"), ("2", "ocr_variant"), ("3", "high_acronym")], "chunk_id string, stratum string")
    none = spark.createDataFrame([], "chunk_id string, matched long, dropped long, invented long")
    rows = {x["grp"]: x for x in E.compared_arm(ref, cand, sample, none).collect()}
    assert (rows["overall"]["chunks"], rows["overall"]["completed"], rows["overall"]["fragments"]) == (3, 2, 1) and (rows["hard"]["tp"], rows["hard"]["fp"], rows["control"]["tp"]) == (0, 1, 1)
    assert E.prf(E.arms(ref.limit(0), cand)).first()["f1"] == 0.0


def test_sample_gives_spare_places_to_others(spark):
    rows = spark.createDataFrame([(f"{s}{i}", s) for s, n in zip(E.STRATA, (1, 0, 3, 50, 50)) for i in range(n)], "chunk_id string, stratum string")
    got = E.stratified_sample(rows, 20).groupBy("stratum").count().collect()
    assert {r["stratum"]: r["count"] for r in got} == {"ambiguous_surname": 1, "high_acronym": 3, "allegation_dense": 8, "control": 8}
    assert sorted(E.stratified_sample(rows, 20).collect()) == sorted(E.stratified_sample(rows, 20).collect()) != sorted(E.stratified_sample(rows, 20, seed=4).collect())


def test_upsert_keeps_what_a_later_discovery_lacks(spark):
    t = lambda d: dt.datetime(2031, 1, d)
    cols = "url string, title string, hearing_date string, source_page_url string, day_no int, source_type string, document_type string, sha256 string, size_bytes long, filename string, local_path string, content_type string, transcription_method string, downloaded boolean, notes string, authoritative boolean, superseded_by string, discovered_at timestamp"
    base = ("u", "First", "2031-01-01", "p", 4, "transcript", "Transcript")
    rows = [(*base, None, None, None, None, None, None, False, "wait", True, None, t(1)), ("u", "", None, "", None, "report", "Report", "ff", 9, "f.pdf", "l", "pdf", None, True, None, False, "x", t(2)), ("u", None, None, None, None, "report", "Report", None, None, None, None, None, None, False, "late note", None, None, t(3))]
    r = LD.upserted_registry(spark.createDataFrame(rows, cols)).first()
    assert (r["title"], r["day_no"], r["source_type"], r["sha256"], r["notes"], r["authoritative"], r["superseded_by"], r["downloaded"]) == ("First", 4, "report", "ff", None, True, None, 1)


def test_load_actions_and_budget(spark):
    c = spark.createDataFrame([(d, f"{d}{i}") for d in "abcd" for i in range(2)], "doc_sha256 string, chunk_id string")
    r = spark.createDataFrame([("a", None), ("b", "z"), ("c", "")], "doc_sha256 string, superseded_by string")
    got = LD.load_actions(c, c.where("doc_sha256 in ('a', 'b') or chunk_id = 'c0'"), r)
    assert {x["doc_sha256"]: x["action"] for x in got.collect()} == {"a": "skip", "b": "superseded", "c": "load", "d": "no_source"}
    assert {x["action"] for x in LD.load_actions(c, c, r, force=True).collect()} == {"load", "superseded", "no_source"}
    n = LD.load_counters(got).first()
    assert (n["docs_skip"], n["chunks_loaded"], n["points_purged"]) == (1, 2, 2)
    items = spark.createDataFrame([(i, 10) for i in range(500)], "i int, cost int")
    for blocks in (1, 7, 300):
        assert sorted(x["i"] for x in LD.within_budget(items, "i", "cost", 95, blocks).collect()) == list(range(10))
    assert [tuple(x) for x in LD.reconciled(spark.createDataFrame([(3, 5)], "docs int, pages int"), spark.createDataFrame([(3, 6)], "docs int, pages int")).collect()] == [("pages", 5, 6)]


def test_registry_lines(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"url": "u", "n": 1}\n{broken\n\n{"url": "u", "n": 2}\n{"url": "v"}\n')
    assert sorted(map(tuple, S.registry_scan(spark, str(tmp_path), "url string, n int").collect())) == [("u", 2), ("v", None)]
    assert [r["value"] for r in S.json_lines(spark, str(tmp_path), "url string, n int")[1].collect()] == ["{broken"]
    s = spark.createDataFrame([("a", "control"), ("b", "ocr_variant")], "chunk_id string, stratum string")
    sinks.freeze_sample(s, str(tmp_path / "s"))
    sinks.freeze_sample(s, str(tmp_path / "s"))
    with pytest.raises(ValueError):
        sinks.freeze_sample(s.limit(1), str(tmp_path / "s"))
    rows = spark.createDataFrame([("d1", 1), ("d2", 2)], "doc_sha256 string, n int")
    sinks.write_documents(rows.where("n = 1"), str(tmp_path / "d"))
    sinks.write_documents(rows.withColumn("n", F.col("n") * 10), str(tmp_path / "d"))
    assert sorted(r["n"] for r in spark.read.parquet(str(tmp_path / "d")).collect()) == [1, 20]


def test_links(spark):
    cases = [("https://h.example/a/b.html", "../c.pdf", "https://h.example/c.pdf"), ("https://h.example", "x.pdf", "https://h.example/x.pdf"), ("https://h.example/a/", "?p=2", "https://h.example/a/?p=2"), ("https://h.example/a", "//o.example/b", "https://o.example/b"), ("https://h.example/a", "", "https://h.example/a")]
    df = spark.createDataFrame(cases, "base string, href string, want string")
    assert [r[0] for r in df.select(L.absolute_url(F.col("base"), F.col("href"))).collect()] == [c[2] for c in cases]
    one = lambda f, *v: spark.createDataFrame([tuple(v)], ", ".join(f"c{i} string" for i in range(len(v)))).select(f(*[F.col(f"c{i}") for i in range(len(v))])).first()[0]
    assert one(L.canonical_url, "HTTP://H.Example/My File%20x.PDF;v?a=B#c") == "http://h.example/My%20File%20x.PDF?a=B"
    dates = [("on 2031/02/03", "", "2031-02-03"), ("x", "r_20230230_20240229.pdf", "2024-02-29"), ("x", "r_19990101.pdf", None), ("heard 7 march 2025 and 8 May 2026", "", "2025-03-07"), ("31 June 2025", "", None)]
    for text, name, want in dates:
        assert one(L.date_in, text, name) == want
    assert one(L.day_number, "Heard on DAY_012") == 12 and one(L.day_number, "Friday 3") is None
    kinds = [("STATEMENT BY the board on the report", "Second_Interim.pdf", "https://h.example/media", "report"), ("the report", "STATEMENT of X.pdf", "https://h.example/", "statement"), ("a record", "x.pdf", "", "transcript"), ("x", "x.pdf", "https://h.example/notices", "notice"), ("x", "x.pdf", "", "supporting_document")]
    for text, name, page, want in kinds:
        assert one(lambda a, b, c: L.link_kind(a, b, c)[0], text, name, page) == want


def test_tabs_of_any_shape(spark):
    item = '{"tab_type":"Transcript","item_type":"file","title":"Day 7","content_url":"\\\\/f\\\\/a.pdf"}'
    doc = '{"tab_type":"Documents","title":"","content_url":"/f/Interim.pdf"}'
    video = '{"tab_type":"Videos","title":"2031-02-03","content_url":"https://youtu.be/abc"}'
    q = lambda s: s.replace('"', "&quot;")
    pages = [("p1", f'<div data-tabs="{q("{%sTranscript%s: [%s], %sx%s: {%sy%s: [%s, %s]}}" % (*[chr(34)] * 2, item, *[chr(34)] * 4, doc, video))}">'), ("p2", f"<div data-tabs='[{item}]'><div data-tabs='[{item},'>"), ("p3", None)]
    got = sorted((r["page_url"], r["source_type"], r["url"], r["day_no"], r["date"]) for r in H.tab_records(spark.createDataFrame(pages, "page_url string, html string"), "https://h.example").collect())
    a = "https://h.example/f/a.pdf"
    assert got[:3] == [("p1", "report", "https://h.example/f/Interim.pdf", 7, "2031-02-03"), ("p1", "transcript", a, 7, "2031-02-03"), ("p1", "video", "https://youtu.be/abc", 7, "2031-02-03")]
    assert [g[0:2] for g in got[3:]] == [("p2", "transcript")] * 2


def test_anchors_under_headings(spark):
    html = "<a href='z.pdf'>early</a><h5>Day 3 - 2031-02-03</h5><a href=\"a.pdf\">one</a><h4>other</h4><p><A class=x HREF='b.PDF#p'>two &amp; <b>more</b></A><a href='c.html'>no</a><h6>Day 4 – 2031-02-04</h6><a href='a.pdf'> </a>"
    got = H.anchors_under_headings(spark.createDataFrame([("https://h.example/d/", html), ("q", None)], "page_url string, html string")).orderBy("pos").collect()
    assert [(r["title"], r["day_no"], r["date"]) for r in got] == [("early", None, None), ("one", 3, "2031-02-03"), ("two & more", 3, "2031-02-03"), ("a.pdf", 4, "2031-02-04")]


def test_graph_pairs_in_blocks_and_neighbours(spark):
    rows = [(r, f"n{i}") for r in range(3) for i in range(0, 150, r + 1)]
    df = spark.createDataFrame(rows, "k int, v string")
    want = {}
    for r in range(3):
        mine = sorted(v for k, v in rows if k == r)
        for i, a in enumerate(mine):
            for b in mine[i + 1 :]:
                want[a, b] = want.get((a, b), 0) + 1
    assert {(r["name_a"], r["name_b"]): r["n"] for r in G.pair_counts(df, "k", "v", 16).collect()} == want
    e = spark.createDataFrame([(i, [float(i % 7), float(i % 5), 1.0]) for i in range(60)] + [(99, None), (98, [0.0, 0.0, 0.0])], "vec_id long, embedding array<float>")
    got = G.cosine_neighbours(e, e.where("vec_id in (0, 7, 99)").withColumnRenamed("vec_id", "query_id"), 3, block=1).collect()
    assert {r["query_id"] for r in got} == {0, 7} and [(r["vec_id"], round(r["score"], 6)) for r in sorted(got, key=lambda r: (r["query_id"], r["rn"]))][:2] == [(0, 1.0), (35, 1.0)]
    t = spark.createDataFrame([("a", "b", 9), ("b", "c", 9), ("a", "c", 9), ("c", "x", 1), ("x", "y", 9), ("y", "z", 9), ("x", "z", 9)], "name_a string, name_b string, n long")
    groups = {r["name"]: r["community"] for r in G.communities(t).collect()}
    assert len({groups[n] for n in "abc"}) == 1 and len({groups[n] for n in "xyz"}) == 1 and groups["a"] != groups["x"]


def test_providers(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"one\x0ctwo")
    (tmp_path / "b.bin").write_bytes(b"bad")

    def reader(raw):
        if b"\x0c" not in raw:
            raise ValueError
        return raw.decode().split("\x0c")

    assert [(r["page_no"], r["text"], r["char_count"]) for r in PV.file_pages(PV.binary_files(spark, str(tmp_path)), reader).collect()] == [(1, "one", 3), (2, "two", 3)]
    c = spark.createDataFrame([("c", "AB x AB y"), ("d", None)], "chunk_id string, text string")
    assert [tuple(r) for r in PV.detected(c, lambda t: [(w, "org") for w in t.split() if w.isupper()]).collect()] == [("c", 0, "AB", "org")]
    assert [r["embedding"] for r in PV.embedded(c, "chunk_id", lambda: lambda ts: [[float(len(t))] for t in ts], "q:").collect()] == [[11.0], [2.0]]

    def answer(prompt):
        if "refuse" in prompt:
            raise PermissionError("no")
        return '{"claims": []}' if "not valid" in prompt or "good" in prompt else '{"other": 1}' if "odd" in prompt else "{"

    p = spark.createDataFrame([("1", "good"), ("2", "mend"), ("3", "refuse")], "chunk_id string, prompt string")
    assert [(r["status"], r["attempts"]) for r in PV.extracted(p, answer, ["claims"]).orderBy("chunk_id").collect()] == [("extracted", 1), ("extracted", 2), ("dead_letter", 1)]


def test_reports(spark):
    df = spark.createDataFrame([("abcdefghijklm", 3, None, "", "x  y"), ("z", None, 7, "ROE", None)], "id string, day int, page int, who string, said string")
    lines = [r[0] for r in df.select(reports.claim_line(*[F.col(c) for c in df.columns])).collect()]
    assert lines == ["- [abcdefghij | Day 3] x y", "- [z | Day None, p.7 — ROE] "]
    assert reports.markdown(df.select("id", "day").limit(1)) == "| id | day |\n|---|---|\n| abcdefghijklm | 3 |\n"
    with pytest.raises(ValueError):
        reports.markdown(df, 1)
