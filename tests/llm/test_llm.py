"""Each operator against brute force, an exact round trip or known cases; nulls, empty tables, repeated rows, clashing names."""

import base64
import random

import numpy as np
import pytest

from testimonia.llm import cooccurrence as co, mixture, names, near_duplicates as nd, pieces, repeats, scans, spam, speakers, tokens

EVENTS = "entity string, pos long, start_s double, end_s double, text string, _blk int"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def test_edit_distance():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randint(0, 12))) for _ in range(2))
        assert repeats.edit_distance(a, b) == distance(a, b)


def test_p1_runs(spark):
    rows = [("a", i, float(i), i + 1.0, t, 1) for i, t in enumerate(["one two three", "one two three", "one two thre", "other words here", None, "other words here"])]
    df = spark.createDataFrame(rows + rows[:2] + [(None, None, None, None, "x", 1), ("b", 1, None, None, "", 1)], EVENTS)
    got = {(r["entity"], r["first_pos"], r["last_pos"], r["n_events"]) for r in repeats.collapse_runs(df).collect()}
    assert got == {("a", 0, 2, 3), ("a", 3, 5, 2), (None, None, None, 1)}
    assert repeats.collapse_runs(df.limit(0)).count() == 0


def test_p1_gap_ends_a_run_and_the_caption_is_as_shown(spark):
    rows = [("a", 1, 0.0, 1.0, "one two", "One two."), ("a", 2, 1.5, 2.0, "one two", "ONE two"), ("a", 3, 9.0, 10.0, "one two", "one, two"), ("a", 4, None, None, "one two", "x"), ("a", 5, 30.0, 31.0, "one two", "y")]
    df = spark.createDataFrame(rows, "entity string, pos long, start_s double, end_s double, text string, shown string")
    got = sorted((r["first_pos"], r["last_pos"], r["text"]) for r in repeats.collapse_runs(df, max_gap=2.0).collect())
    assert got == [(1, 2, "One two."), (3, 5, "one, two")]
    assert [r["n_events"] for r in repeats.collapse_runs(df).collect()] == [5]


def test_p1_one_entity_over_many_partitions(spark):
    df = spark.range(4000).selectExpr("'v' as entity", "id as pos", "double(id) as start_s", "double(id + 1) as end_s", "repeat(char(97 + cast(id / 500 as int)), 20) as text", "0 as _blk")
    assert sorted(r["n_events"] for r in repeats.collapse_runs(df).collect()) == [500] * 8


def test_p2_faults(spark):
    body = ["the storekeeper released the ledger to the clerk", "and the storekeeper signed the released ledger", "because the appointment was released before then"]
    pages = [("d", i, "\n".join(["HARROW COMMISSION", *body * 3, f"- {i} -"]), 1) for i in range(1, 7)]
    pages += [("e", 1, "the store-\nkeeper rcleased it\n\n10\nend", 1), ("f", 1, None, 1), ("g", 1, " \n", 1), ("e", 1, "the store-\nkeeper rcleased it\n\n10\nend", 1)]
    df = spark.createDataFrame(pages, "doc_id string, page_no int, text string, furniture int")
    got = {(r["doc_id"], r["line_no"]): r["fault"] for r in scans.faults(df).where("page_no = 1").collect()}
    assert got[("d", 1)] == "furniture" and got[("d", 11)] == "furniture" and got[("e", 1)] == "broken_word" and got[("e", 2)] == "misread" and got[("e", 4)] == "furniture"
    assert not [k for k in got if k[0] in "fg"] and ("e", 5) not in got
    assert scans.faults(df.limit(0)).count() == 0


def test_p2_paragraphs_over_pages(spark):
    body = ["the storekeeper released the ledger to the clerk", "and the storekeeper signed the released ledger", "because the appointment was released before then"]
    pages = [("d", i, "\n".join(["HARROW COMMISSION", *body * 3, f"- {i} -"]), 1) for i in range(1, 7)]
    pages += [("e", 1, "HARROW COMMISSION\nCLERK:  The store-\nkeeper rcleased it\n \nand so it goes on through to the end of it.\nSo be it.\nAnother stretch that is cut after the well-\nknown store-\n- 1 -", 1)]
    pages += [("e", 2, "HARROW COMMISSION\nkeeper and goes on to the end of the line here.\nADV BETA:  No.\n- 2 -", 1), ("f", 1, None, 1), ("g", 1, " \n", 1)]
    df = spark.createDataFrame(pages + pages[-4:-3], "doc_id string, page_no int, text string, paragraph_no int")
    got = [(r["paragraph_no"], r["page_start"], r["page_end"], r["text"], [tuple(x) for x in r["pages"]]) for r in scans.paragraphs(df).where("doc_id = 'e'").orderBy("paragraph_no").collect()]
    first = "CLERK: The storekeeper released it and so it goes on through to the end of it. So be it."
    second = "Another stretch that is cut after the well-known storekeeper and goes on to the end of the line here."
    assert got == [(1, 1, 1, first, [(0, 1)]), (2, 1, 2, second, [(0, 1), (second.index("keeper"), 2)]), (3, 2, 2, "ADV BETA: No.", [(0, 2)])]
    assert scans.paragraphs(df.limit(0)).count() == 0


def test_p3_pieces(spark):
    rng = random.Random(2)
    text = "".join(rng.choice(["Ünïcode wörds. ", "a line\n", "more, ", "end?\n\n"]) for _ in range(3000))
    df = spark.createDataFrame([("a", text, 7), ("b", "x" * 5000, 7), ("c", "", 7), ("d", None, 7)], "id string, text string, piece_no int")
    rows = pieces.split_items(df).orderBy("id", "piece_no").collect()
    assert max(len(r["piece"] or "") for r in rows) <= pieces.MAX_CHARS
    for k, t in (("a", text), ("b", "x" * 5000), ("c", "")):
        mine = [r["piece"] for r in rows if r["id"] == k]
        assert mine[0] + "".join(p[pieces.OVERLAP :] for p in mine[1:]) == t
        assert all(a[-pieces.OVERLAP :] == b[: pieces.OVERLAP] for a, b in zip(mine, mine[1:]))
    assert [r["piece"] for r in rows if r["id"] == "d"] == [None]


def test_p3_files_by_ranges(spark, tmp_path):
    text = "héllo wörld. 汉字 line\n" * 5000
    (tmp_path / "a.txt").write_text(text)
    size = (tmp_path / "a.txt").stat().st_size
    (tmp_path / "b.txt").write_text("")
    paths = spark.createDataFrame([(str(tmp_path / "a.txt"), size), (f"file:{tmp_path}/b.txt", 0)], "path string, size long")
    every = pieces.split_files(spark, paths, range_bytes=10_000)
    got = every.where("path like '%a.txt'")
    assert [(r["piece_no"], r["piece"]) for r in every.where("path like '%b.txt'").collect()] == [(0, "")]
    want = pieces.split_items(spark.createDataFrame([(text,)], "text string"))
    other = pieces.split_items(spark.createDataFrame([(text,)], "text string"), range_chars=977)
    assert sorted((r["piece_no"], r["piece"]) for r in other.collect()) == sorted((r["piece_no"], r["piece"]) for r in want.collect())
    assert sorted((r["piece_no"], r["piece"]) for r in got.collect()) == sorted((r["piece_no"], r["piece"]) for r in want.collect())


TURNS = "doc_id string, turn_no int, speaker string, text string, page_start int, page_end int, who int"


def test_p4_turns(spark):
    rows = [("d", 1, "ADV ALPHA SC", "Good day.", 1, 1, 0), ("d", 2, None, "(coughing)", 1, 1, 0), ("d", 3, "Adv. Alpha", "um, [00:01:02] Next (Pty) Ltd?", 1, 1, 0), ("d", 4, None, "MR BETA: Yes.", 1, 2, 0), ("d", 5, None, "It is so.", 2, 2, 0), ("d", 6, "MS BETA", "No.", 2, 2, 0), ("d", 7, "MS BETA", None, 2, 2, 0)]
    df = spark.createDataFrame(rows + rows[:1] + [(None, None, None, None, None, None, 0)], TURNS)
    got = {r["turn_no"]: r["begins"] for r in speakers.marked_turns(df).where("doc_id = 'd'").collect()}
    assert got == {1: True, 2: False, 3: False, 4: True, 5: False, 6: True, 7: False}
    turns = speakers.clean_turns(df).where("doc_id = 'd'").orderBy("turn_id").collect()
    assert [(r["speaker"], r["text"]) for r in turns] == [("ADV ALPHA SC", "Good day. Next (Pty) Ltd?"), ("MR BETA", "Yes. It is so."), ("MS BETA", "No.")]
    assert speakers.clean_turns(df.limit(0)).count() == 0


def test_p5_counts_and_tails(spark):
    rng = random.Random(3)
    baskets = [{f"i{rng.randint(0, 30)}" for _ in range(rng.randint(1, 8))} for _ in range(200)] + [{f"j{k}" for k in range(150)}] * 2
    df = spark.createDataFrame([(str(r), i, 1) for r, b in enumerate(baskets) for i in b], "record string, item string, n_item int")
    want = {}
    for b in baskets:
        for x in b:
            for y in b:
                if x < y:
                    want[x, y] = want.get((x, y), 0) + 1
    assert {(r["item_a"], r["item_b"]): r["n_ab"] for r in co.pair_counts(df).collect()} == want
    p = np.array([0.2, 0.05])
    draws = np.random.default_rng(1).binomial(10, 0.2, 200_000) + np.random.default_rng(2).binomial(40, 0.05, 200_000)
    assert abs(10 ** co.log10_tail(7, p, np.array([10.0, 40.0])) - (draws >= 7).mean()) < 0.003
    assert co.surprising_pairs(df.limit(0)).count() == 0


def test_p5_all_pairs_are_scored_and_ranked(spark):
    rng = random.Random(8)
    items = [f"i{i}" for i in range(40)]
    rows = {(r, i) for r in range(300) for i in rng.sample(items, 4)} | {(r, x) for r in range(120) for x in ("often", "too")}
    df = spark.createDataFrame(sorted(rows), "record int, item string")
    got = co.surprising_pairs(df).collect()
    of = {}
    for r, i in rows:
        of.setdefault(r, set()).add(i)
    want = {(a, b) for s in of.values() for a in s for b in s if a < b}
    assert len(got) == len(want) and {(r["item_a"], r["item_b"]) for r in got} == want
    often = [r for r in got if (r["item_a"], r["item_b"]) == ("often", "too")]  # in over a third of the records, lift 2.5
    assert often[0]["n_ab"] == 120 and often[0]["q_value"] < 1e-6
    tests, ps, q = 42 * 41 / 2, sorted(10 ** r["log10_p"] for r in got), 1.0
    for i in range(len(ps) - 1, -1, -1):
        q = min(q, ps[i] * tests / (i + 1))
        ps[i] = q
    assert all(abs(a - b) <= 0.01 * b + 1e-300 for a, b in zip(sorted(r["q_value"] for r in got), ps))


def test_p6_names(spark):
    e = spark.createDataFrame([("p:a", "Lt-Gen Samuel Trodathova", "person", ["Sam Trodathova"]), ("p:b", "Prof Victoria Trodathova", "person", None), ("p:c", "Col James Kvomeste", "person", [" "]), ("o:a", "Central Division of Railway Surveillance", "org", ["CDRS"]), ("l:a", "Kollridge", "place", [])], "entity_id string, name string, entity_type string, aliases array<string>")
    cases = {"Col Kvomeste": "p:c", "KVOMESTE, JAMES": "p:c", "j. kvomeste": "p:c", "Jmaes Kvomeste": "p:c", "COLONEL KVOMETSE": "p:c", "Trodathova": None, "Sam Trodathova": "p:a", "PROF. TRODATHOVA": "p:b", "Robert Kvomeste": None, "K. Kvomeste": None, "the witness": None, " ": None}
    w = [("person", k) for k in cases] + [("org", "C.D.R.S."), ("org", "Railway Surveillance, Central Division of"), ("org", "Centr. Div. for Railway Surveillance"), ("org", "Central Division of Railway Recovery"), ("place", "Kolridge"), ("person", None), (None, "x")]
    got = {r["writing"]: r["entity_id"] for r in names.resolve(spark.createDataFrame(w, "type string, writing string"), e).collect()}
    assert got == {**{k: v for k, v in cases.items() if v}, "C.D.R.S.": "o:a", "Railway Surveillance, Central Division of": "o:a", "Centr. Div. for Railway Surveillance": "o:a", "Kolridge": "l:a"}


def test_p6_aliases_that_the_name_does_not_give(spark):
    e = spark.createDataFrame([("p:c", "Justice Orla Emaskinuma", "person", ["CHAIRPERSON", "THE CHAIRPERSON", "The Boss", None]), ("p:n", "Lt-Gen Nat Wye", "person", ["GENERAL WYE", "The Boss"]), ("p:k", "Mr Pat Wye", "person", None)], "entity_id string, name string, entity_type string, aliases array<string>")
    cases = {"CHAIRPERSON": "p:c", "Chairperson:": "p:c", "the  Chairperson": "p:c", "Chairperson, The": "p:c", "Chairpreson": "p:c", "THE CHAIRPERSN": "p:c", "General Wye": "p:n", "The Boss": None, "Chair": None, "Mr Wye": "p:k", "Wye": None}
    w = spark.createDataFrame([("person", k) for k in cases], "type string, writing string")
    assert {r["writing"]: r["entity_id"] for r in names.resolve(w, e).collect()} == {k: v for k, v in cases.items() if v}


def test_p7_pairs_against_brute_force(spark):
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(400)]
    docs = {}
    for i in range(30):
        base = [rng.choice(vocab) for _ in range(300)]
        for k in range(3):
            docs[f"d{i}-{k}"] = [w if rng.random() > 0.04 * k else rng.choice(vocab) for w in base]
    docs["copy"] = docs["d0-0"]
    rows = [(d, p, " ".join(w[p * 150 : (p + 1) * 150]), 0) for d, w in docs.items() for p in range(2)] + [("none", 1, None, 0), (None, 1, "a b c", 0), ("blank", 1, " ", 0)]
    df = spark.createDataFrame(rows, "doc_id string, page_no int, text string, blk int")
    sets = {d: set(zip(w, w[1:], w[2:])) for d, w in docs.items()}
    members, links = nd.similar_documents(df)
    cls = {r["doc_id"]: r["class_id"] for r in members.collect()}
    assert cls["copy"] == cls["d0-0"] == "copy" and set(cls) == set(docs)
    want = {tuple(sorted((a, b))) for a in sets for b in sets if a < b and cls[a] == a and cls[b] == b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.55}
    assert {(r["class_a"], r["class_b"]) for r in links.collect()} == want
    assert nd.similar_documents(df.limit(0))[0].count() == 0


@pytest.mark.parametrize("versions,region", [(100, nd.REGION), (100, 8), (1000, nd.REGION), (1000, 40)])
def test_p7_recall_in_large_families(spark, versions, region):
    """Brute force over one family: no pair is lost because its regions are full."""
    rng = np.random.default_rng(versions)
    base = rng.integers(0, 2**63, 300, dtype=np.uint64)
    hashes = [np.unique(nd.sequence_hashes(np.where(rng.random(300) < 0.05, rng.integers(0, 2**63, 300, dtype=np.uint64), base))) for _ in range(versions)]
    reps = spark.createDataFrame([(i, sig.view(np.int32).tolist(), nd.sketch(sig)) for i, sig in enumerate(map(nd.signature, hashes))], "id long, sig array<int>, sketch array<bigint>")
    got = {(r["a"], r["b"]) for r in nd.forest_pairs(reps, region=region).collect()}
    every, of = np.unique(np.concatenate(hashes), return_inverse=True)
    sets = np.zeros((versions, len(every)), np.float32)
    sets[np.repeat(np.arange(versions), [len(h) for h in hashes]), of] = 1
    both, size = sets @ sets.T, sets.sum(1)
    j = both / (size[:, None] + size[None, :] - both)
    for low, high in ((0.55, 0.6), (0.6, 0.65)):
        near = list(zip(*np.nonzero(np.triu((j >= low) & (j < high), 1))))
        recall = sum((int(a), int(b)) in got for a, b in near) / len(near)
        print(versions, region, low, len(near), round(recall, 4))
        assert len(near) > 500 and recall >= 0.97


def test_p8_ids_are_exact(spark):
    tiktoken, P = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(5)
    signs = ["the ", "'s", "é", "\x1c", "\xa0", " ", "9", "²", "\r\n", "漢", "😀", "́", "aaaaaaaaaa", "<|endoftext|>", "=" * 50]
    texts = ["", None, "=" * 5000, "a" * 3000] + ["".join(rng.choice(signs) for _ in range(30)) for _ in range(300)]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, ids int")
    got = {r["doc_id"]: r["ids"] for r in tokens.encode_texts(df, lexicon=50).collect()}
    assert all(got[i] == enc.encode_ordinary(t or "") for i, t in enumerate(texts))


def test_p8_automaton_gives_all_words():
    rng = random.Random(6)
    entries = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 7))).encode(): [rng.randint(0, 99) for _ in range(rng.randint(1, 3))] for _ in range(500)}
    lex = tokens.Lexicon(np.frombuffer(tokens.compile_lexicon(entries), np.uint8))
    assert all(lex.get(w) == ids for w, ids in entries.items()) and lex.get(b"abcabcabcabc") is None and lex.get(b"z") is None


def test_p9_shares_and_caps(spark):
    rows = [(i, "some words of text " * (1 + i % 7), s, lang, "T", 0) for i, (s, lang) in enumerate([("a", "en")] * 400 + [("a", "af")] * 100 + [("b", "en")] * 60 + [("z", None)] * 50)]
    rows += [(10_000, None, "a", "en", "T", 0), (10_001, "", "b", "en", "T", 0)]
    docs = spark.createDataFrame([(i, (t or "") + (f" n{i}" if t else "") if t is not None else None, s, x, k, u) for i, t, s, x, k, u in rows], "doc_id long, text string, source string, lang string, document_type string, n_uses int")
    aim = spark.createDataFrame([("a", 0.6, 1), ("b", 0.3, 4), ("none", 0.1, 2)], "source string, target_share double, max_repeats int")
    mixed = mixture.mix_sources(docs, aim)
    got = {r["source"]: r for r in mixture.shares_reached(mixed, aim).collect()}
    assert abs(got["a"]["actual_share"] - 2 / 3) < 0.01 and abs(got["b"]["actual_share"] - 1 / 3) < 0.01 and got["none"]["actual_share"] == 0
    assert got["a"]["most_uses"] <= 1 and got["b"]["most_uses"] <= 4
    assert mixture.mix_sources(docs.limit(0), aim).count() == 0


GOOD = ["The witness said that the ledger was kept at the registry.", "It is recorded that nobody had told the clerk about it.", "He could not confirm what was said before the meeting."]


def test_p9_large_documents_keep_their_chance(spark):
    """A document larger than its source's whole target is drawn by its probability, as any other."""
    use, tokens = np.full(101, 0.25), np.array([4000.0] + [10.0] * 100)
    rng = np.random.default_rng(3)
    drawn = np.array([mixture._whole_uses(use, tokens, np.ones(101), rng.random(101)) for _ in range(2000)])
    assert abs(drawn[:, 0].mean() - 0.25) < 0.03 and drawn.max() == 1
    used = (drawn * tokens).sum(1)
    assert set(drawn[drawn[:, 0] == 0].sum(1)) == {100} and (used[drawn[:, 0] == 1] == 4000).all()


def test_p10_pages(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice(GOOD) for _ in range(12)), "en", 0) for i in range(120)]
    rows += [(900, "cheap notary, hearing video, " * 30, "en", 0), (901, "\n".join(f"* [page {i}](https://x.example/{i})" for i in range(40)), "en", 0), (902, " ".join(GOOD * 4) + "\nHome » Login » Share »", None, 0), (903, None, "en", 0), (904, "", "en", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, distance int")
    assert {r["doc_id"] for r in spam.judged(df).where("is_spam").collect()} == {900, 901}
    assert spam.judged(df.limit(0)).count() == 0


def test_p10_function_words_are_learnt_by_language(spark):
    rows = [(i, "blik tor mes gan. " * 3 + f"word{i}", "xx") for i in range(60)] + [(i, "the cat sat. a" + str(i), "en-GB") for i in range(100, 103)]
    lists, sizes = spam.learned_words(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert lists == {"xx": frozenset({"blik", "tor", "mes", "gan"})} and sizes == {"xx": 60, "en": 3}


def test_p10_the_distance_changes_the_rows(spark):
    """Forms whose lists are usual for their language are no outliers, though more than half of them is a list."""
    rng = random.Random(11)
    names = [f"name{i}" for i in range(400)]
    forms = [(i, "die vorm is hier. " * 2 + "\n".join(" ".join(rng.sample(names, 3)) for _ in range(rng.randint(4, 9))), "af") for i in range(200)]
    rows = forms + [(1000 + i, " ".join(rng.choice(GOOD) for _ in range(12)), "en") for i in range(200)]
    rows += [(2000, "The witness said so. " + "\n".join(" ".join(rng.sample(names, 3)) for _ in range(40)), "en")]
    got = spam.judged(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    by_share = {r["doc_id"] for r in got if r["list_share"] > spam.SHARE}
    assert len(by_share) > 100 and {r["doc_id"] for r in got if r["is_spam"]} == {2000}
