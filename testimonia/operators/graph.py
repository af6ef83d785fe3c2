"""Entities, mentions, claims and the queries over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from testimonia.functions import text as T
from testimonia.sources.shared import written

# Which types resolve together.
GROUPS = {"acronym": "org"}


def alias_forms(entities: DataFrame) -> DataFrame:
    """Distinct (type_group, form, entity_id) of names and aliases."""
    group = F.when(F.col("entity_type") == "acronym", "org").otherwise(F.col("entity_type"))
    forms = F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))
    return entities.select(group.alias("type_group"), "entity_id", F.explode(forms).alias("f")).select("type_group", T.normalise(F.col("f")).alias("form"), "entity_id").where("form <> ''").distinct()


def alias_index(entities: DataFrame) -> DataFrame:
    """Forms that belong to one entity of their group."""
    return alias_forms(entities).groupBy("type_group", "form").agg(F.min("entity_id").alias("entity_id"), F.count("*").alias("n")).where("n = 1").drop("n")


def bare_index(entities: DataFrame) -> DataFrame:
    """Forms without titles that one entity has, that are no alias, and whose only word no other entity owns."""
    forms = alias_forms(entities)
    bare = forms.withColumn("form", T.strip_titles(F.col("form"))).where("form <> ''").distinct()
    one = bare.groupBy("type_group", "form").agg(F.min("entity_id").alias("entity_id"), F.count("*").alias("n")).where("n = 1").drop("n")
    owners = bare.select("type_group", "entity_id", F.explode(F.split("form", " ")).alias("form")).distinct().groupBy("type_group", "form").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return one.join(forms.select("type_group", "form").distinct(), ["type_group", "form"], "left_anti").join(owners, ["type_group", "form"], "left_anti")


def resolved(rows: DataFrame, entities: DataFrame) -> DataFrame:
    """Adds entity_id to rows with type_group and surface: by full form, else by the form without titles, else null."""
    rows = rows.withColumn("form", T.normalise(F.col("surface")))
    rows = rows.withColumn("bare", T.strip_titles(F.col("form")))
    full = alias_index(entities).withColumnRenamed("entity_id", "_full")
    bare = bare_index(entities).select("type_group", F.col("form").alias("bare"), F.col("entity_id").alias("_bare"))
    return rows.join(full, ["type_group", "form"], "left").join(bare, ["type_group", "bare"], "left").withColumn("entity_id", F.coalesce("_full", "_bare")).drop("_full", "_bare", "bare")


def chunk_names(mentions: DataFrame, kinds: tuple[str, ...] = ("person", "org", "place")) -> DataFrame:
    """Distinct (chunk_id, kind, name) of the mentions, names trimmed with single blanks."""
    m = mentions.distinct()
    parts = [m.select("chunk_id", F.lit(k).alias("kind"), F.explode(k).alias("name")) for k in kinds]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.withColumn("name", F.trim(F.regexp_replace("name", r"\s+", " "))).where("name <> ''").distinct()


def distinct_claims(claims: DataFrame) -> DataFrame:
    return claims.distinct()


def claim_names(claims: DataFrame) -> DataFrame:
    c = distinct_claims(claims).select("claim_id", "chunk_id", F.explode("mentions").alias("m"))
    return c.select("claim_id", "chunk_id", F.trim(F.regexp_replace(F.col("m.name"), r"\s+", " ")).alias("name"), F.col("m.role").alias("role")).where("name <> ''")


def chunk_days(chunks: DataFrame) -> DataFrame:
    return chunks.select("chunk_id", "commission_slug", "day_no", "hearing_date", "doc_sha256", "page_start").distinct()


def first_write_wins(existing: DataFrame, new: DataFrame, key: list[str], order: str) -> DataFrame:
    """``existing`` and, of ``new``, the first row of each key that is not there yet."""
    first = new.withColumn("_rn", F.row_number().over(Window.partitionBy(*key).orderBy(order))).where("_rn = 1").drop("_rn")
    return existing.unionByName(first.join(existing.select(*key), key, "left_anti"))


def last_write_wins(existing: DataFrame, new: DataFrame, key: list[str], order: str) -> DataFrame:
    last = new.withColumn("_rn", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc(order)))).where("_rn = 1").drop("_rn")
    return existing.join(last.select(*key), key, "left_anti").unionByName(last)


def pair_counts(names: DataFrame, key: str, name: str, block: int = 64) -> DataFrame:
    """name_a < name_b and n, the number of distinct ``key`` that hold both; pairs of a key are made in blocks of its names.

    A name's block comes from its hash and the number of names of its key, so no key's names are ever in one task.
    """
    n = names.select(F.col(key).alias("k"), F.col(name).alias("v")).distinct()
    size = n.groupBy("k").agg(F.ceil(F.count("*") / block).alias("n_b"))
    b = n.join(size, "k").withColumn("b", F.pmod(F.xxhash64("v"), "n_b"))
    g = b.groupBy("k", "b").agg(F.collect_list("v").alias("vs"), F.first("n_b").alias("n_b"))
    left = g.select("k", F.col("vs").alias("x"), F.col("b").alias("i"), F.explode(F.sequence(F.col("b"), F.col("n_b") - 1)).alias("b"))
    both = left.join(g.select("k", "b", F.col("vs").alias("y")), ["k", "b"]).select(F.explode("x").alias("p"), "y", (F.col("i") == F.col("b")).alias("same"))
    pairs = both.select("p", F.explode("y").alias("q"), "same").where((F.col("p") < F.col("q")) | (~F.col("same") & (F.col("p") > F.col("q"))))
    return pairs.groupBy(F.least("p", "q").alias("name_a"), F.greatest("p", "q").alias("name_b")).agg(F.count("*").alias("n"))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)


def cosine_top(points: DataFrame, query: list[float], k: int) -> DataFrame:
    """The k points most similar to the query; filter ``points`` first."""
    q = F.array(*[F.lit(float(v)) for v in query])
    score = _dot(F.col("embedding"), q) / F.sqrt(_dot(F.col("embedding"), F.col("embedding")) * _dot(q, q))
    return points.withColumn("score", score).orderBy(F.desc("score"), "vec_id").limit(k)


def cosine_neighbours(points: DataFrame, queries: DataFrame, k: int, block: int = 512) -> DataFrame:
    """query_id, vec_id, score: for each query (query_id, embedding) its k most similar points (vec_id, embedding), exactly.

    Queries are a stated set; they go in blocks against all points, and each task keeps the k best of its points for each
    query of the block, so that a query's rows in the exchange are k for each task and not one for each point. Equal
    scores are put in order by vec_id. A null or zero vector is similar to nothing.
    """
    import numpy as np
    import pandas as pd

    q = queries.where("embedding is not null").select("query_id", "embedding").withColumn("_b", F.floor(F.row_number().over(Window.partitionBy(F.pmod(F.xxhash64("query_id"), F.lit(64))).orderBy("query_id")) / block) * 64 + F.pmod(F.xxhash64("query_id"), F.lit(64)))
    blocks = q.groupBy("_b").agg(F.collect_list(F.struct("query_id", "embedding")).alias("q"))
    parts = points.where("embedding is not null").select("vec_id", "embedding").withColumn("_p", F.spark_partition_id())
    parts = parts.groupBy("_p", F.pmod(F.xxhash64("vec_id"), F.lit(64)).alias("_s")).agg(F.collect_list(F.struct("vec_id", "embedding")).alias("p"))

    def best(batches):  # noqa: ANN001
        for pdf in batches:
            for qs, ps in zip(pdf["q"], pdf["p"]):
                a, b = (np.array([list(x["embedding"]) for x in rows], np.float64) for rows in (qs, ps))
                na, nb = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
                scores = (a @ b.T) / np.outer(np.where(na > 0, na, np.nan), np.where(nb > 0, nb, np.nan))
                ids = np.array([x["vec_id"] for x in ps], np.int64)
                out = []
                for i, x in enumerate(qs):
                    order = np.lexsort((ids, -scores[i]))[:k]
                    out += [(x["query_id"], int(ids[j]), float(scores[i, j])) for j in order if scores[i, j] == scores[i, j]]
                yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    near = parts.select("p").crossJoin(blocks.select("q")).mapInPandas(best, "query_id long, vec_id long, score double")  # a stated query set against all rows, in blocks
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= k)


def hashed_embedding(text: Column, dimension: int = 64) -> Column:
    """A deterministic unit vector of the text from the bytes of its SHA-256: a stand-in for a model's vector. Null for a null text."""
    once = lambda c, f: F.transform(F.array(c), f)[0]
    # a value bound by a lambda is made once; written out, the digest and the norm would be made again for each component
    byte = lambda g: lambda i: (F.conv(F.substring(g, 2 * i + 1, 2), 16, 10).cast("double") - 128) / 128
    raw = once(F.sha2(text, 256), lambda g: F.transform(F.sequence(F.lit(0), F.lit(31)), byte(g)))
    raw = F.slice(F.flatten(F.array_repeat(raw, -(-dimension // 32))), 1, dimension)
    both = once(raw, lambda v: F.struct(v.alias("v"), F.sqrt(_dot(v, v)).alias("n")))
    return F.when(text.isNotNull(), once(both, lambda b: F.transform(b["v"], lambda x: (x / b["n"]).cast("float"))))


def communities(edges: DataFrame, rounds: int = 8) -> DataFrame:
    """name and community of weighted undirected edges (name_a, name_b, n): each name takes, round by round, the label with the most weight around it.

    Weights are log1p(n); of equal labels the smallest is taken, and a name keeps its own label against an equal one. The
    rounds are fixed, so is the result; each is one join and one aggregate, and lineage is cut by written tables.
    """
    e = edges.select("name_a", "name_b", F.log1p("n").alias("w"))
    e = e.unionByName(e.select(F.col("name_b").alias("name_a"), F.col("name_a").alias("name_b"), "w"))
    e = e.unionByName(e.select("name_a", F.col("name_a").alias("name_b"), F.lit(1e-9).alias("w")).distinct())
    e = written(e, "edges")
    labels = e.select(F.col("name_a").alias("name")).distinct().withColumn("community", F.col("name"))
    for _ in range(rounds):
        votes = e.join(labels.select(F.col("name").alias("name_b"), "community"), "name_b").groupBy("name_a", "community").agg(F.round(F.sum("w"), 9).alias("w"))
        best = votes.groupBy(F.col("name_a").alias("name")).agg(F.min_by("community", F.struct((-F.col("w")).alias("w"), F.col("community"))).alias("community"))
        labels = written(best, "labels")
    return labels


def gazetteer(chunks: DataFrame, entities: DataFrame) -> DataFrame:
    """chunk_id, type_group, surface, entity_id: forms of the alias index that stand in a text, whole words, whatever their case.

    Forms are found by their first word in an inverted index of the texts' words, and confirmed in the text.
    """
    k = chunks.select("chunk_id", "text").where("text is not null").dropDuplicates(["chunk_id"]).select("chunk_id", F.concat(F.lit(" "), T.normalise(F.col("text")), F.lit(" ")).alias("t"))
    forms = alias_index(entities).withColumn("first", F.substring_index("form", " ", 1))
    words = k.select("chunk_id", F.explode(F.array_distinct(F.split(F.trim("t"), " "))).alias("first"))
    near = words.join(forms, "first").join(k, "chunk_id")
    return near.where(F.col("t").contains(F.concat(F.lit(" "), F.col("form"), F.lit(" ")))).select("chunk_id", "type_group", F.col("form").alias("surface"), "entity_id").distinct()


def payload(chunks: DataFrame, registry: DataFrame) -> DataFrame:
    """point_id and the nineteen fields of a point, of each distinct passage with what its source knows of it.

    A sha256 under several urls takes the source of the smallest url; a passage without a source has nulls.
    """
    r = registry.where("sha256 is not null").groupBy(F.col("sha256").alias("_sha")).agg(F.min_by(F.struct("source_type", "document_type", "authoritative", "filename", "transcription_method"), F.struct("url", "discovered_at")).alias("r"))
    c = chunks.dropDuplicates(["chunk_id"]).join(r, F.col("doc_sha256") == F.col("_sha"), "left")
    return c.select(
        T.point_id(F.col("chunk_id")).alias("point_id"), "commission_slug", "commission_name", "r.source_type", "r.document_type", "day_no", F.col("hearing_date").alias("date"), "source_url", "r.authoritative", "r.filename",
        F.col("doc_sha256").alias("sha256"), "page_start", "page_end", "time_start", "time_end", "r.transcription_method", "chunk_id", "speakers", "chunk_index", "text",
    )


def payload_filter(points: DataFrame, commission: str | None = None, day: int | None = None, speaker: str | None = None, sha256: str | None = None) -> DataFrame:
    """Points that meet all conditions given; ``speaker`` (in capitals) is any element of speakers."""
    tests = [(commission, F.col("commission_slug") == commission), (day, F.col("day_no") == day), (speaker, F.array_contains("speakers", (speaker or "").upper())), (sha256, F.col("sha256") == sha256)]
    for given, test in tests:
        points = points.where(test) if given is not None else points
    return points


def point_parity(points: DataFrame, chunks: DataFrame, registry: DataFrame) -> DataFrame:
    """One row: distinct points, chunks of documents that are not superseded, chunks without a source, and whether the first two are equal and the last is none."""
    r = registry.where("sha256 is not null").groupBy(F.col("sha256").alias("doc_sha256")).agg(F.max(F.coalesce("superseded_by", F.lit(""))).alias("s"))
    k = chunks.select("chunk_id", "doc_sha256").distinct().join(r, "doc_sha256", "left")
    active = F.countDistinct(F.when(F.coalesce("s", F.lit("")) == "", F.col("chunk_id")))
    k = k.agg(active.alias("active_chunks"), F.countDistinct(F.when(F.col("s").isNull(), F.col("chunk_id"))).alias("no_source"))
    both = points.agg(F.countDistinct("point_id").alias("points")).crossJoin(k)  # one row each
    return both.select("points", "active_chunks", "no_source", ((F.col("points") == F.col("active_chunks")) & (F.col("no_source") == 0)).alias("ok"))


# Words of a body's name that tell nothing apart.
ORG_STOP = {"THE", "OF", "AND", "SERVICES", "SERVICE", "COMMISSION", "DEPARTMENT", "COMPANY", "LIMITED", "PTY", "PROTECTION", "UNIT"}


def neighbourhoods(chunks: DataFrame, mentions: DataFrame, claims: DataFrame, registry: DataFrame) -> DataFrame:
    """Each passage with its day and page, url and document_type of its source, and persons, orgs, places, speakers and claims (claim_id, speaker) as lists.

    Every list is gathered before it is joined, so that none multiplies another. A sha256 under several urls takes the
    smallest. Mentions and claims stay apart. What is not there is an empty list or null.
    """
    c = chunks.dropDuplicates(["chunk_id"]).select("chunk_id", "doc_sha256", "day_no", "hearing_date", "page_start", F.array_distinct(F.filter(F.coalesce("speakers", F.array().cast("array<string>")), lambda x: x.isNotNull())).alias("speakers"))
    r = registry.where("sha256 is not null").groupBy(F.col("sha256").alias("doc_sha256")).agg(F.min_by(F.struct("url", "document_type"), F.struct("url", "discovered_at")).alias("r"))
    n = chunk_names(mentions)
    of = lambda k, a: F.collect_set(F.when(F.col("kind") == k, F.col("name"))).alias(a)
    n = n.groupBy("chunk_id").agg(of("person", "persons"), of("org", "orgs"), of("place", "places"))
    k = claims.groupBy("chunk_id").agg(F.collect_set(F.struct("claim_id", "speaker")).alias("claims"))
    return c.join(r, "doc_sha256", "left").join(n, "chunk_id", "left").join(k, "chunk_id", "left").select("chunk_id", "day_no", "hearing_date", "page_start", "r.url", "r.document_type", "persons", "orgs", "places", "speakers", "claims")


def claim_details(claims: DataFrame, chunks: DataFrame) -> DataFrame:
    """Each distinct claim with what is said (the quote, else the text), day, page and commission of its passage, and mentions (name, role) as a list."""
    c = claims.select("claim_id", "status", "speaker", "speaker_unresolved", "certainty", "attribution", F.coalesce("quote", "text").alias("said"), "chunk_id", "source_url").distinct()
    m = claim_names(claims).groupBy("claim_id").agg(F.collect_set(F.struct("name", "role")).alias("mentions"))
    k = chunks.dropDuplicates(["chunk_id"]).select("chunk_id", "day_no", "page_start", "commission_slug")
    return c.join(k, "chunk_id", "left").join(m, "claim_id", "left")


def people_with(names: DataFrame, body: str) -> DataFrame:
    """Persons named with bodies whose name holds ``body``: one row a person, a passage counting once for each such body."""
    o = names.where("kind = 'org'").where(F.lower("name").contains(body.lower())).groupBy("chunk_id").agg(F.count("*").alias("_n"))
    return names.where("kind = 'person'").join(o, "chunk_id").groupBy("name").agg(F.sum("_n").alias("co_mentions"))


def speaker_labels(chunks: DataFrame, entities: DataFrame) -> DataFrame:
    """name (of the entity, else the label), label and the number of passages."""
    s = chunks.select("chunk_id", F.explode("speakers").alias("label")).where("label is not null").groupBy("label").agg(F.countDistinct("chunk_id").alias("chunks"))
    ids = resolved(s.select(F.lit("person").alias("type_group"), F.col("label").alias("surface")), entities).select(F.col("surface").alias("label"), "entity_id")
    e = entities.select("entity_id", "name").distinct()
    return s.join(ids, "label", "left").join(e, "entity_id", "left").groupBy(F.coalesce("name", "label").alias("name"), "label").agg(F.sum("chunks").alias("chunks"))


def ego_pairs(members: DataFrame, least_shared: int, top: int, least_chunks: int) -> DataFrame:
    """Pairs among the neighbours of the most frequent name of ``members`` (chunk_id, name): name_a, name_b, n.

    Neighbours share ``least_shared`` passages with it; the first ``top`` by these are taken, and then those in ``least_chunks`` passages.
    """
    counts = members.groupBy("name").agg(F.count("*").alias("k"))
    centre = counts.orderBy(F.desc("k"), "name").limit(1).select("name")
    inside = members.join(F.broadcast(centre), "name", "left_semi").select("chunk_id")  # one row
    near = members.join(inside, "chunk_id", "left_semi").join(F.broadcast(centre), "name", "left_anti").groupBy("name").agg(F.count("*").alias("shared")).where(F.col("shared") >= least_shared)
    kept = near.orderBy(F.desc("shared"), "name").limit(top).join(counts.where(F.col("k") >= least_chunks), "name").select("name")
    return pair_counts(members.join(F.broadcast(kept), "name", "left_semi"), "chunk_id", "name")  # ``top`` names at most


def daily_hits(chunks: DataFrame, word: str) -> DataFrame:
    """Per commission and day the passages, and those whose text holds ``word``, whatever its case; days without a hit have 0."""
    c = chunks.where("day_no is not null").select("commission_slug", "day_no", "chunk_id", F.lower("text").contains(word.lower()).alias("h"))
    return c.groupBy("commission_slug", "day_no").agg(F.countDistinct("chunk_id").alias("total"), F.countDistinct(F.when(F.col("h"), F.col("chunk_id"))).alias("hits"))


def stance_labels(claims: DataFrame, entities: DataFrame, contested: int = 5) -> DataFrame:
    """name, asserts, denials, questions and label: ownership for bodies, contested from so many denials, questioned where questions prevail, else asserted."""
    s = claims.select("claim_id", T.modality(F.col("text")).alias("stance")).distinct()
    m = claim_names(claims).select("claim_id", "name").distinct().join(s, "claim_id").distinct()
    n = m.groupBy("name").agg(*[F.count(F.when(F.col("stance") == k, 1)).alias(a) for k, a in (("assert", "asserts"), ("deny", "denials"), ("question", "questions"))])
    orgs = entities.where("entity_type = 'org'").select(T.normalise(F.col("name")).alias("_f")).distinct().withColumn("_o", F.lit(True))
    label = F.when(F.col("_o"), "ownership").when(F.col("denials") >= contested, "contested").when(F.col("questions") > F.col("asserts"), "questioned").otherwise("asserted")
    return n.join(orgs, T.normalise(F.col("name")) == F.col("_f"), "left").select("name", "asserts", "denials", "questions", label.alias("label"))


def unresolved_surfaces(surfaces: DataFrame, entities: DataFrame, chunks: DataFrame, least: int = 2) -> DataFrame:
    """type_group, form, n and days of what is written ``least`` times or more and means no entity."""
    s = surfaces.where("surface is not null").select("surface_id", "chunk_id", F.lower("entity_type").alias("type_group"), "surface").distinct()
    u = resolved(s, entities).where("entity_id is null and form <> ''").join(chunk_days(chunks).select("chunk_id", "day_no"), "chunk_id", "left")
    return u.groupBy("type_group", "form").agg(F.countDistinct("surface_id").alias("n"), F.countDistinct("day_no").alias("days")).where(F.col("n") >= least)


def alias_proposals(surfaces: DataFrame, entities: DataFrame, chunks: DataFrame, least: int = 2) -> DataFrame:
    """type_group, form, n, anchor, proposal, bare_only: where an unresolved writing could belong.

    A person's writing goes by its last word: to the entity that alone owns the word, to AMBIGUOUS: and the word where
    several do, to NEW: and the word where none does. A body's goes by its first word that tells something.
    """
    u = unresolved_surfaces(surfaces, entities, chunks, least)
    bare = alias_forms(entities).withColumn("form", T.strip_titles(F.col("form"))).where("form <> ''")
    owners = bare.where("type_group = 'person'").select(F.explode(F.split("form", " ")).alias("anchor"), "entity_id").groupBy("anchor").agg(F.countDistinct("entity_id").alias("owners"), F.min("entity_id").alias("one"))
    p = u.where("type_group = 'person'").withColumn("bare", T.strip_titles(F.col("form"))).where("bare <> ''").withColumn("anchor", F.substring_index("bare", " ", -1)).join(owners, "anchor", "left")
    to = F.when(F.col("owners") == 1, F.col("one")).when(F.col("owners") > 1, F.concat(F.lit("AMBIGUOUS:"), "anchor")).otherwise(F.concat(F.lit("NEW:"), "anchor"))
    people = p.select("type_group", "form", "n", "anchor", to.alias("proposal"), (~F.col("bare").contains(" ")).alias("bare_only"))
    words = F.filter(F.split("form", " "), lambda x: (F.length(x) > 2) & ~x.isin(*sorted(ORG_STOP)))
    o = u.where("type_group = 'org'").withColumn("anchor", F.coalesce(F.get(words, F.lit(0)), F.col("form")))
    return people.unionByName(o.select("type_group", "form", "n", "anchor", F.concat(F.lit("NEW:"), "anchor").alias("proposal"), F.lit(False).alias("bare_only")))


def loosely_resolved(rows: DataFrame, entities: DataFrame) -> DataFrame:
    """Adds form and entity_id to rows with surface: by letters and figures alone, whatever the type; of several owners the one with the greatest id."""
    forms = entities.select("entity_id", F.explode(F.concat(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>")))).alias("f")).select(T.loose(F.col("f")).alias("form"), "entity_id").where("form <> ''").groupBy("form").agg(F.max("entity_id").alias("entity_id"))
    return rows.withColumn("form", T.loose(F.col("surface"))).join(forms, "form", "left")


def role_of_note(entity_type: Column, note: Column) -> Column:
    """bench, counsel or witness by words of a reviewed note; a body is an org."""
    n = F.lower(F.coalesce(note, F.lit("")))
    return F.when(entity_type == "org", "org").when(n.contains("chairperson") | n.contains("bench") | n.contains("presides"), "bench").when(n.contains("evidence leader") | n.contains("counsel"), "counsel").otherwise("witness")
