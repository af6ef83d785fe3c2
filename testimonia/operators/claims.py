"""Claims: references resolved to entities, rows of the graph, sweeps, and attribution by the labels in the text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from testimonia.functions import text as T
from testimonia.operators import graph as G

# Labels of nodes, and the group in which their names are looked up.
LABEL_GROUPS = {"Person": "person", "Organisation": "org", "Place": "place"}


def dereferenced(refs: DataFrame, entities: DataFrame) -> DataFrame:
    """``refs`` (chunk_id, ref and more) with name and type of the entity of that ref in its chunk; null for a dangling one.

    ``entities``: chunk_id, ref, pos, name, type. Of entities with one ref the last by pos counts.
    """
    last = entities.groupBy("chunk_id", "ref").agg(F.max_by(F.struct("name", "type"), "pos").alias("e"))
    return refs.join(last, ["chunk_id", "ref"], "left").select(*refs.columns, F.col("e")["name"].alias("name"), F.col("e")["type"].alias("type"))


def claim_refs(claims: DataFrame) -> DataFrame:
    """claim_id, role (subject or object), pos, name and type_group of the names in each distinct claim's mentions, subjects first.

    A name without a role is an object; the group comes from the first label and is null for an unknown one.
    """
    m = claims.select("claim_id", "mentions").distinct().select("claim_id", F.posexplode("mentions").alias("i", "m"))
    label = F.get("m.labels", F.lit(0))
    group = F.lit(None).cast("string")
    for k, v in LABEL_GROUPS.items():
        group = F.when(label == k, v).otherwise(group)
    role = F.when(F.col("m.role") == "subject", "subject").otherwise("object")
    return m.select("claim_id", role.alias("role"), (F.when(role == "subject", 0).otherwise(1_000_000) + F.col("i")).alias("pos"), F.trim(F.regexp_replace("m.name", r"\s+", " ")).alias("name"), group.alias("type_group")).where("name <> ''")


def resolved_refs(refs: DataFrame, entities: DataFrame) -> DataFrame:
    """:func:`claim_refs` with entity_id, null where the name or the group resolves to nothing."""
    named = refs.select("type_group", F.col("name").alias("surface")).where("type_group is not null").distinct()
    found = G.resolved(named, entities).where("entity_id is not null").select("type_group", F.col("surface").alias("name"), "entity_id")
    return refs.join(found, ["type_group", "name"], "left")


def resolved_speakers(claims: DataFrame, entities: DataFrame) -> DataFrame:
    """speaker and speaker_entity of the distinct speakers that are persons of the store."""
    s = claims.select(F.lit("person").alias("type_group"), F.col("speaker").alias("surface")).where("surface is not null").distinct()
    return G.resolved(s, entities).where("entity_id is not null").select(F.col("surface").alias("speaker"), F.col("entity_id").alias("speaker_entity"))


def claim_states(claims: DataFrame, chunks: DataFrame, entities: DataFrame) -> DataFrame:
    """Each distinct claim with speaker_id (an entity, or raw: and the label in capitals), its quote's span, and state: ok, no_speaker or no_quote."""
    c = claims.select("claim_id", "chunk_id", "speaker", "text", "quote", "certainty").distinct()
    c = c.join(resolved_speakers(claims, entities), "speaker", "left")
    raw = F.trim(F.coalesce("speaker", F.lit("")))
    c = c.withColumn("speaker_unresolved", F.col("speaker_entity").isNull()).withColumn("speaker_id", F.coalesce("speaker_entity", F.when(raw != "", F.concat(F.lit("raw:"), F.upper(raw)))))
    k = chunks.select("chunk_id", F.col("text").alias("_text")).where("_text is not null").dropDuplicates(["chunk_id"])
    start, end = T.quote_span(F.col("_text"), F.col("quote"))
    c = c.join(k, "chunk_id", "left").withColumn("quote_start", start).withColumn("quote_end", end).drop("_text", "speaker_entity")
    return c.withColumn("state", F.when(F.col("speaker_id").isNull(), "no_speaker").when(F.col("quote_start").isNull(), "no_quote").otherwise("ok"))


def claim_rows(claims: DataFrame, chunks: DataFrame, entities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(core, mentions) of the claims that can be written.

    core: claim_id, key, chunk_id, text, attribution, speaker_id, speaker_unresolved, quote, quote_start, quote_end, certainty,
    has_unresolved_subject, unresolved_subjects, unresolved_objects. mentions: claim_id, entity_id, role, one row per claim
    and entity, a subject before an object. A claim without a speaker or whose quote is not in its text is not written;
    :func:`claim_states` counts them. Names that resolve to nothing stay on the claim as written, in their order.
    """
    ok = claim_states(claims, chunks, entities).where("state = 'ok'")
    key = T.claim_key(F.col("chunk_id"), F.col("speaker_id"), F.coalesce("text", F.lit("")), F.col("quote_start"), F.col("quote_end"))
    refs = resolved_refs(claim_refs(claims), entities)
    mentions = refs.where("entity_id is not null").groupBy("claim_id", "entity_id").agg(F.min_by("role", "pos").alias("role"))
    left = refs.where("entity_id is null").groupBy("claim_id").agg(F.sort_array(F.collect_list(F.struct("pos", "role", "name"))).alias("u"))
    of = lambda r: F.coalesce(F.transform(F.filter("u", lambda x: x["role"] == r), lambda x: x["name"]), F.array().cast("array<string>"))
    core = ok.join(left, "claim_id", "left").withColumn("unresolved_subjects", of("subject")).withColumn("unresolved_objects", of("object"))
    core = core.select("claim_id", key.alias("key"), "chunk_id", "text", F.col("speaker").alias("attribution"), "speaker_id", "speaker_unresolved", "quote", "quote_start", "quote_end", "certainty", (F.size("unresolved_subjects") > 0).alias("has_unresolved_subject"), "unresolved_subjects", "unresolved_objects")
    return core, mentions.join(core.select("claim_id"), "claim_id", "left_semi")


def subject_ids(claims: DataFrame, entities: DataFrame) -> DataFrame:
    """claim_id and id of every subject: an entity, raw: and the normalised name, or ref: and the name where its group is unknown."""
    r = resolved_refs(claim_refs(claims).where("role = 'subject'"), entities)
    other = F.when(F.col("type_group").isNull(), F.concat(F.lit("ref:"), F.col("name"))).otherwise(F.concat(F.lit("raw:"), T.normalise(F.col("name"))))
    return r.select("claim_id", F.coalesce("entity_id", other).alias("id")).distinct()


def canonical_mentions(mentions: DataFrame, entities: DataFrame) -> DataFrame:
    """chunk_id and id of the persons, organisations and places of each chunk: an entity, or raw: and the normalised name."""
    n = G.chunk_names(mentions).select("chunk_id", F.col("kind").alias("type_group"), "name")
    found = G.resolved(n.select("type_group", F.col("name").alias("surface")).distinct(), entities).select("type_group", F.col("surface").alias("name"), "entity_id")
    return n.join(found, ["type_group", "name"], "left").select("chunk_id", F.coalesce("entity_id", F.concat(F.lit("raw:"), T.normalise(F.col("name")))).alias("id")).distinct()


def sweep(claims: DataFrame, subjects: DataFrame, most: float = 0.02) -> DataFrame:
    """One row: claims, structural flags and their rate, claims with dangling subjects, with a pronoun after the verb, and whether the rate is in bounds."""
    c = claims.select("claim_id", "speaker", "text").distinct()
    dangling = subjects.where(F.col("id").startswith("ref:")).select("claim_id").distinct().withColumn("_d", F.lit(1))
    one = lambda x: F.count(F.when(x, 1))
    s = c.join(dangling, "claim_id", "left").agg(F.count("*").alias("claims"), one(T.structurally_asserted(F.col("speaker"), F.coalesce("text", F.lit("")))).alias("structural_flags"), one(F.col("_d").isNotNull()).alias("dangling_subjects"), one(T.predicate_pronoun(F.col("text"))).alias("pronouns"))
    rate = F.coalesce(F.try_divide(F.col("structural_flags").cast("double"), F.col("claims")), F.lit(0.0))
    return s.select("*", rate.alias("structural_rate"), (rate <= most).alias("gate_ok"))


def framing_counts(claims: DataFrame) -> DataFrame:
    """label (the certainty), claims, structural_flags and share: how the distinct claims are framed."""
    c = claims.select("claim_id", "speaker", "text", "certainty", F.xxhash64("quote")).distinct()
    flagged = T.structurally_asserted(F.col("speaker"), F.coalesce("text", F.lit("")))
    g = c.groupBy(F.coalesce("certainty", F.lit("unlabelled")).alias("label")).agg(F.count("*").alias("claims"), F.count(F.when(flagged, 1)).alias("structural_flags"))
    return g.crossJoin(g.agg(F.sum("claims").alias("_n"))).select("label", "claims", "structural_flags", (F.col("claims") / F.col("_n")).alias("share"))  # one row


def _marked(text: Column, pattern: str) -> Column:
    """Labels of a text as array<struct<start, label>>; a mark is put before each, and the parts' lengths give the places."""
    parts = F.split(F.regexp_replace(text, pattern, "\u0001$0"), "\u0001", -1)
    step = F.aggregate(
        F.slice(parts, 2, F.size(parts)), F.struct(F.length(parts[0]).alias("at"), F.array().cast("array<struct<start:int,label:string>>").alias("l")),
        lambda a, x: F.struct((a["at"] + F.length(x)).alias("at"), F.concat(a["l"], F.array(F.struct(a["at"].alias("start"), F.regexp_extract(x, pattern, 1).alias("label")))).alias("l")),
    )
    return step["l"]


def label_inventory(chunks: DataFrame) -> DataFrame:
    """chunk_id, start, speaker, parser: the labels of each text by their place; those of a role and a surname are not seen by the parser."""
    k = chunks.select("chunk_id", "text").where("text is not null").dropDuplicates(["chunk_id"])
    seen = k.select("chunk_id", F.explode(_marked(F.col("text"), T.LABEL_PATTERN)).alias("l")).select("chunk_id", "l.start", "l.label", F.lit(True).alias("parser"))
    blind = k.select("chunk_id", F.explode(_marked(F.col("text"), T.ROLE_SURNAME_PATTERN)).alias("l")).select("chunk_id", "l.start", "l.label", F.lit(False).alias("parser"))
    both = seen.unionByName(blind).groupBy("chunk_id", "start").agg(F.max(F.struct("parser", "label")).alias("b"))
    return both.select("chunk_id", "start", T.normalise_label(F.col("b.label")).alias("speaker"), F.col("b.parser").alias("parser"))


def label_spans(chunks: DataFrame) -> DataFrame:
    """chunk_id, start, stop, speaker of :func:`label_inventory`: a label's words end where the next label begins, or with the text."""
    size = chunks.where("text is not null").dropDuplicates(["chunk_id"]).select("chunk_id", F.length("text").alias("_n"))
    own = label_inventory(chunks).groupBy("chunk_id").agg(F.sort_array(F.collect_list(F.struct("start", "speaker"))).alias("ls")).join(size, "chunk_id")
    spans = own.select("chunk_id", "_n", "ls", F.posexplode("ls").alias("i", "l"))
    return spans.select("chunk_id", "l.start", F.coalesce(F.get("ls", F.col("i") + 1)["start"], "_n").alias("stop"), "l.speaker")


def attribution(claims: DataFrame, chunks: DataFrame, entities: DataFrame) -> DataFrame:
    """claim_id and bucket: whether the speaker of a claim is the one under whose label its quote stands.

    quote_unrecoverable; match; parser_gap, where the nearest label is one that the parser does not see and it names the
    speaker; indeterminate, where no label resolves; else model_wrong.
    """
    c = claim_states(claims, chunks, entities).select("claim_id", "chunk_id", F.coalesce(F.when(~F.col("speaker_unresolved"), F.col("speaker_id")), "speaker").alias("model"), "quote_start")
    labels = label_inventory(chunks).groupBy("chunk_id").agg(F.sort_array(F.collect_list(F.struct("start", "speaker", "parser"))).alias("ls"))
    c = c.join(labels, "chunk_id", "left")
    before = F.filter(F.coalesce("ls", F.array().cast("array<struct<start:int,speaker:string,parser:boolean>>")), lambda x: x["start"] <= F.col("quote_start"))
    c = c.withColumn("aug", F.try_element_at(before, F.lit(-1))).withColumn("own", F.try_element_at(F.filter(before, lambda x: x["parser"]), F.lit(-1)))
    names = c.select(F.explode(F.array(F.col("aug.speaker"), F.col("own.speaker"))).alias("speaker")).where("speaker is not null").distinct()
    ids = resolved_speakers(names, entities)
    a, o = ids.select(F.col("speaker").alias("_a"), F.col("speaker_entity").alias("aug_id")), ids.select(F.col("speaker").alias("_o"), F.col("speaker_entity").alias("own_id"))
    c = c.join(a, F.col("aug.speaker") == F.col("_a"), "left").join(o, F.col("own.speaker") == F.col("_o"), "left")
    same = lambda x: F.coalesce(F.col("model") == F.col(x), F.lit(False))
    bucket = (
        F.when(F.col("quote_start").isNull(), "quote_unrecoverable").when(same("own_id"), "match")
        .when(F.col("aug").isNotNull() & ~F.col("aug.parser") & same("aug_id"), "parser_gap")
        .when(F.col("own_id").isNull() & F.col("aug_id").isNull(), "indeterminate").otherwise("model_wrong")
    )
    return c.select("claim_id", bucket.alias("bucket"), F.col("own.speaker").alias("turn_speaker"), F.col("aug.speaker").alias("augmented_speaker"))


def attribution_rate(buckets: DataFrame) -> DataFrame:
    """One row: a count for each bucket, the comparable claims (match and model_wrong) and the share of them that is wrong."""
    names = ["match", "model_wrong", "parser_gap", "quote_unrecoverable", "indeterminate"]
    b = buckets.agg(F.count("*").alias("total"), *[F.count(F.when(F.col("bucket") == n, 1)).alias(n) for n in names])
    comparable = F.col("match") + F.col("model_wrong")
    return b.select("*", comparable.alias("comparable"), F.coalesce(F.try_divide(F.col("model_wrong").cast("double"), comparable), F.lit(0.0)).alias("error_rate"))
