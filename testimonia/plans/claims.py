"""Queries over claims: rows of the graph, attribution, sweeps, strata, samples and arms."""

from __future__ import annotations

from pyspark.sql import functions as F

from testimonia.plans.base import _FORMS, _INDEX, _NAMES, _NORM, _PROCEDURAL_SQL, _STRIP, _VERBS, _t, query
from testimonia.plans.parsing import _label_sql
from testimonia import reports as R
from testimonia.functions import text as T
from testimonia.operators import claims as CL, evaluation as E

_CL = "cl as (select distinct claim_id, chunk_id, speaker, text, quote, certainty from claims)"
_SP = f"""sp as (select s.speaker, coalesce(a.entity_id, b.entity_id) as sid from (select distinct speaker, {_NORM.format('speaker')} as fm, {_STRIP.format(_NORM.format('speaker'))} as st from cl where speaker is not null) s
  left join a on a.type_group = 'person' and a.form = s.fm left join b on b.type_group = 'person' and b.form = s.st)"""
_PAT = r"""regexp_replace(regexp_replace(regexp_replace(quote, '([\\.\[\]{}()*+?^$|#&~-])', '\\\1', 'g'), ' ', '\\s', 'g'), '[\n\t\r\v\f]+', '\\s+', 'g')"""
_SPAN = rf"""k as (select chunk_id, any_value(text) as ktext from chunks where text is not null group by chunk_id),
q as (select cl.*, k.ktext, strpos(k.ktext, quote) as p, case when strpos(k.ktext, quote) = 0 and regexp_matches(quote, '\s') then regexp_extract(k.ktext, {_PAT}) end as found from cl left join k on k.chunk_id = cl.chunk_id),
z as (select * exclude (p, found, ktext), case when p > 0 then p - 1 when found <> '' then strpos(ktext, found) - 1 end as quote_start, case when p > 0 then p - 1 + length(quote) when found <> '' then strpos(ktext, found) - 1 + length(found) end as quote_end from q)"""
_STATE = f"""{_FORMS}, {_INDEX}, {_CL}, {_SP}, {_SPAN},
st as (select z.*, sp.sid is null as speaker_unresolved, coalesce(sp.sid, case when trim(coalesce(z.speaker, '')) <> '' then 'raw:' || upper(trim(z.speaker)) end) as speaker_id from z left join sp on sp.speaker = z.speaker),
sx as (select *, case when speaker_id is null then 'no_speaker' when quote_start is null then 'no_quote' else 'ok' end as state from st)"""
_REFS = rf"""m as (select claim_id, unnest(mentions) as m, generate_subscripts(mentions, 1) as i from (select distinct claim_id, mentions from claims)),
rf as (select claim_id, case when m.role = 'subject' then 'subject' else 'object' end as role, case when m.role = 'subject' then 0 else 1000000 end + i - 1 as pos, trim(regexp_replace(m.name, '\s+', ' ', 'g')) as name,
  case m.labels[1] when 'Person' then 'person' when 'Organisation' then 'org' when 'Place' then 'place' end as type_group from m where trim(regexp_replace(m.name, '\s+', ' ', 'g')) <> ''),
rn as (select r.*, coalesce(a.entity_id, b.entity_id) as entity_id from (select *, {_NORM.format('name')} as fm, {_STRIP.format(_NORM.format('name'))} as st from rf) r
  left join a on a.type_group = r.type_group and a.form = r.fm left join b on b.type_group = r.type_group and b.form = r.st)"""


def _tables(spark, d):
    return _t(spark, d, "claims", "chunks", "entities")


@query("f10_quote_spans", f"with {_CL}, {_SPAN} select claim_id, quote_start, quote_end from z where quote <> ''")
def _(spark, d):
    return CL.claim_states(*_tables(spark, d)).where("quote <> ''").select("claim_id", "quote_start", "quote_end")


@query("t10_claim_states", f"with {_STATE} select state, speaker_unresolved, count(*) as claims from sx group by all")
def _(spark, d):
    return CL.claim_states(*_tables(spark, d)).groupBy("state", "speaker_unresolved").agg(F.count("*").alias("claims"))


@query("t10_claim_rows", rf"""with {_STATE}, {_REFS}, u as (select claim_id, string_agg(name, ' | ' order by pos) filter (where role = 'subject') as us, string_agg(name, ' | ' order by pos) filter (where role = 'object') as uo from rn where entity_id is null group by claim_id)
select s.claim_id, sha256(chunk_id || '|' || speaker_id || '|' || regexp_replace(lower(trim(coalesce(text, ''))), '\s+', ' ', 'g') || '|' || quote_start || ':' || quote_end) as key, speaker_id, speaker_unresolved, quote_start, quote_end, u.us is not null as has_unresolved_subject, coalesce(u.us, '') as unresolved_subjects, coalesce(u.uo, '') as unresolved_objects
from sx s left join u on u.claim_id = s.claim_id where state = 'ok'""")
def _(spark, d):
    core, _ = CL.claim_rows(*_tables(spark, d))
    return core.select("claim_id", "key", "speaker_id", "speaker_unresolved", "quote_start", "quote_end", "has_unresolved_subject", *[F.array_join(c, " | ").alias(c) for c in ("unresolved_subjects", "unresolved_objects")])


@query("t10_claim_mentions", f"with {_STATE}, {_REFS} select r.claim_id, r.entity_id, arg_min(r.role, r.pos) as role from rn r join sx on sx.claim_id = r.claim_id and sx.state = 'ok' where r.entity_id is not null group by all")
def _(spark, d):
    return CL.claim_rows(*_tables(spark, d))[1].select("claim_id", "entity_id", "role")


@query("a14_graph_counters", f"""with {_STATE}, {_REFS}, o as (select r.* from rn r join sx on sx.claim_id = r.claim_id and sx.state = 'ok')
select (select count(*) from sx where state = 'ok') as claims_written, (select count(*) from sx where speaker_unresolved) as speakers_unresolved, (select count(*) from sx where state = 'no_quote') as quotes_unrecovered,
 (select count(distinct (claim_id, entity_id)) from o where entity_id is not null) as mention_edges, (select count(*) from o where entity_id is null and role = 'subject') as unresolved_subjects, (select count(*) from o where entity_id is null and role = 'object') as unresolved_objects""")
def _(spark, d):
    one = lambda x: F.count(F.when(x, 1))
    states = CL.claim_states(*_tables(spark, d)).agg(one(F.col("state") == "ok").alias("claims_written"), one(F.col("speaker_unresolved")).alias("speakers_unresolved"), one(F.col("state") == "no_quote").alias("quotes_unrecovered"))
    core, mentions = CL.claim_rows(*_tables(spark, d))
    edges = mentions.agg(F.count("*").alias("mention_edges"))
    loose = core.agg(*[F.coalesce(F.sum(F.size(c)), F.lit(0)).cast("long").alias(c) for c in ("unresolved_subjects", "unresolved_objects")])
    return states.crossJoin(edges).crossJoin(loose)  # one row each


@query("j4_dereference", rf"""with e as (select chunk_id, 'e' || (surface_id % 7) as ref, surface_id as pos, surface as name, lower(entity_type) as type from (select distinct * from surfaces)),
l as (select chunk_id, ref, arg_max({{'n': name, 't': type}}, pos) as e from e group by all), r as (select distinct claim_id, chunk_id, unnest(['e0', 'e3', 'e9']) as ref from claims)
select r.claim_id, r.ref, l.e.n as name, l.e.t as type from r left join l on l.chunk_id = r.chunk_id and l.ref = r.ref""")
def _(spark, d):
    """References of claims to numbered entities of their passage, some given twice and some to none."""
    e = _t(spark, d, "surfaces").distinct().select("chunk_id", F.concat(F.lit("e"), F.col("surface_id") % 7).alias("ref"), F.col("surface_id").alias("pos"), F.col("surface").alias("name"), F.lower("entity_type").alias("type"))
    r = _t(spark, d, "claims").select("claim_id", "chunk_id").distinct().withColumn("ref", F.explode(F.array(*[F.lit(x) for x in ("e0", "e3", "e9")])))
    return CL.dereferenced(r, e).select("claim_id", "ref", "name", "type")


_SUBJECTS = f"""su as (select distinct claim_id, coalesce(entity_id, case when type_group is null then 'ref:' || name else 'raw:' || {_NORM.format('name')} end) as id from rn where role = 'subject')"""


@query("t11_subject_ids", f"with {_FORMS}, {_INDEX}, {_REFS}, {_SUBJECTS} select claim_id, id from su")
def _(spark, d):
    c, _, e = _tables(spark, d)
    return CL.subject_ids(c, e)


_MENTIONED = f"""mi as (select distinct n.chunk_id, coalesce(a.entity_id, b.entity_id, 'raw:' || n.fm) as id from (select *, {_NORM.format('name')} as fm, {_STRIP.format(_NORM.format('name'))} as st from n) n
  left join a on a.type_group = n.kind and a.form = n.fm left join b on b.type_group = n.kind and b.form = n.st)"""


@query("t11_chunk_ids", f"with {_NAMES}, {_FORMS}, {_INDEX}, {_MENTIONED} select * from mi")
def _(spark, d):
    return CL.canonical_mentions(*_t(spark, d, "mentions", "entities"))


_FLAGGED = rf"(trim(coalesce(speaker, '')) = '' or not list_has_any(string_split_regex(lower(trim(coalesce(text, ''))), '\s+')[1:4], {_VERBS}))"
_PRONOUN = r"regexp_matches(text, '(?i)\b(?:" + "|".join(T.REPORTED_VERBS) + r")\b\s+(?:that\s+)?(he|she|they|it|his|her|their)\b')"


@query("a19_sweep", f"""with {_FORMS}, {_INDEX}, {_CL}, {_REFS}, {_SUBJECTS}, c as (select cl.*, su.claim_id is not null as dangling from (select distinct claim_id, speaker, text from claims) cl left join (select distinct claim_id from su where id like 'ref:%') su on su.claim_id = cl.claim_id),
s as (select count(*) as claims, count(*) filter (where {_FLAGGED}) as structural_flags, count(*) filter (where dangling) as dangling_subjects, count(*) filter (where {_PRONOUN}) as pronouns from c)
select *, coalesce(structural_flags / claims::double, 0) as structural_rate, coalesce(structural_flags / claims::double, 0) <= 0.02 as gate_ok from s""")
def _(spark, d):
    c, _, e = _tables(spark, d)
    return CL.sweep(c, CL.subject_ids(c, e))


@query("p12_predicate_pronouns", f"with {_CL} select claim_id, {_PRONOUN} as pronoun from cl where text is not null")
def _(spark, d):
    return _t(spark, d, "claims").select("claim_id", "text").distinct().where("text is not null").select("claim_id", T.predicate_pronoun(F.col("text")).alias("pronoun"))


_STRENGTH = f"(case when regexp_matches(text, '{T.STRONG}') then 2.0::double else 0.0::double end + least(length(text), 140) / 140::double)"


@query("f12_w11_best_claims", f"with {_CL}, {_REFS.split(',' + chr(10) + 'rn as')[0]}, x as (select distinct rf.name, cl.claim_id, {_STRENGTH} as score from rf join cl on cl.claim_id = rf.claim_id where cl.text is not null) select name, score, claim_id from (select *, row_number() over (partition by name order by score desc, claim_id) as rn from x) where rn = 1")
def _(spark, d):
    c = _t(spark, d, "claims")
    s = c.select("claim_id", "text").distinct().where("text is not null").select("claim_id", T.claim_strength(F.col("text")).alias("score"))
    best = CL.claim_refs(c).select("name", "claim_id").distinct().join(s, "claim_id").groupBy("name").agg(F.min(F.struct((-F.col("score")).alias("n"), "claim_id")).alias("b"))
    return best.select("name", (-F.col("b.n")).alias("score"), F.col("b.claim_id").alias("claim_id"))


# --- attribution ----------------------------------------------------------------------------------------------------


def _found(pattern: str) -> str:
    p = pattern.replace("(?:^|(?<=\\s))", "").replace("'", "''")
    return rf"string_split(regexp_replace(text, '(^|\s)({p})', '\1' || chr(1) || '\2', 'g'), chr(1))"


def _labels(name: str, pattern: str, seen: str) -> str:
    p = pattern.replace("(?:^|(?<=\\s))", "").replace("'", "''")
    return rf"""{name} as (select chunk_id, unnest(parts[2:]) as s, generate_subscripts(parts[2:], 1) as i, parts from (select chunk_id, {_found(pattern)} as parts from (select chunk_id, any_value(text) as text from chunks where text is not null group by chunk_id))),
{name}l as (select chunk_id, cast(list_sum(list_transform(parts[1:i], lambda y: length(y))) as bigint) as start, regexp_extract(s, '^{p}', 1) as label, {seen} as parser from {name})"""


_INVENTORY = f"""{_labels("la", T.LABEL_PATTERN, "true")}, {_labels("lb", T.ROLE_SURNAME_PATTERN, "false")},
lx as (select chunk_id, start, max({{'parser': parser, 'label': label}}) as b from (select * from lal union all select * from lbl) group by all)"""


_LABELS = f"{_INVENTORY}, lab as (select chunk_id, start, {_label_sql('b.label')} as speaker, b.parser as parser from lx)"


@query("t8_labels", f"with {_LABELS} select * from lab")
def _(spark, d):
    return CL.label_inventory(_t(spark, d, "chunks"))


_BUCKETS = f"""{_STATE}, {_LABELS},
an as (select sx.claim_id, case when not sx.speaker_unresolved then sx.speaker_id else sx.speaker end as model, sx.quote_start, arg_max(lab.speaker, lab.start) as aug, arg_max(lab.parser, lab.start) as aug_seen, arg_max(lab.speaker, lab.start) filter (where lab.parser) as own
  from sx left join lab on lab.chunk_id = sx.chunk_id and lab.start <= sx.quote_start group by all),
ls as (select l.speaker, coalesce(a.entity_id, b.entity_id) as id from (select distinct speaker, {_NORM.format('speaker')} as fm, {_STRIP.format(_NORM.format('speaker'))} as stf from lab) l left join a on a.type_group = 'person' and a.form = l.fm left join b on b.type_group = 'person' and b.form = l.stf),
bk as (select an.*, x.id as aug_id, y.id as own_id from an left join ls x on x.speaker = an.aug left join ls y on y.speaker = an.own),
bu as (select claim_id, case when quote_start is null then 'quote_unrecoverable' when coalesce(model = own_id, false) then 'match' when aug is not null and not aug_seen and coalesce(model = aug_id, false) then 'parser_gap' when own_id is null and aug_id is null then 'indeterminate' else 'model_wrong' end as bucket, own as turn_speaker, aug as augmented_speaker from bk)"""


@query("t9_j7_attribution", f"with {_BUCKETS} select * from bu")
def _(spark, d):
    return CL.attribution(*_tables(spark, d))


@query("a17_attribution_rate", f"""with {_BUCKETS}, c as (select count(*) as total, {', '.join(f"count(*) filter (where bucket = '{b}') as {b}" for b in ('match', 'model_wrong', 'parser_gap', 'quote_unrecoverable', 'indeterminate'))} from bu)
select *, match + model_wrong as comparable, coalesce(model_wrong / nullif(match + model_wrong, 0)::double, 0) as error_rate from c""")
def _(spark, d):
    return CL.attribution_rate(CL.attribution(*_tables(spark, d)))


# --- strata, samples, arms ----------------------------------------------------------------------------------------------------

_KINDS = f"""{_FORMS}, bf as (select entity_id, {_STRIP.format('form')} as form from f where type_group = 'person'),
pn as (select {_STRIP.format(_NORM.format('name'))} as n, unnest(aliases) as a from entities where entity_type = 'person'), po as (select n, {_NORM.format('a')} as form, {_STRIP.format(_NORM.format('a'))} as w from pn),
ki as (select 'ambiguous_surname' as kind, form from bf where form <> '' group by form having count(distinct entity_id) > 1 union
 select 'ocr_variant', form from po where form not in {_PROCEDURAL_SQL} and w <> '' and not list_has_any(string_split(n, ' '), string_split(w, ' ')) union
 select 'high_acronym', form from f where type_group in ('org', 'place') and regexp_matches(form, '^[A-Z]{{2,6}}$'))"""


@query("t13_stratum_forms", f"with {_KINDS} select * from ki")
def _(spark, d):
    return E.stratum_forms(_t(spark, d, "entities"))


_STRATA = rf"""{_KINDS}, ck as (select chunk_id, any_value(text) as text from chunks where text is not null group by chunk_id),
tk as (select chunk_id, unnest(list_distinct(regexp_extract_all(upper(text), '[\p{{L}}\p{{N}}\p{{M}}_]+'))) as w from ck),
ht as (select tk.chunk_id, ki.kind, case when ki.kind = 'high_acronym' then len(regexp_extract_all(ck.text, '\b' || ki.form || '\b')) else len(regexp_extract_all(ck.text, '(?i)\b' || ki.form || '\b')) end as n from tk join ki on tk.w = regexp_extract(ki.form, '[\p{{L}}\p{{N}}_]+') join ck on ck.chunk_id = tk.chunk_id),
hs as (select chunk_id, coalesce(sum(n) filter (where kind = 'ambiguous_surname'), 0) as am, coalesce(sum(n) filter (where kind = 'ocr_variant'), 0) as oc, coalesce(sum(n) filter (where kind = 'high_acronym'), 0) as ac from ht group by chunk_id),
sr as (select ck.chunk_id, case when coalesce(am, 0) > 0 then 'ambiguous_surname' when coalesce(oc, 0) > 0 then 'ocr_variant' when 1000 * coalesce(ac, 0) / greatest(1, len(regexp_extract_all(text, '[\p{{L}}\p{{N}}_''-]*[\p{{L}}\p{{N}}_][\p{{L}}\p{{N}}_''-]*')))::double >= 6 then 'high_acronym'
  when 1000 * len(regexp_extract_all(text, '{T.ALLEGATION}')) / greatest(1, len(regexp_extract_all(text, '[\p{{L}}\p{{N}}_''-]*[\p{{L}}\p{{N}}_][\p{{L}}\p{{N}}_''-]*')))::double >= 12 then 'allegation_dense' else 'control' end as stratum from ck left join hs on hs.chunk_id = ck.chunk_id)"""


@query("f21_strata", f"with {_STRATA} select * from sr")
def _(spark, d):
    return E.strata(*_t(spark, d, "chunks", "entities"))


_SAMPLE = f"""{_STRATA}, rk as (select *, row_number() over (partition by stratum order by sha256('17:' || chunk_id), chunk_id) as r, list_position({E.STRATA}, stratum) as o from sr),
sm as (select chunk_id, stratum from rk where r <= 40 order by greatest(r - 8, 0), o, r limit 40)"""


@query("t14_stratified_sample", f"with {_SAMPLE} select * from sm")
def _(spark, d):
    return E.stratified_sample(E.strata(*_t(spark, d, "chunks", "entities")))


def _arms(spark, d):
    """The mentions of the passages as the reference arm, the names in their claims as the candidate's."""
    m, c, e = _t(spark, d, "mentions", "claims", "entities")
    refs = CL.resolved_refs(CL.claim_refs(c), e).where("type_group is not null")
    ids = refs.select("claim_id", F.coalesce("entity_id", F.concat(F.lit("raw:"), T.normalise(F.col("name")))).alias("id")).distinct()
    return CL.canonical_mentions(m, e), ids.join(c.select("claim_id", "chunk_id").distinct(), "claim_id").select("chunk_id", "id").distinct()


_ARMS = f"""{_NAMES}, {_FORMS}, {_INDEX}, {_REFS}, {_MENTIONED}, ca as (select distinct c.chunk_id, coalesce(r.entity_id, 'raw:' || {_NORM.format('r.name')}) as id from rn r join (select distinct claim_id, chunk_id from claims) c on c.claim_id = r.claim_id where r.type_group is not null),
dn as (select chunk_id from mi intersect select chunk_id from ca),
ab as (select coalesce(x.chunk_id, y.chunk_id) as chunk_id, coalesce(x.id, y.id) as id, x.id is not null as r, y.id is not null as c from (select * from mi where chunk_id in (from dn)) x full join (select * from ca where chunk_id in (from dn)) y on x.chunk_id = y.chunk_id and x.id = y.id)"""


def _prf(src: str, by: str = "") -> str:
    head = f"{by}, " if by else ""
    return f"""(select {head}tp, fp, fn, coalesce(tp / nullif(tp + fp, 0)::double, 0) as prec, coalesce(tp / nullif(tp + fn, 0)::double, 0) as rec, coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0)::double as f1
 from (select {head}count(*) filter (where r and c) as tp, count(*) filter (where c and not r) as fp, count(*) filter (where r and not c) as fn from {src} {'group by ' + by if by else ''}))"""


@query("a15_precision_recall", f"with {_ARMS} select * from {_prf('ab')}")
def _(spark, d):
    return E.prf(E.arms(*_arms(spark, d)))


def _soft(spark, d):
    c, _, e = _tables(spark, d)
    subjects = CL.subject_ids(c, e).groupBy("claim_id").agg(F.collect_set("id").alias("subjects"))
    rows = c.select("claim_id", "chunk_id", F.col("text").alias("predicate"), "attribution").distinct().join(subjects, "claim_id")
    side = lambda x: rows.where(x).select("chunk_id", F.col("claim_id").alias("pos"), "predicate", "subjects")
    return E.match_claims(side(~F.coalesce(F.col("attribution") == "hearsay", F.lit(False))), side(F.coalesce(F.col("attribution") == "hearsay", F.lit(False))))


@query("j10_soft_matches")
def _(spark, d):
    """Claims that are no hearsay as the reference, hearsay as the candidate."""
    return _soft(spark, d)


@query("a16_compared_arm")
def _(spark, d):
    r, c = _arms(spark, d)
    return E.compared_arm(r, c, E.strata(*_t(spark, d, "chunks", "entities")), _soft(spark, d))


@query("a16_arm_entities", f"""with {_ARMS}, {_STRATA.replace(_FORMS + ', ', '', 1)}, g as (select chunk_id, unnest(['overall', case when stratum = 'control' then 'control' else 'hard' end]) as grp from sr),
ag as (select ab.*, g.grp from ab join g on g.chunk_id = ab.chunk_id where ab.id not like 'raw:%') select * from {_prf('ag', 'grp')}""")
def _(spark, d):
    kind = F.when(F.col("stratum") == "control", "control").otherwise("hard")
    g = E.strata(*_t(spark, d, "chunks", "entities")).select("chunk_id", F.explode(F.array(F.lit("overall"), kind)).alias("grp"))
    return E.prf(E.arms(*_arms(spark, d)).where("id not like 'raw:%'").join(g, "chunk_id"), ["grp"])


# --- cost ----------------------------------------------------------------------------------------------------------------------


def _estimate(chunks, overhead: int = 2300):
    c = chunks.select("chunk_id", "text").where("text is not null").dropDuplicates(["chunk_id"]).select((T.tokens_estimate(F.col("text")) + 40).alias("n"), F.length("text").alias("chars"))
    out = F.greatest(F.lit(120), F.bround(F.col("n") * 0.4).cast("long"))
    return c.agg(F.count("*").alias("chunks"), F.sum(F.col("n") + overhead).alias("input_tokens"), F.sum(out).alias("output_tokens"))


_EST = "k as (select chunk_id, any_value(text) as text from chunks where text is not null group by chunk_id), n as (select cast(greatest(1, round_even(length(text) / 3.6, 0)) as bigint) + 40 as n from k), e as (select count(*) as chunks, cast(sum(n + 2300) as bigint) as input_tokens, cast(sum(greatest(120, cast(round_even(n * 0.4, 0) as bigint))) as bigint) as output_tokens from n)"
_PRICE = "p as (select * from (values " + ", ".join(f"('{m}', {a}::double, {b}::double)" for m, (a, b) in T.PRICES.items()) + ") v(model, a, b))"


@query("x10_model_costs", f"with {_EST}, {_PRICE} select model, chunks, input_tokens, output_tokens, (input_tokens * a + output_tokens * b) / 1000000 as standard_usd, (input_tokens * a + output_tokens * b) / 1000000 * 0.5 as batch_usd from e cross join p")
def _(spark, d):
    e = _estimate(_t(spark, d, "chunks"))
    rows = [F.struct(F.lit(m).alias("model"), T.cost_usd({"input": F.col("input_tokens"), "output": F.col("output_tokens")}, m).alias("usd")) for m in T.PRICES]
    return e.withColumn("m", F.explode(F.array(*rows))).select("m.model", "chunks", "input_tokens", "output_tokens", F.col("m.usd").alias("standard_usd"), (F.col("m.usd") * 0.5).alias("batch_usd"))


@query("x9_evaluation_cost", f"with k as (select chunk_id, any_value(text) as text from chunks where text is not null group by chunk_id), n as (select length(text) / 3.6::double + 40 as n from k), {_PRICE}, s as (select count(*) as k, sum(n) as n from n) select model, ((n + k * 230) * a + n * 2.1 * b) / 1000000 as arm_usd, k * 2 * 0.8 * (800 * a + 160 * b) / 1000000 as judge_usd from s cross join p")
def _(spark, d):
    s = _t(spark, d, "chunks").select("chunk_id", "text").where("text is not null").dropDuplicates(["chunk_id"]).agg(F.count("*").alias("k"), F.sum(F.length("text") / 3.6 + 40).alias("n"))
    arm = lambda m: T.cost_usd({"input": F.col("n") + F.col("k") * 230, "output": F.col("n") * 2.1}, m)
    judge = lambda m: F.col("k") * 2 * 0.8 * T.cost_usd({"input": F.lit(800), "output": F.lit(160)}, m)
    rows = [F.struct(F.lit(m).alias("model"), arm(m).alias("arm_usd"), judge(m).alias("judge_usd")) for m in T.PRICES]
    return s.select(F.explode(F.array(*rows)).alias("m")).select("m.*")


@query("w8_label_spans", f"with {_LABELS}, t as (select chunk_id, length(any_value(text)) as n from chunks where text is not null group by chunk_id) select lab.chunk_id, lab.start, coalesce(lead(lab.start) over (partition by lab.chunk_id order by lab.start), t.n) as stop, lab.speaker from lab join t on t.chunk_id = lab.chunk_id")
def _(spark, d):
    """Each label with the place where its words end: the next label, or the end of the text."""
    return CL.label_spans(_t(spark, d, "chunks"))


@query("x17_claim_lines", rf"""with c as (select distinct claim_id, day_no, page_start, speaker, coalesce(quote, text, '') as said from claims), t as (select *, trim(regexp_replace(said, '[\s\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]+', ' ', 'g')) as s from c)
select claim_id, '- [' || substr(claim_id, 1, 10) || ' | Day ' || coalesce(cast(day_no as varchar), 'None') || case when page_start is not null then ', p.' || page_start else '' end || case when coalesce(speaker, '') <> '' then ' — ' || speaker else '' end || '] ' || case when length(s) > 300 then substr(s, 1, 300) || '…' else s end as line from t""")
def _(spark, d):
    c = _t(spark, d, "claims").select("claim_id", "day_no", "page_start", "speaker", F.coalesce("quote", "text").alias("said")).distinct()
    return c.select("claim_id", R.claim_line(F.col("claim_id"), F.col("day_no"), F.col("page_start"), F.col("speaker"), F.col("said")).alias("line"))


@query("f27_judge_keys", f"with {_CL} select claim_id, substr(chunk_id, 1, 32) || '__reference__' || substr(sha256('[\"' || upper(coalesce(speaker, '')) || '\",\"' || coalesce(hex(text), '') || '\",\"' || coalesce(hex(quote), '') || '\"]'), 1, 16) as key from cl")
def _(spark, d):
    """Keys of a judge's answers: one for each passage, arm and what is judged."""
    c = _t(spark, d, "claims").select("claim_id", "chunk_id", "speaker", "text", "quote", "certainty").distinct()
    return c.select("claim_id", T.judge_key(F.col("chunk_id"), "reference", F.upper("speaker"), F.hex("text"), F.hex("quote")).alias("key"))


@query("a18_framing_counts", f"with {_CL}, c as (select coalesce(certainty, 'unlabelled') as label, {_FLAGGED} as flagged from cl) select label, count(*) as claims, count(*) filter (where flagged) as structural_flags, count(*) / sum(count(*)) over ()::double as share from c group by label")
def _(spark, d):
    """Claims by how certain they are said to be, with their structural flags and their share of all."""
    return CL.framing_counts(_t(spark, d, "claims"))
