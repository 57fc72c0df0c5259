"""The SQL of the core queries, in DuckDB's dialect."""

from __future__ import annotations

from .functions import entities as en
from .functions import text as tx
from .operators import records

_FOLD = "replace(lower({0}), 'ß', 'ss')"
_KEY = rf"regexp_replace(regexp_replace(regexp_replace({_FOLD}, '\b({'|'.join(tx.EDITION_WORDS)})\b', ' ', 'g'), '(?s)\s*[:—–]\s+.*$', ''), '[^a-z0-9]+', '', 'g')"
_SQUEEZE = r"regexp_replace({0}, '[\s\x{{00a0}}]+', ' ', 'g')"
_CLEAN = r"left(regexp_replace(" + _SQUEEZE + r", '^[ .,:;|_-]+|[ .,:;|_-]+$', '', 'g'), 300)"
_STRIP = r"regexp_replace({0}, '^[\s\x{{00a0}}]+|[\s\x{{00a0}}]+$', '', 'g')"
_DOI = r"nullif(regexp_replace(trim(replace(lower({0}), 'ß', 'ss')), '^(https?://(dx\.)?doi\.org/|doi:\s*)', ''), '')"
_ARXIV = r"nullif(regexp_replace(trim(replace(lower({0}), 'ß', 'ss')), '^(https?://arxiv\.org/(abs|pdf)/|arxiv:\s*)', ''), '')"


def key(x: str) -> str:
    return _KEY.format(x)


def clean(x: str) -> str:
    return _CLEAN.format(x)


def strip(x: str) -> str:
    return _STRIP.format(x)


_PREPRINT = "(coalesce(" + " or ".join([f"starts_with(d, '{p}')" for p in tx.PREPRINT_PREFIXES] + [f"contains(d, '{m}')" for m in tx.PREPRINT_MARKS]) + ", false))"
_SUFFIX = r"case when lower(regexp_extract({0}, '\.([A-Za-z]+)$', 1)) = 'htm' then 'html' when lower(regexp_extract({0}, '\.([A-Za-z]+)$', 1)) in ('pdf', 'docx', 'html') then lower(regexp_extract({0}, '\.([A-Za-z]+)$', 1)) end"

CUR = "cur as (select * from (select *, row_number() over (partition by document_id order by updated_at desc) as rn from (select distinct * from manifest)) where rn = 1)"
FILES = rf"""{CUR}, f as (
  select * exclude (doi, arxiv_id, title_key, format, extractable), {key('title')} as title_key, coalesce(extractable, true) as extractable,
    case when regexp_matches(doi, '[0-9]') then trim(doi) end as doi, case when regexp_matches(arxiv_id, '[0-9]') then trim(arxiv_id) end as arxiv_id,
    coalesce({_SUFFIX.format("'x.' || lower(regexp_replace(trim(format), '^[.]', ''))")}, {_SUFFIX.format('canonical_path')}) as format
  from cur)"""
B = "b as (select distinct block_id, document_id, source.source_index as idx, type, heading_level, page_index, section_path, section_role, text, asset_path from sections)"
S = r"s as (select block_id, section_path[1] as title, section_role as section, text from b where regexp_replace(text, '^[\s\x{00a0}]+|[\s\x{00a0}]+$', '', 'g') <> '')"

_roles = " ".join(f"when regexp_matches(h, '{p}') then '{r}'" for r, p in tx.SECTION_ROLES)
_HEADING = r"regexp_replace(regexp_replace(regexp_replace({0}, '(?i)^\s*([IVXLC]+|[0-9]+(\.[0-9]+)*)[.)\s:-]+', ''), '[\s\x{{00a0}}]+', ' ', 'g'), '^ | $', '', 'g')"


def role(x: str) -> str:
    return f"(select case {_roles} else 'unknown' end from (select lower({_HEADING.format(x)}) as h))"


_P2 = r"""
with cur as (
  select * from (select *, row_number() over (partition by document_id order by updated_at desc) as rn from (select distinct * from manifest)) where rn = 1
), due as (
  select document_id, 'extraction' as stage, sha256, stages.extraction.status as claim, updated_at from cur
  union all select document_id, 'analysis', sha256, stages.analysis.status, updated_at from cur
), logged as (
  select document_id, lower(trim(stage)) as stage, regexp_replace(lower(trim(sha256)), '^sha-?256[:=-]?', '') as version, lower(trim(status)) = 'complete' as done from stage_ledger
), open as (
  select document_id, stage, regexp_replace(lower(trim(sha256)), '^sha-?256[:=-]?', '') as version, updated_at from due
  where sha256 is not null and trim(sha256) <> '' and lower(trim(coalesce(claim, ''))) <> 'skipped'
)
"""
_P2_LEFT = "not exists (select 1 from logged l where l.document_id = o.document_id and l.stage = o.stage and l.version = o.version and l.done)"
_P2_DELTA = f"""{_P2} select document_id, stage, version, updated_at,
        case when exists (select 1 from logged l where l.document_id = o.document_id and l.stage = o.stage and l.version = o.version) then 'retry'
             when exists (select 1 from logged l where l.document_id = o.document_id and l.stage = o.stage) then 'changed' else 'new' end as reason
        from open o where {_P2_LEFT}"""
_TOKENS = r"regexp_extract_all(lower({0}), '[a-z0-9][a-z0-9_.+-]{{1,}}')"
_FT = r"regexp_extract_all(translate(lower(concat_ws(' ', title, section, text)), 'àáâãäåçèéêëìíîïñòóôõöùúûüýÿ', 'aaaaaaceeeeiiiinooooouuuuyy'), '[a-z0-9]+')"
_DIM = "(('0x' || left(sha256(token), 8))::ubigint % 512)::int"
_VECTORS = rf"""
tok as (select block_id, token, count(*) as tf from (select block_id, unnest({_TOKENS.format('text')}) as token from s) group by all),
nb as (select count(*) as n from s), df as (select token, count(*) as df from tok group by token),
hashed as (select block_id, {_DIM} as dim, sum((1 + ln(tf)) * (ln((n + 1) / (df + 1)) + 1)) as w from tok join df using (token), nb group by all),
vec as (select block_id, dim, w / sqrt(sum(w * w) over (partition by block_id)) as weight from hashed)
"""
_QUERY = "sparse attention of the harmonic sensor"
_QVEC = rf"""
qt as (select token, count(*) as tf from (select unnest({_TOKENS.format(f"'{_QUERY}'")}) as token) group by token),
qh as (select {_DIM} as dim, sum((1 + ln(tf)) * (ln((n + 1) / (coalesce(df, 0) + 1)) + 1)) as w from qt left join df using (token), nb group by all),
qv as (select dim, w / sqrt(sum(w * w) over ()) as qw from qh),
vs as (select block_id, sum(weight * qw) as cosine from vec join qv using (dim) group by block_id)
"""
_BM25 = rf"""
ft as (select block_id, {_FT} as toks from s), len as (select block_id, toks, len(toks) as length from ft),
tot as (select count(*) as n, avg(length) as mean from len),
q as (select distinct unnest(string_split('{_QUERY}', ' ')) as term),
hit as (select block_id, length, term, len(list_filter(toks, lambda t: t = term)) as tf from len, q),
ndf as (select term, count(*) as ndf from hit where tf > 0 group by term),
bm as (select block_id, sum(greatest(ln((n - ndf + 0.5) / (ndf + 0.5)), 1e-6) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean))) as bm25 from hit join ndf using (term), tot where tf > 0 group by block_id)
"""
_FEATURES = r"""
w as (select work_id, coalesce(title, '') as t from works),
feat as (
  select work_id, 'text' as kind, item, count(*)::double as weight from (select work_id, unnest(regexp_extract_all(lower(t), '[a-z][a-z0-9_+-]{2,}')) as item from w)
  where item not in ('the', 'and', 'for', 'with', 'from', 'that', 'this', 'using', 'method', 'paper', 'based') group by all
  union all
  select distinct work_id, kind, regexp_replace(replace(lower(item), 'ß', 'ss'), '^[\s\x{00a0}]+|[\s\x{00a0}]+$', '', 'g') as item, 1.0 from (
    select work_id, 'facet' as kind, unnest(facets) as item from work_features union all
    select work_id, 'dataset', unnest(datasets) from work_features union all
    select work_id, 'reference', unnest(reference_keys) from work_features)
  where item is not null and regexp_replace(item, '^[\s\x{00a0}]+|[\s\x{00a0}]+$', '', 'g') <> ''
), size as (select work_id, kind, sum(weight) as n, sum(weight * weight) as sq from feat group by all),
dots as (select a.work_id as a, b.work_id as b, a.kind, sum(a.weight * b.weight) as dot from feat a join feat b on a.kind = b.kind and a.item = b.item and a.work_id < b.work_id group by all),
val as (select a, b, d.kind, case when d.kind = 'text' then dot / sqrt(x.sq * y.sq) else dot / (x.n + y.n - dot) end as v
  from dots d join size x on x.work_id = a and x.kind = d.kind join size y on y.work_id = b and y.kind = d.kind),
wide as (select a, b, coalesce(max(v) filter (kind = 'facet'), 0) as facet, coalesce(max(v) filter (kind = 'dataset'), 0) as dataset, coalesce(max(v) filter (kind = 'text'), 0) as text, coalesce(max(v) filter (kind = 'reference'), 0) as reference from val group by all),
rel as (select a as left_work_id, b as right_work_id, round(facet, 4) as facet, round(dataset, 4) as dataset, round(text, 4) as text, round(reference, 4) as reference, round(.25 * facet + .20 * dataset + .35 * text + .20 * reference, 4) as score from wide
  where .25 * facet + .20 * dataset + .35 * text + .20 * reference >= 0.16 and ((facet > 0)::int + (dataset > 0)::int + (text > 0)::int + (reference > 0)::int >= 2 or text >= 0.55 or reference >= 0.2))
"""
_IDENT = f"""
ids as (select work_id, 'doi:' || {_DOI.format('doi')} as identity from works where {_DOI.format('doi')} is not null
  union all select work_id, 'arxiv:' || {_ARXIV.format('arxiv_id')} from works where {_ARXIV.format('arxiv_id')} is not null),
link as (select a.work_id as l, b.work_id as r, max(a.identity) as identity from ids a join ids b on a.identity = b.identity and a.work_id < b.work_id group by all)
"""
_COMP = f"""{_IDENT}, pairs as (select l as a, r as b from link union select r, l from link),
reach as (select a as node, a as other from pairs union select reach.node, pairs.b from reach join pairs on reach.other = pairs.a),
comp as (select node, min(other) as component from reach group by node)"""
_BIB = r"""'@article{' || regexp_replace(coalesce(regexp_extract(authors[1], '(\S+)$', 1), 'Paper'), '[^A-Za-z]', '', 'g') || coalesce(year::varchar, right(work_id, 6)) || ','"""
_METRIC = r"(?:[A-Z]{2,8}[0-9]*|[a-z]{1,2}[A-Z][A-Za-z0-9]{1,6}|[A-Z][0-9]+)"
_BLOCKED = "('CPU', 'CNN', 'GB', 'GPU', 'ID', 'IN', 'MB', 'RAM', 'RGB', 'THE', 'US', 'USA', 'USD')"
_ALIASES = r"""lb as (select distinct lower(trim(l)) as label_id from (select unnest(facets) as l from work_features)),
al as (select split_part(label_id, '.', 1) as facet, label_id, unnest([replace(split_part(label_id, '.', 2), '_', ' '), regexp_replace(replace(split_part(label_id, '.', 2), '_', ' '), '^[a-z]+ ', '')]) as alias from lb where regexp_matches(label_id, '^[a-z]+\.[a-z]+(_[a-z]+)+$')
  union all select * from (values ('place', 'place.selborne_ruun', 'Selborne-Ruun'), ('sign', 'sign.c_sharp', 'C#')) t(facet, label_id, alias))"""
_FACETS = rf"""{B}, {_ALIASES}, own as (select work_id, unnest(document_ids) as document_id from works),
lab as (select distinct work_id, document_id, idx, block_id, facet, label_id from b join own using (document_id), al where contains(lower(text), lower(alias)) and regexp_matches(text, '(?i)(^|[^A-Za-z0-9])' || replace(alias, '#', '\#') || '([^A-Za-z0-9]|$)')),
labels as (select work_id, facet, label_id, count(*) as n_blocks, string_agg(block_id, ',' order by rn) filter (rn <= 3) as evidence from (select *, row_number() over (partition by work_id, facet, label_id order by document_id, idx, block_id) as rn from lab) group by all)"""

_LIST = lambda words: "(" + ", ".join(f"'{w}'" for w in words) + ")"
_YEAR = r"\b(?:19[0-9]{2}|20[0-9]{2})\b"
_QUOTES = "\"“”''‘’"
_REFS = f"""w as (select * from works), ends as (select year, min(work_id) as f, max(work_id) as l from w where year is not null group by year),
flat as (select w.work_id, 0 as ref_index, f as target from w join ends using (year) union all select w.work_id, 1, l from w join ends using (year)),
refs as (select flat.work_id as source_work_id, ref_index, {key('t.title')} as k, case when ref_index = 1 then replace(lower(t.doi), 'ß', 'ss') end as doi, case when ref_index = 1 then replace(lower(t.arxiv_id), 'ß', 'ss') end as arxiv from flat join w t on t.work_id = flat.target where flat.work_id <> flat.target),
verified as (select source_work_id, ref_index, min(w.work_id) as target_work_id from refs join w on (replace(lower(w.doi), 'ß', 'ss') = refs.doi or replace(lower(w.arxiv_id), 'ß', 'ss') = refs.arxiv) and w.work_id <> source_work_id group by all),
titled as (select source_work_id, ref_index, min(w.work_id) as target_work_id from refs join w on {key('w.title')} = refs.k and w.work_id <> source_work_id where length(refs.k) >= 8 and (source_work_id, ref_index) not in (select (source_work_id, ref_index) from verified) group by all),
cite as (select *, 'verified' as status, 1.0::double as confidence from verified union all select *, 'candidate', 1.0 from titled)"""
_NODES = rf"""ds as (select distinct work_id, 'dataset:' || {key('name')} as id from experiments where kind = 'dataset' and name is not null and work_id is not null and trim(name) <> '' and {strip('name')} <> ''),
nodes as (select 'paper' as type, work_id as id from works union select 'dataset', id from ds union select 'taxonomy', 'facet:' || label_id from labels)"""
_PATHS = rf"""{B}, e as (select block_id, document_id, idx, {strip("coalesce(text, '')")} as t, case when type in ('title', 'heading') then case when regexp_matches(text, '^[0-9]+\.[0-9]') then 3 when idx = 0 then 1 else 2 end end as level from b),
ev as (select *, level is not null and t <> '' as h, row_number() over (partition by document_id order by idx) as rn from e where (level is not null and t <> '') or regexp_matches(t, '(?i)^abstract\b')),
p as (select document_id, rn, idx, case when h then [t] else ['Abstract'] end as path from ev where rn = 1
  union all select ev.document_id, ev.rn, ev.idx, case when ev.h then list_concat(p.path[1:ev.level - 1], [ev.t]) else ['Abstract'] end from p join ev on ev.document_id = p.document_id and ev.rn = p.rn + 1)"""
_DOUBTS = " || ".join(f"case when regexp_matches(name, '{p.replace('(?=.{1,2}$)[^0-9]*', '[^0-9]{1,2}')}') then '; {reason}' else '' end" for reason, p in records.SUSPICIONS)

ORACLE: dict[str, str] = {
    "p2_found": f"{_P2} select document_id, stage from open o where {_P2_LEFT}",
    "p2_delta": _P2_DELTA,
    "p2_resumed": _P2_DELTA,
    "exact_dedup": "select doc_id, sha256(text) as sha256, min(doc_id) over (partition by sha256(text)) as canonical, min(doc_id) over (partition by sha256(text)) <> doc_id as is_duplicate from documents where text is not null",
    "document_ids": "select doc_id, 'doc_' || left(sha256(text), 16) as document_id from documents where text is not null",
    "title_normalize": rf"""select title, {clean('title')} as clean,
        length({clean('title')}) between 8 and 300 and len(regexp_extract_all({clean('title')}, '[A-Za-z]')) >= 8 and not regexp_matches(lower({clean('title')}), 'microsoft word|untitled|download|index') and not regexp_matches(lower({clean('title')}), '^https?://') as valid,
        {key('title')} as key,
        coalesce(nullif(left(regexp_replace(regexp_replace(regexp_replace(trim(regexp_replace(replace(title, '&', ' and '), '[^A-Za-z0-9._ -]+', '', 'g')), '\s+', '_', 'g'), '^[._-]+|[._-]+$', '', 'g'), '_+', '_', 'g'), 180), ''), 'document') as slug
        from (select distinct title from manifest where title is not null)""",
    "identifiers": rf"""with {FILES} select document_id, {_DOI.format('doi')} as doi, {_ARXIV.format('arxiv_id')} as arxiv,
        (select {_PREPRINT} from (select trim(replace(lower(f.doi), 'ß', 'ss')) as d)) as preprint,
        'work_' || left(sha256(coalesce('doi:' || {_DOI.format('doi')}, 'arxiv:' || {_ARXIV.format('arxiv_id')}, 'title:' || {key('title')})), 16) as derived_work_id from f""",
    "surname_sets": rf"""with {FILES}, u as (select document_id, unnest(authors) as author from f), a as (select document_id, unnest(string_split_regex(regexp_replace(author, '(?i)\b(et\s+al\.?|and)\b.*$', ''), '[,;•\n\r]+')) as part from u),
        n as (select document_id, list_filter(string_split_regex(trim(part), '\s+'), lambda w: length(w) >= 2 and regexp_matches(w, '^\p{{L}}+$')) as ws from a),
        l as (select document_id, string_agg(distinct replace(lower(ws[-1]), 'ß', 'ss'), ',' order by replace(lower(ws[-1]), 'ß', 'ss')) as surnames from n where len(ws) > 0 group by document_id)
        select document_id, coalesce(surnames, '') as surnames from f left join l using (document_id)""",
    "title_groups": rf"""with {FILES}, g as (select title_key, count(*) as n, count(distinct case when not (select {_PREPRINT} from (select trim(lower(doi)) as d)) then {_DOI.format('doi')} end) as dois, count(distinct {_ARXIV.format('arxiv_id')}) as arxivs, arg_min(work_id, document_id) as first_id from f where title_key <> '' group by title_key)
        select document_id, case when n >= 2 and dois <= 1 and arxivs <= 1 then first_id else work_id end as group_work_id from f left join g using (title_key)""",
    "format_preference": rf"""with {FILES}, r as (select *, case format when 'pdf' then 0 when 'docx' then 1 when 'html' then 2 else 3 end as rank from f),
        w as (select work_id, count(*) as n, min(rank) filter (extractable) as best from r group by work_id),
        c as (select work_id, min(document_id) as first from r join w using (work_id) where extractable and rank = best group by work_id)
        select document_id, work_id, format, coalesce(extractable and rank = best, false) as selected,
          case when not extractable then 'not_extractable' when extractable and rank = best and n = 1 then 'only_representation' when extractable and rank = best then 'preferred_format' else 'alternate_of:' || first end as reason
        from r join w using (work_id) left join c using (work_id)""",
    "match_candidates_blocked": rf"""with k as (select work_id as d, {key('title')} as k from works), g as (select distinct d, k, substr(k, p::int, 3) as gram from (select d, k, unnest(generate_series(1, greatest(1, length(k) - 2))) as p from k where k <> '')),
        n as (select d, count(*) as n from g group by d)
        select a.d as left_document_id, b.d as right_document_id, count(*) as shared, least(min(x.n), min(y.n)) as least from g a join g b on a.gram = b.gram and a.d < b.d join n x on x.d = a.d join n y on y.d = b.d
        group by a.d, b.d having count(*) >= greatest(1, least(min(x.n), min(y.n)) // 2)""",
    "strong_identity": f"with {_IDENT} select l as left_work_id, r as right_work_id, identity from link",
    "work_components": f"with recursive {_COMP} select node as work_id, component from comp",
    "merged_works": f"""with recursive {_COMP}, t as (select coalesce(component, work_id) as work_id, document_ids from works left join comp on node = work_id)
        select t.work_id, count(distinct d) as n_documents, (select count(*) from t u where u.work_id = t.work_id) as n_merged, case when (select count(*) from t u where u.work_id = t.work_id) > 1 then 'merged' else 'unreviewed' end as merge_status
        from (select work_id, unnest(case when len(document_ids) > 0 then document_ids else [null] end) as d from t) t group by t.work_id""",
    "latest_titles": f"with {FILES} select work_id, arg_max(title, document_id) as title from f group by work_id",
    "text_blocks": rf"""with l as (select doc_id, string_split(coalesce(text, ''), chr(10)) as p from documents),
        e as (select doc_id as document_id, unnest(range(len(p)))::int as idx, unnest(p) as line from l) select document_id, idx, {strip('line')} as text from e where {strip('line')} <> ''""",
    "block_quality": rf"""with {B}, q as (select document_id, count(*) as block_count, sum(length({strip("coalesce(text, '')")}))::bigint as character_count, count(*) filter (coalesce(heading_level, 0) > 0) as heading_count,
        round(avg(({strip("coalesce(text, '')")} = '')::int), 4) as empty_block_fraction, max(page_index) + 1 as page_count from b group by document_id)
        select *, concat_ws(',', case when character_count < 500 then 'very_low_text' end, case when block_count < 3 then 'very_few_blocks' end, case when empty_block_fraction > 0.5 then 'many_empty_blocks' end) as reasons,
          case when character_count < 500 or block_count < 3 or empty_block_fraction > 0.5 then 'review_needed' else 'accepted' end as status from q""",
    "heading_roles": rf"with {B} select distinct text, {_HEADING.format('text')} as heading, {role('text')} as role from b where type in ('title', 'heading') and text is not null",
    "section_roles": rf"""with {B}, e as (select block_id, document_id, idx, {strip("coalesce(text, '')")} as t, type in ('title', 'heading') as h from b),
        r as (select *, case when h and t <> '' then {role('t')} when regexp_matches(t, '(?i)^abstract\b') then 'abstract' end as own from e)
        select block_id, coalesce(last_value(own ignore nulls) over (partition by document_id order by idx rows between unbounded preceding and current row), 'unknown') as section_role from r""",
    "select_first_n": rf"""with {B}, s as (select *, {strip('text')} as st from b where coalesce(type, '') not in ('header', 'footer', 'page_footnote') and length({strip('text')}) >= 80),
        f as (select * from (values ('research_problem', ['abstract', 'introduction'], 2), ('methodology', ['methodology'], 6), ('contributions', ['abstract', 'conclusion'], 2), ('results', ['results'], 6), ('limitations', ['limitations'], 3), ('discussion', ['discussion'], 5), ('ablations', ['results'], 4), ('_fallback', ['abstract'], 2)) t(field, roles, most)),
        r as (select document_id, field, block_id, st, most, row_number() over (partition by document_id, field order by idx, block_id) as ord from s, f where list_contains(roles, section_role)),
        k as (select * from r where ord <= most)
        select document_id, case when field = '_fallback' then 'methodology' else field end as field, ord::int as ord, block_id from k
        where (field <> '_fallback' or document_id not in (select document_id from k where field = 'methodology')) and (field <> 'ablations' or contains(lower(st), 'ablation'))""",
    "markdown_blocks": rf"""with {B} select document_id, block_id, case when asset_path is not null then '![](' || asset_path || ')' || case when trim(coalesce(text, '')) <> '' then chr(10) || chr(10) || trim(text) else '' end
        when coalesce(heading_level, 0) > 0 then repeat('#', greatest(1, least(6, heading_level))) || ' ' || trim(text) else trim(coalesce(text, '')) end as markdown from b""",
    "entity_mentions": rf"""with {B} select name as term, count(*) as n_blocks, count(distinct document_id) as n_documents from b, (select distinct name from entity_vocabulary)
        where contains(lower(text), lower(name)) and regexp_matches(text, '(?i)(^|[^A-Za-z0-9])' || regexp_replace(name, '([@-])', '\\\1', 'g') || '([^A-Za-z0-9]|$)') group by name""",
    "metric_mentions": rf"""with {B}, m as (select document_id, idx, block_id, list_concat(list_concat(regexp_extract_all(text, '\b({_METRIC})\s*(?:of|=|:)\s*[0-9]+\.?[0-9]*', 1), regexp_extract_all(text, '[0-9]+\.?[0-9]*\s*%?\s+({_METRIC})\b', 1)), regexp_extract_all(text, '\(\s*({_METRIC})\s*[:=]\s*[0-9]+\.?[0-9]*\)', 1)) as l
          from b where section_role in ('results', 'experiments', 'datasets', 'abstract', 'methodology') and coalesce(type, '') not in ('header', 'footer', 'page_number', 'page_footnote') and text is not null),
        e as (select document_id, idx, block_id, unnest(range(len(l))) as sub, unnest(l) as name from m)
        select document_id, lower(name) as key, arg_min(name, (idx, sub)) as name, arg_min(block_id, (idx, sub)) as block_id from e where length(name) >= 2 and upper(name) not in {_BLOCKED} group by document_id, lower(name)""",
    "result_sentences": rf"""with {B}, p as (select document_id, idx, block_id, string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)) as l from b where section_role in ('results', 'experiments', 'datasets') and text is not null),
        e as (select document_id, idx, block_id, unnest(range(len(l))) as sub, unnest(l) as s from p),
        r as (select document_id, block_id, {strip('s')} as sentence, row_number() over (partition by document_id order by idx, block_id, sub)::int as ord from e where regexp_matches(s, '[0-9]') and regexp_matches(s, '[A-Z][A-Za-z0-9]{{1,7}}'))
        select * from r where ord <= 20""",
    "taxonomy_facets": rf"""with {_FACETS} select work_id, facet, label_id, array_to_string(list_transform(string_split(replace(split_part(label_id, '.', 2), '_', ' '), ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') as name, n_blocks, evidence from labels""",
    "facet_collections": rf"with {_FACETS} select facet, label_id, count(*) as n_works, sha256(array_to_string(list_sort(list(coalesce(title, ''))), '; ')) as titles_sha256 from labels join works using (work_id) group by facet, label_id",
    "statement_aggregate": rf"""with s as (select distinct work_id, kind as field, mention_id as pos, name as statement, coalesce(len(evidence), 0) as n from experiments where name is not null), k as (select *, replace(lower({strip('statement')}), 'ß', 'ss') as k from s where {strip('statement')} <> '')
        select work_id, field, min(pos) as first_pos, arg_max(statement, (n, -pos)) as statement, max(n)::int as n_evidence from k group by work_id, field, k""",
    "evidence_validate": f"""with {B}, e as (select mention_id, unnest(evidence, recursive := true) from (select distinct * from experiments)),
        k as (select distinct document_id, block_id, page_index as p, array_to_string(section_path, ' > ') as sec from b)
        select (k.block_id is not null and (e.page_index is null or e.page_index is not distinct from p) and (e.section is null or e.section is not distinct from sec)) as valid, count(*) as n from e left join k using (document_id, block_id) group by 1""",
    "corpus_audit": rf"""with m as (select distinct mention_id, work_id, kind, name, coalesce(len(evidence), 0) as n from experiments where name is not null),
        a as (select count(*)::double as works, coalesce(sum(len(document_ids)), 0)::double as documents, count(*) filter (len(document_ids) > 1)::double as several from works),
        c as (select count(distinct case when kind = 'dataset' then replace(lower({strip('name')}), 'ß', 'ss') end)::double as ds, count(distinct case when kind = 'metric' then work_id end)::double as wm, count(*)::double as m, count(*) filter (n > 0)::double as e from m)
        select unnest(['works', 'documents', 'works_of_several_documents', 'unique_datasets', 'works_with_metrics', 'dataset_density', 'evidence_rate', 'density_warning']) as measure,
          unnest([works, documents, several, ds, wm, round(ds / greatest(works, 1), 4), round(case when m > 0 then 100 * e / m else 100 end, 2), (round(ds / greatest(works, 1), 4) > 1.5)::int::double]) as value from a, c""",
    "gold_prf": rf"""with m as (select distinct work_id, kind, replace(lower({strip('name')}), 'ß', 'ss') as label, support_status from experiments where name is not null and work_id is not null and kind is not null and {strip('name')} <> ''),
        p as (select distinct work_id, kind, label from m where support_status = 'supported'), g as (select distinct m.work_id, m.kind, m.label from m join entity_vocabulary v on v.kind = m.kind and replace(lower(v.name), 'ß', 'ss') = m.label),
        n as (select work_id, kind, count(*) filter (p and g) as matched, count(*) filter (p) as predicted, count(*) filter (g) as expected from (select work_id, kind, label, bool_or(p) as p, bool_or(g) as g from (select *, true as p, false as g from p union all select *, false, true from g) group by all) group by all),
        r as (select *, case when predicted > 0 then matched / predicted else (expected = 0)::int::double end as pr, case when expected > 0 then matched / expected else 1.0 end as re from n)
        select work_id, kind, matched, predicted, expected, round(pr, 4) as precision, round(re, 4) as recall, round(case when pr + re > 0 then 2 * pr * re / (pr + re) else 0 end, 4) as f1 from r""",
    "changed_works": """with m as (select distinct document_id as work_id, title, sha256, updated_at from manifest),
        a as (select work_id, arg_min((title, sha256), (updated_at, sha256, title)) as s, arg_max((title, sha256), (updated_at, sha256, title)) as e from m group by work_id)
        select work_id, 'changed' as change from a where s is distinct from e""",
    "stage_status": f"""with {CUR} select stage, coalesce(lower(trim(status)), 'missing') as status, count(*) as n from (select 'ingestion' as stage, stages.ingestion.status as status from cur union all select 'extraction', stages.extraction.status from cur union all select 'analysis', stages.analysis.status from cur) group by 1, 2""",
    "manifest_upsert": r"""with l as (select document_id as key, lower(trim(stage)) as stage, lower(trim(status)) as status, recorded_at as updated_at from stage_ledger where document_id is not null)
        select key, stage, status, updated_at from (select *, row_number() over (partition by key, stage order by updated_at desc, status desc) as rn from l) where rn = 1""",
    "related_works": f"with {_FEATURES} select * from rel",
    "related_topk": f"""with {_FEATURES}, ends as (select left_work_id, right_work_id, score, left_work_id as own, right_work_id as other from rel union all select left_work_id, right_work_id, score, right_work_id, left_work_id from rel),
        top as (select *, row_number() over (partition by own order by score desc, other desc) as rn from ends) select left_work_id, right_work_id, max(score) as score from top where rn <= 5 group by all""",
    "token_frequency": rf"with {B}, {S}, t as (select distinct block_id, unnest({_TOKENS.format('text')}) as token from s) select token, count(*) as df from t group by token",
    "tfidf_vectors": f"with {B}, {S}, {_VECTORS} select block_id, dim, round(weight, 4) as weight from vec",
    "bm25_search": f"with {B}, {S}, {_BM25} select block_id, round(bm25, 4) as bm25 from bm",
    "vector_search": f"with {B}, {S}, {_VECTORS}, {_QVEC} select block_id, 0.0::double as lexical, round(cosine, 4) as vector, round(cosine, 4) as score from vs where round(cosine, 4) > 0 order by score desc, block_id limit 25",
    "hybrid_search": f"""with {B}, {S}, {_VECTORS}, {_QVEC}, {_BM25}, top as (select block_id, round(bm25, 6) as r from bm order by r desc, block_id limit 500), lex as (select block_id, 1.0 / row_number() over (order by r desc, block_id) as lexical from top)
        select block_id, round(coalesce(lexical, 0), 4)::double as lexical, round(coalesce(cosine, 0), 4) as vector, round(0.45 * coalesce(lexical, 0) + 0.55 * coalesce(cosine, 0), 4)::double as score from lex full join vs using (block_id) order by score desc, block_id limit 25""",
    "token_overlap": rf"""with {B}, q as (select list_distinct({_TOKENS.format(f"'{_QUERY}'")}) as q)
        select block_id, round(len(list_intersect(q, {_TOKENS.format("concat_ws(' ', section_path[1], text)")})) / len(q), 4) as share from b, q where len(list_intersect(q, {_TOKENS.format("concat_ws(' ', section_path[1], text)")})) > 0""",
    "nearest_embeddings": """with c as (select q.vec_id as query_id, e.vec_id, round(list_cosine_similarity(e.embedding::double[], q.embedding::double[]), 4) as cosine from embeddings e, embeddings q where q.vec_id % 50 = 0 and e.vec_id <> q.vec_id)
        select query_id, vec_id, cosine from (select *, row_number() over (partition by query_id order by cosine desc, vec_id) as rn from c) where rn <= 5""",
    "bibtex_rows": rf"""select work_id, concat_ws(chr(10), {_BIB}, '  title = {{{{' || coalesce(title, 'Untitled') || '}}}},', '  author = {{' || coalesce(nullif(array_to_string(authors, ' and '), ''), 'Unknown') || '}},', '  year = {{' || year || '}},', '  doi = {{' || nullif(doi, '') || '}},', '  eprint = {{' || nullif(arxiv_id, '') || '}},' || chr(10) || '  archivePrefix = {{arXiv}},', '  note = {{Work ID: ' || work_id || '}}', '}}') as entry from works""",
    "dataset_index": rf"""with n as (select distinct work_id, {strip('name')} as name, replace(lower({strip('name')}), 'ß', 'ss') as key, name as raw from experiments where kind = 'dataset' and name is not null and work_id is not null and {strip('name')} <> '' and length(name) <= 40),
        j as (select n.*, coalesce(title, 'Untitled') as title from n join works using (work_id))
        select arg_min(name, (work_id, raw)) as name, count(distinct work_id) as n_works, sha256(array_to_string(list_sort(list_distinct(list(title))), '; ')) as works_sha256 from j group by key""",
    "all_works_report": """select concat_ws(' ', '- **' || coalesce(title, 'Untitled') || '**', '— ' || nullif(array_to_string(authors, ', '), ''), '(' || year || ')', 'doi:' || nullif(doi, ''), 'arXiv:' || nullif(arxiv_id, '')) as markdown from works""",
    "csv_rows": "select work_id, coalesce(title, '') as title, coalesce(array_to_string(authors, '; '), '') as authors, coalesce(year::varchar, '') as year, coalesce(doi, '') as doi, coalesce(arxiv_id, '') as arxiv_id, coalesce(array_to_string(document_ids, '; '), '') as document_ids, coalesce(merge_status, '') as merge_status from works",
    "incremental_ingest": "select 'doc_' || left(sha256(coalesce(text, '')), 16) as document_id, min(doc_id) as doc_id, sha256(coalesce(text, '')) as sha256 from documents group by sha256(coalesce(text, ''))",
    "windowed_events": "select time_bucket(interval 1 hour, ts) as start, event_type, count(*) as n, round(sum(value), 2) as total from events group by 1, 2",
    "html_blocks": rf"""with {B} select path, (row_number() over (partition by path order by p) - 1)::int as idx, type, level::int as heading_level, null::int as page_index, text from (
        select block_id as path, 0 as p, 'title' as type, 1 as level, block_id as text from b where text is not null union all select block_id, 1, 'heading', 2, 'Part' from b where text is not null
        union all select block_id, 2, 'paragraph', null, regexp_replace(regexp_replace(text, '[\s\x{{00a0}}\x{{0085}}\x{{2028}}]+', ' ', 'g'), '^ | $', '', 'g') from b where text is not null union all select block_id, 3, 'list_item', null, 'end' from b where text is not null) where text <> ''""",
    "section_paths": f"with recursive {_PATHS} select block_id, array_to_string(coalesce(p.path, ['Front matter']), ' > ') as section from e asof left join p on e.document_id = p.document_id and e.idx >= p.idx",
    "prompt_budgets": f"""with {B}, r as (select *, row_number() over (partition by document_id order by idx, block_id) as rn from b where text is not null and section_role in ('abstract', 'methodology', 'results')),
        p as (select document_id, left(string_agg('[' || block_id || '] ' || left(text, 1800), chr(10) order by idx, block_id), 60000) as prompt from r where rn <= 80 group by document_id) select document_id, length(prompt) as n_chars, sha256(prompt) as prompt_sha256 from p""",
    "block_violations": r"""with d as (select distinct block_id, document_id, type, heading_level, page_index - 1 as page_index, case when type = 'title' then bbox[1:3] else bbox end as bbox, source.source_index as si from sections),
        e as (select block_id, concat_ws(',', case when not coalesce(bbox is null or len(bbox) = 4, false) then 'bbox' end, case when not coalesce(regexp_matches(block_id, '^blk_[0-9a-f]{20}$'), false) then 'block_id' end, case when not coalesce(regexp_matches(document_id, '^doc_[0-9a-f]{16}$'), false) then 'document_id' end,
          case when heading_level < 1 then 'heading_level' end, case when page_index < 0 then 'page_index' end, case when not coalesce(si >= 0, false) then 'source_index' end, case when not coalesce(length(type) >= 1, false) then 'type' end) as errors from d) select * from e where errors <> ''""",
    "reference_parse": rf"""with r as (select work_id, '[7] ' || array_to_string(coalesce(authors, []), ', ') || ' (' || coalesce(year::varchar, 'n.d.') || '). ' || coalesce(regexp_replace(title, '[.!?]', ',', 'g'), 'Untitled') || '. doi ' || coalesce(doi, 'none') || '.' as raw from works),
        l as (select *, trim(regexp_replace(raw, '^\s*\[?[0-9]+\]?[.\s]+', '')) as line from r),
        f as (select *, regexp_extract(line, '{_YEAR}', 0) as y, trim(regexp_extract(line, '[{_QUOTES}]([^{_QUOTES}]+)[{_QUOTES}]', 1)) as quoted, regexp_matches(line, '[{_QUOTES}]([^{_QUOTES}]+)[{_QUOTES}]') as has_quote,
          trim(regexp_extract(line, '(?s)^.*?{_YEAR}[ .:,;\t-]*([^.!?]*)', 1)) as after, regexp_replace(regexp_extract(line, '(?s)^(.*?){_YEAR}', 1), '^[ (.,;:-]+|[ (.,;:-]+$', '', 'g') as before from l)
        select work_id, raw, case when has_quote then quoted when y <> '' and length(after) > 5 then after end as title,
          case when y <> '' then array_to_string(list_filter(list_transform(string_split_regex(before, '[,;]|\band\b'), lambda x: trim(x)), lambda x: length(x) between 2 and 60 and not regexp_matches(x, '^[0-9]+$')), '; ') else '' end as authors,
          nullif(y, '')::int as year, nullif(regexp_replace(regexp_extract(line, '(?i)\b10\.[0-9]{{4,9}}/[-._;()/:A-Z0-9]+', 0), '[.,;)]+$', ''), '') as doi from f""",
    "suspicious_names": f"""with n as (select distinct name from experiments where kind = 'dataset' and name is not null),
        r as (select name, case when {_FOLD.format('name')} in {_LIST(en.Words().stopwords)} then '; matches stopword' else '' end || case when {_FOLD.format('name')} in {_LIST(en.Words().not_datasets)} then '; matches known false positive' else '' end || {_DOUBTS} as x from n) select name, substr(x, 3) as reasons from r where x <> ''""",
    "metric_display_names": rf"""with n as (select distinct {strip('name')} as name from experiments where kind = 'metric' and name is not null)
        select name from n where name <> '' and len(string_split({_SQUEEZE.format('name')}, ' ')) <= {records.METRIC_WORDS} and not regexp_matches(name, '(?i)\b({'|'.join(records.METRIC_VERBS)})\b') and upper(name) not in {_LIST(en.Words().blocked_metrics)}""",
    "citation_links": f"with {_REFS} select * from cite",
    "verified_citations": f"with {_REFS} select target_work_id, count(*) as citations from cite where status = 'verified' group by 1",
    "jsonld_rows": """select work_id, '{"@type":"ScholarlyArticle","@id":' || to_json(work_id) || coalesce(',"name":' || to_json(title), '') || case when len(authors) > 0 then ',"author":[' || array_to_string(list_transform(authors, lambda a: '{"@type":"Person"' || coalesce(',"name":' || to_json(a), '') || '}'), ',') || ']' else '' end
        || coalesce(',"datePublished":"' || year || '"', '') || coalesce(',"sameAs":' || to_json('https://doi.org/' || nullif(doi, '')), '') || '}' as json from works""",
}
_GRAPH = f"{_FACETS}, {_REFS.replace('w as (select * from works), ', '', 1)}, {_NODES}"
ORACLE["knowledge_graph_nodes"] = f"with w as (select * from works), {_GRAPH} select type, count(*) as n from nodes group by type"
ORACLE["graph_summary"] = f"""with w as (select * from works), {_GRAPH}, top as ({ORACLE['related_topk']})
    select 'nodes:' || type as measure, count(*) as n from nodes group by type
    union all select 'edges:citation', count(distinct (source_work_id, target_work_id)) from cite having count(*) > 0
    union all select 'edges:related', count(*) from top having count(*) > 0
    union all select 'edges:evaluated_on', count(distinct (work_id, id)) from ds having count(*) > 0
    union all select 'edges:classified_as', count(distinct (work_id, label_id)) from labels having count(*) > 0"""
