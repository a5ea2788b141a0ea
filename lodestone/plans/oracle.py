"""DuckDB statements that must give the rows of the queries of the same name."""

from __future__ import annotations

from lodestone.functions import text, urls
from lodestone.plans.sql import addresses, clean, fold, key_of_tokens, named, plain, slug, tokens, words

_CATEGORIES = f"""list_filter(list_transform(categories, lambda x: regexp_replace(regexp_replace(coalesce(x, ''), '^[\\s\\x{{00A0}}]+|[\\s\\x{{00A0}}]+$', '', 'g'), '[ \\t\\x{{00A0}}]+', ' ', 'g')), lambda x: x <> '' and lower(x) not in ({words(text.PLACEHOLDERS)}))"""

PREPARED = f"""
with {addresses('raw_candidates', 'row_id', 'website', 'w')},
{addresses('raw_candidates', 'row_id', 'listing_url', 'l')},
{named('raw_candidates', 'row_id', 'name', 'n')},
c as (select row_id as id, {_CATEGORIES} as cats from raw_candidates),
c2 as (select id, list_filter(cats, lambda x, i: list_position(list_transform(cats, lambda y: lower(y)), lower(x)) = i) as cats from c),
b as (select r.row_id, r.source_key, n.name, n.key as name_key, w.url as website, w.domain as website_domain, l.url as listing_url, r.discovered_at,
  {clean('r.tagline')} as observed_description, coalesce(c2.cats, []) as cats,
  case when w.id is not null and not (w.root and w.shared) then w.key when l.id is not null and not (l.root and l.shared) then l.key else n.key end as identity_key,
  case when w.id is not null and not (w.root and w.shared) then case when w.root then 'website_domain' else 'website_product_url' end
       when l.id is not null and not (l.root and l.shared) then case when l.root then 'listing_domain' else 'listing_product_url' end
       when n.key is not null then 'name' end as identity_basis
  from raw_candidates r left join w on w.id = r.row_id left join l on l.id = r.row_id left join n on n.id = r.row_id left join c2 on c2.id = r.row_id),
i as (select *, list_filter([case when identity_basis = 'name' then 'weak_identity_name_only' end, case when website is null then 'no_official_website_observed' end,
  case when observed_description is null then 'no_description_observed' when length(observed_description) < 20 then 'observed_description_too_short' end,
  case when len(cats) = 0 then 'no_categories_observed' end, case when regexp_matches(name, ' (\\||—|–|::|•|·) ') then 'name_may_contain_a_tagline' end,
  case when discovered_at is null then 'no_discovered_at_recorded' end], lambda x: x is not null) as iss from b),
p as (select row_id, source_key, case when name is null then 'no_name' when website is null and listing_url is null then 'no_pointer' when identity_basis is null then 'no_identity' end as reject_reason,
  identity_key, identity_basis, case when identity_basis like 'website%' then 'high' when identity_basis like 'listing%' then 'medium' when identity_basis = 'name' then 'low' end as identity_confidence,
  name, name_key, {slug('name')} as slug, website, website_domain, listing_url, observed_description, array_to_string(cats, '|') as categories, len(cats) as n_cats, array_to_string(iss, '|') as issues,
  list_has_any(iss, ['weak_identity_name_only', 'no_official_website_observed', 'name_may_contain_a_tagline']) as needs_review from i)
"""
# Fixed values, stated here again: what the interstitial pages of bot protection say.
_CHECKS = (
    "just a moment...", "enable javascript and cookies to continue", "checking your browser before accessing", "cf-browser-verification", "cf_chl_opt", "attention required! | cloudflare",
    "ddos protection by", "access denied", "request unsuccessful. incapsula", "please verify you are a human",
)
_COLUMNS = "row_id, source_key, reject_reason, identity_key, identity_basis, identity_confidence, name, name_key, slug, website, website_domain, listing_url, observed_description, categories, issues, needs_review"
_NS = urls.NAMESPACE.replace("-", "")


def _uuid(seed: str) -> str:
    h = f"sha1(unhex('{_NS}') || encode({seed}))"
    return f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || lower(to_hex((('0x' || substr({h}, 17, 2))::int & 63) | 128)) || substr({h}, 19, 2) || '-' || substr({h}, 21, 12)"


KEYED = f"""
with {addresses('raw_candidates', 'row_id', 'website', 'w')},
{addresses('raw_candidates', 'row_id', 'listing_url', 'l')},
k as (select r.*, coalesce(case when w.id is not null then case when w.root then 'domain:' else 'url:' end || w.key end, 'listing:' || l.url, 'name:' || lower(trim(coalesce(r.name, '')))) as key
  from raw_candidates r left join w on w.id = r.row_id left join l on l.id = r.row_id)
"""

_TOOLS = f"""
with {addresses('tools', 'tool_no', 'website', 'w')},
{named('tools', 'tool_no', 'name', 'n')},
r as (select t.tool_no, case when not (w.root and w.shared) then w.key end as product, case when not (w.root and w.shared) then w.host end as host,
  case when not w.shared then w.domain end as domain, case when not (w.root and w.shared) then w.url end as canonical, n.key as name_key,
  list_distinct(list_filter({tokens("coalesce(t.name, '')")}, lambda x: x not in ({words(text.NAME_NOISE)}))) as tokens
  from tools t left join w on w.id = t.tool_no left join n on n.id = t.tool_no),
k as (select distinct tool_no, kind, key from (
  select tool_no, 'product' as kind, product as key from r union all select tool_no, 'host', host from r union all select tool_no, 'domain', domain from r union all
  select tool_no, 'canonical', canonical from r union all select tool_no, 'name', name_key from r union all select tool_no, 'prefix', substr(name_key, 1, 6) from r union all
  select tool_no, 'token', x from (select tool_no, unnest(tokens) as x from r) where length(x) >= 5) where key is not null),
b as (select kind, key, count(*) as size, count(*) > case when kind in ('prefix', 'token', 'host', 'domain') then 40 else 400 end as large from k group by kind, key having count(*) > 1)
"""


def _first(column: str, order: str = "row_id") -> str:
    return f"arg_min({column}, {order}) filter (where {column} is not null and {column} <> '')"


def _kind(j: str) -> str:
    return f"case when {j} is null or trim({j}) = '' then 'missing' when not json_valid({j}) then 'malformed' else case json_type({j}) when 'OBJECT' then 'object' when 'ARRAY' then 'array' when 'VARCHAR' then 'string' when 'BOOLEAN' then 'boolean' when 'NULL' then 'null' else 'number' end end"


def _signal(key: str) -> str:
    v = f"lower(json_extract_string(raw_signals, '$.{key}'))"
    return f"case when regexp_full_match({v}, '\\d+(\\.\\d+)?[km]?') then cast(round(cast(regexp_extract({v}, '^([\\d.]+)', 1) as double) * case when {v} like '%k' then 1000 when {v} like '%m' then 1000000 else 1 end) as bigint) end"


_RANK = """rank as (select *, row_number() over (partition by group_no order by case when replace(replace(lower(trim(verification_status)), ' ', '_'), '-', '_') = 'verified' then 0 else 1 end,
  case when website is null then 1 else 0 end, -(coalesce((website <> '')::int, 0) + coalesce((observed_description <> '')::int, 0) + coalesce((len(categories) > 0)::int, 0) + (discovered_at is not null)::int),
  -coalesce(len(discovery_sources), 0), prep_id) as pl from grouped_candidates where group_no is not null and prep_id is not null),
g as (select *, case when pl = 1 then 0 else 1 end as own from rank)"""


def _union_list(column: str) -> str:
    return f"(select group_no, array_to_string(list(item order by place), '|') as v from (select group_no, item, min({{'o': own, 'p': prep_id, 'a': nth}}) as place from (select group_no, own, prep_id, unnest({column}) as item, generate_subscripts({column}, 1) as nth from g) where item is not null group by group_no, item) group by group_no)"


SQL = {
    "prepare": f"{PREPARED} select {_COLUMNS} from p",
    "candidate_ids": f"{PREPARED} select row_id, {_uuid('''('tool:' || lower(trim(identity_key)))''')} as candidate_id from p where reject_reason is null",
    "reject_counts": f"{PREPARED} select coalesce(reject_reason, 'accepted') as code, count(*) as n from p group by 1",
    "issue_counts": f"{PREPARED} select code, count(*) as n from (select unnest(string_split(issues, '|')) as code from p where reject_reason is null and issues <> '') group by 1",
    "source_report": f"""{PREPARED} select case when grouping(source_key) = 1 then 'all' else coalesce(source_key, '') end as source_key, count(*) as rows, count(*) filter (where reject_reason is null) as accepted,
  count(website) as with_website, count(*) filter (where identity_confidence = 'high') as high_confidence, count(*) filter (where coalesce(needs_review, false)) as needs_review,
  count(*) filter (where n_cats > 0) as with_categories, round(count(*) filter (where reject_reason is null) / count(*), 4) as acceptance_rate from p group by rollup (source_key)""",
    "reject_examples": f"{PREPARED} select code, place, row_id from (select reject_reason as code, cast(row_number() over (partition by reject_reason order by row_id) - 1 as int) as place, row_id from p where reject_reason is not null) where place < 5",
    "merged_candidates": f"""{KEYED}, o as (select key, min(row_id) as row_id, count(*) as sightings, count(distinct source_key) as sources, arg_min(name, row_id) filter (where true) as name0, arg_min(source_key, row_id) as source_key,
  {_first('website')} as website, {_first('listing_url')} as listing_url, {_first('tagline')} as tagline from k group by key),
u as (select key, array_to_string(list_sort(list(distinct item)), '|') as categories from (select key, unnest(categories) as item from k) where item is not null group by key)
select o.key, o.row_id, o.sightings, o.sources, r.name, r.source_key, o.website, o.listing_url, o.tagline, coalesce(u.categories, '') as categories from o join raw_candidates r using (row_id) left join u using (key)""",
    "pending_rows": f"""with {addresses('raw_candidates', 'row_id', 'listing_url', 'a')}, {addresses('prepared_candidates', 'prep_id', 'listing_url', 'd')},
k as (select r.row_id, a.url as key from raw_candidates r left join a on a.id = r.row_id)
select min(row_id) as row_id, key from k where key is not null and key not in (select url from d) group by key union all select row_id, key from k where key is null""",
    "cascade_lookup": f"""with {addresses('tools', 'tool_no', 'website', 'w')}, {named('tools', 'tool_no', 'name', 'n')}, {addresses('prepared_candidates', 'prep_id', 'website', 'v')}, {named('prepared_candidates', 'prep_id', 'name', 'm')},
one as (select identity_key as k, min(prep_id) as id from prepared_candidates where identity_key is not null group by 1),
two as (select key as k, min(id) as id from v group by 1),
three as (select key as k, min(id) as id from m where key is not null group by 1)
select t.tool_no, coalesce(one.id, two.id, three.id) as matched, case when one.id is not null then 'identity' when two.id is not null then 'website' when three.id is not null then 'name' end as matched_by
from tools t left join w on w.id = t.tool_no left join n on n.id = t.tool_no left join one on one.k = w.key left join two on two.k = w.key left join three on three.k = n.key""",
    "known_tools": "select tool_no, name from tools where tool_no in (select left_id from match_results)",
    "block_sizes": f"{_TOOLS} select * from b",
    "candidate_pairs": f"{_TOOLS}, m as (select k.* from k join b using (kind, key)) select distinct x.tool_no as left_id, y.tool_no as right_id from m x join m y using (kind, key) where x.tool_no < y.tool_no",
    "match_groups": """with recursive e as (select left_id as a, right_id as b from match_results where replace(replace(lower(trim(decision)), ' ', '_'), '-', '_') = 'merge' and left_id <> right_id),
s as (select a, b from e union select b, a from e), r(id, low) as (select a, a from s union select s.b, r.low from r join s on s.a = r.id where r.low < s.b)
select id, min(low) as group_id from r group by id""",
    "golden_records": f"""with {_RANK}, o as (select group_no, arg_min(prep_id, pl) as prep_id, count(*) as members, {_first('name', "{'o': own, 'p': prep_id}")} as name, {_first('website', "{'o': own, 'p': prep_id}")} as website,
  {_first('observed_description', "{'o': own, 'p': prep_id}")} as observed_description, bool_or(coalesce(needs_review, false)) as needs_review, array_to_string(list_sort(list(distinct name) filter (where name is not null and name <> '')), '|') as aliases from g group by group_no)
select o.*, coalesce(c.v, '') as categories, coalesce(k.v, '') as source_keys, coalesce(i.v, '') as issues from o left join {_union_list('categories')} c using (group_no) left join {_union_list('source_keys')} k using (group_no) left join {_union_list('issues')} i using (group_no)""",
    "quota_selection": """with t as (select tool_no, primary_task, cast(coalesce(length(detailed_overview), 0) + coalesce(len(tags), 0) * 100 as double) as score from tools),
r as (select *, row_number() over (partition by primary_task order by score desc, tool_no) as rk from t),
s as (select *, sum((rk <= 12)::int) over (order by score desc, tool_no rows unbounded preceding) as taken from r)
select tool_no, primary_task, score, case when rk <= 12 and taken <= 200 then 'selected' when taken > 200 or (taken = 200 and rk > 12) then 'next_batch' else 'over_quota' end as outcome from s""",
    "active_sources": "select source_key, name, tier from source_configs where enabled and list_contains(source_roles, 'discovery')",
    "source_roles": "select role, count(*) as sources, count(*) filter (where enabled) as enabled_sources, max(case when isnan(trust) then null else trust end) as best_trust from (select unnest(source_roles) as role, enabled, trust from source_configs) group by role",
    "first_sightings": "select row_id, source_key, listing_url, name from (select *, row_number() over (partition by source_key, listing_url order by row_id) as n from raw_candidates where listing_url is not null) where n = 1",
    "url_parts": f"with {addresses('raw_candidates', 'row_id', 'website', 'w')} select r.row_id, w.url, w.host, w.domain, w.key as product, w.root, lower(w.segs[-1]) as slug from raw_candidates r left join w on w.id = r.row_id",
    "name_keys": f"with {named('raw_candidates', 'row_id', 'name', 'n')} select id as row_id, name, key as name_key, {slug('name')} as slug, array_to_string(list_sort(list_distinct(list_filter({tokens('''coalesce(name, '')''')}, lambda x: x not in ({words(text.NAME_NOISE)})))), ' ') as tokens from n",
    "json_roots": f"select field, kind, count(*) as n from (select 'raw_signals' as field, {_kind('raw_signals')} as kind from raw_candidates union all select 'raw_payload', {_kind('raw_payload')} from raw_candidates) group by 1, 2",
    "signals": f"""select source_key, count(rank) as ranked, min(rank) as best_rank, max(upvotes) as most_upvotes, sum(upvotes) as upvotes, count(*) filter (where sponsored) as sponsored
from (select source_key, {_signal('rank')} as rank, {_signal('upvotes')} as upvotes, coalesce(lower(json_extract_string(raw_signals, '$.sponsored')) in ({words(text.YES)}), false) as sponsored from raw_candidates) group by 1""",
    "content_hashes": "select doc_id, substr(sha256(coalesce(source, 'None') || chr(31) || coalesce(text, 'None') || chr(31)), 1, 16) as hash from documents",
    "page_challenges": f"""select status, count(*) as pages, count(*) filter (where (coalesce(status in (401, 403, 429), false) and coalesce(length(text), 0) < 200000) or {' or '.join(f"contains(lower(coalesce(text, '')), '{m}')" for m in _CHECKS)}) as challenges from fetch_results group by 1""",
    "page_fingerprints": "select sha256(text) as print, count(*) as pages, min(fetch_id) as first_id from fetch_results where trim(text) <> '' group by 1",
    "freshest_pages": f"with {addresses('fetch_results', 'fetch_id', 'url', 'a')} select a.url as page, arg_max(f.fetch_id, {{'t': coalesce(f.fetched_at, timestamp '1000-01-01'), 'i': f.fetch_id}}) as fetch_id, count(*) as fetches from fetch_results f join a on a.id = f.fetch_id where f.status between 200 and 299 and f.text is not null group by 1",
    "decisions": "select coalesce(replace(replace(lower(trim(decision)), ' ', '_'), '-', '_'), '') as decision, coalesce(replace(replace(lower(trim(tier)), ' ', '_'), '-', '_'), '') as tier, count(*) as n, round(avg(confidence), 4) as confidence from match_results group by 1, 2",
}
