"""DuckDB statements for those queries of this subpackage that SQL can express."""

from lodestone.llm.survivor import CUT_OFF, EMPTY_CATEGORY, EMPTY_TEXT

_WORDS = "trim(regexp_replace(lower(regexp_replace({c}, '([a-z])([A-Z])', '\\1 \\2', 'g')), '[^a-z0-9]+', ' ', 'g'))"

LINKS = f"""
with m as (
  select left_id as src, right_id as dst,
    coalesce(regexp_replace({_WORDS.format(c="decision")}, '^match decision ', ''), '') as d,
    coalesce(regexp_matches({_WORDS.format(c="tier")}, '^(match ?tier )?((identical id)|(tier )?(a canonical url|b product identity|c explicit alias|d strong combination))$'), false) as proven,
    trim(regexp_replace(lower(coalesce(evidence, '')), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) not in ('', 'n a', 'none', 'null', 'nan', 'nil', 'unknown') as evident
  from match_results)
select src, dst from m
where (regexp_matches(d, '\\b(merge[ds]?|merging|same|duplicate)\\b')
       and not regexp_matches(d, '\\b(no|not|non|never|un|veto|vetoed|dont|don t|without|reject|rejected|unmerged)\\b')
       and (proven or evident))
   or (d in ('', 'null') and proven)
"""

GROUPS = f"""
with recursive l as ({LINKS}), e as (select src, dst from l where src <> dst union select dst, src from l where src <> dst),
r(node, low) as (
  select src, src from e
  union
  select e.dst, r.low from r join e on e.src = r.node where r.low < e.dst)
select node as tool_no, min(low) as group_no from r group by node
"""

_HOST = "regexp_replace(regexp_extract(lower(trim({u})), '^(?:https?:)?(?://)?(?:[^/?#@\\s]*@)?([^/?#:\\s@]+\\.[a-z][a-z0-9-]*)', 1), '^www\\.', '')"
_SQUEEZED = "regexp_replace(lower({c}), '[^\\p{{L}}\\p{{N}}]+', '', 'g')"
_PLAIN = "trim(regexp_replace(lower({c}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"

SURVIVORS = f"""
with cfg as (select source_key, name, homepage, listing_url, coalesce(case when isnan(trust) then null else trust end, 0.5) as trust from source_configs),
keys as (select 'n:' || {_SQUEEZED.format(c="source_key")} as k, trust from cfg union all select 'n:' || {_SQUEEZED.format(c="name")}, trust from cfg
  union all select 'h:' || {_HOST.format(u="homepage")}, trust from cfg union all select 'h:' || {_HOST.format(u="listing_url")}, trust from cfg),
known as (select k, max(trust) as trust from keys where k not in ('n:', 'h:') group by k),
src as (select prep_id, unnest(discovery_sources) as s from grouped_candidates),
trust as (select prep_id, max(coalesce(n.trust, h.trust, 0.5)) as trust from src left join known n on n.k = 'n:' || {_SQUEEZED.format(c="s.name")} left join known h on h.k = 'h:' || {_HOST.format(u="s.url")}
  where s is not null group by prep_id),
g as (select g.group_no, g.prep_id, coalesce(t.trust, -1) as trust, g.discovered_at,
  coalesce({_PLAIN.format(c="observed_description")} <> '' and not regexp_matches({_PLAIN.format(c="observed_description")}, '{EMPTY_TEXT}') and not regexp_matches(observed_description, '{CUT_OFF}'), false) as text_ok,
  coalesce(len(list_filter(categories, lambda x: {_PLAIN.format(c="x")} <> '' and not regexp_matches({_PLAIN.format(c="x")}, '{EMPTY_CATEGORY}'))) > 0, false) as list_ok
  from grouped_candidates g left join trust t using (prep_id) where g.group_no is not null and g.prep_id is not null),
f as (select group_no, 'observed_description' as field_name, prep_id, trust, discovered_at from g where text_ok union all select group_no, 'categories', prep_id, trust, discovered_at from g where list_ok)
select group_no, field_name, prep_id from (select *, row_number() over (partition by group_no, field_name order by trust desc, discovered_at desc nulls last, prep_id) as n from f) where n = 1
"""

RECORDS = f"""
with s as ({SURVIVORS}), g as (select prep_id, observed_description, array_to_string(categories, '|') as categories from grouped_candidates)
select s.group_no, max(case when field_name = 'observed_description' then g.observed_description end) as observed_description, max(case when field_name = 'categories' then g.categories end) as categories
from s join g using (prep_id) group by s.group_no
"""

SQL = {"p7_records": RECORDS, "p6_links": LINKS, "p6_found": GROUPS, "p7_found": SURVIVORS}
