"""Queries of value functions and of the steps of a resumable workflow, with their SQL.

The SQL states its constants again instead of taking the engine's.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import functions as F

from lodestone.functions import brands, text, urls, values
from lodestone.operators import evidence, merge, pages, records
from lodestone.plans.oracle import KEYED as _KEYED
from lodestone.plans.sql import addresses, named
from lodestone.session import table, work_path
from lodestone.sources import jsonl, registry, robots
from lodestone.streaming import intake

#: The day on which ages are counted.
TODAY = date(2026, 6, 1)
_FILLED = ("company", "website", "country", "status", "short_description", "detailed_overview", "primary_task", "tags", "has_api", "launch_date")


def price_parts(s, d):
    t = table(s, d, "tools").select("tool_no", values.price(F.col("pricing.starting_price_raw")).alias("p"))
    return t.select("tool_no", "p.amount", "p.currency")


def lowest_prices(s, d):
    return table(s, d, "documents").select("doc_id", values.lowest_price(F.col("text")).alias("price")).where("price is not null")


def date_parts(s, d):
    """Launch dates written to the day, the month and the year, and read again."""
    day = F.col("launch_date").cast("string")
    t = table(s, d, "tools").select("tool_no", F.explode(F.array(day, F.substring(day, 1, 7), F.substring(day, 1, 4), F.date_format("launch_date", "MMMM yyyy"))).alias("written"))
    t = t.select("tool_no", "written", values.parse_date(F.col("written"), TODAY).alias("p"))
    return t.select("tool_no", "written", F.col("p.date").cast("string").alias("read"), "p.precision")


def launch_ages(s, d):
    return table(s, d, "tools").select("tool_no", values.days_since(F.col("launch_date"), TODAY).alias("days"))


def graded_scores(s, d):
    """Criteria graded by steps, weighed, added and clamped, with the points of each share."""
    n = F.coalesce(F.size("tags"), F.lit(0))
    size = F.coalesce(F.length("detailed_overview"), F.lit(0))
    t = table(s, d, "tools").select("tool_no", values.graded(size, [(300, 1.0), (120, 0.5)]).alias("depth"), values.graded(n, [(4, 1.0), (2, 0.5)]).alias("breadth"))
    return t.select("tool_no", "depth", "breadth", values.share_points(20.0, F.col("depth") * 0.2).alias("points"), values.quantize(values.weighted([(60.0, F.col("depth")), (50.0, F.col("breadth"))])).alias("total"))


def tool_completeness(s, d):
    t = table(s, d, "tools")
    return t.select("tool_no", values.completeness([(c, t.schema[c].dataType.simpleString()) for c in _FILLED]).alias("completeness"))


def ordered_unions(s, d):
    t = table(s, d, "prepared_candidates")
    return t.select("prep_id", F.array_join(values.united(F.col("categories"), F.col("source_keys"), F.array("name")), "|").alias("items"))


def merged_settings(s, d):
    """The settings of each source over the defaults."""
    defaults = F.create_map(F.lit("max_pages"), F.lit("5"), F.lit("language"), F.lit("en"))
    t = table(s, d, "source_configs").select("source_key", values.merged_map(F.col("extra"), defaults).alias("m"))
    return t.select("source_key", F.explode("m").alias("name", "value"))


def reference_lists(s, d):
    t = records.source_refs(table(s, d, "prepared_candidates"), "prep_id", "discovery_sources", F.col("name"))
    return t.select("prep_id", F.array_join("refs", "|").alias("refs"))


def vague_dropped(s, d):
    t = table(s, d, "raw_candidates").select("row_id", values.without_vague(F.col("categories"), (*values.VAGUE, "recruiting")).alias("kept"))
    return t.select("row_id", F.array_join("kept", "|").alias("kept"))


# Keys that tell a task.
_TASKS = (("translation", "Translation"), ("writing", "Writing"), ("video", "Video"), ("search", "Search"), ("legal", "Legal"), ("game", "Games"))


def inferred_tasks(s, d):
    return table(s, d, "raw_candidates").select("row_id", values.inferred(F.col("categories"), _TASKS).alias("task"))


def record_keys(s, d):
    t = table(s, d, "raw_candidates")
    none = F.lit(None).cast("string")
    return t.select("row_id", records.record_key(none, none, F.col("source_key"), F.col("name"), F.col("listing_url")).alias("key"))


def verification_keys(s, d):
    t = table(s, d, "prepared_candidates")
    return t.select("prep_id", records.verification_key(F.col("candidate_id"), [F.col("website"), F.col("identity_key")], [F.col("listing_url")]).alias("key"))


def facts_keys(s, d):
    return table(s, d, "tools").select("tool_no", records.facts_key(F.col("website")).alias("key"))


def latest_rows(s, d):
    t = table(s, d, "prepared_candidates").select("identity_key", "prep_id", "name", "website")
    return records.keep_last(t, ["identity_key"], ["prep_id"])


def same_ids(s, d):
    return records.same_ids(table(s, d, "prepared_candidates"), "candidate_id", "prep_id")


def limited_work(s, d):
    t = table(s, d, "prepared_candidates").select("prep_id", "website")
    return records.limited_work(t, F.col("website").isNull(), "prep_id", 50)


def gaps_filled(s, d):
    t = table(s, d, "tools").select("tool_no", "short_description", F.substring_index("detailed_overview", "\n", 1).alias("first"), F.when(F.col("verification_status") == "verified", F.array(F.lit("short_description"))).alias("sure"))
    return records.gap_filled(t, "short_description", F.col("first"), "sure").select("tool_no", "short_description", "short_description_filled")


def facts_applied(s, d):
    """Tools with the status of the last pair that compares them, where it says one."""
    facts = table(s, d, "match_results").select(F.col("left_id").alias("tool_no"), F.col("tier").alias("status"), "pair_no").where("tool_no is not null")
    last = records.keep_last(facts, ["tool_no"], ["pair_no"])
    return records.applied(table(s, d, "tools").select("tool_no", "name", "status"), last, "tool_no", ["status"]).select("tool_no", "status", F.array_join("applied", "|").alias("applied"))


def enriched_rows(s, d):
    """Sightings without a website, filled from the earliest prepared row of the same listing."""
    p = table(s, d, "prepared_candidates").where("website is not null and listing_url is not null")
    found = records.strongest(p, "listing_url", [F.col("prep_id")], ["website"]).select("listing_url", F.col("website").alias("found"), F.lit("directory_detail_page").alias("origin"))
    return records.enriched(table(s, d, "raw_candidates").select("row_id", "website", "listing_url"), found, "listing_url")


def strongest_rows(s, d):
    """Per identity the row of the strongest confidence, then the earliest."""
    rank = F.when(F.col("identity_confidence") == "high", 0).when(F.col("identity_confidence") == "medium", 1).otherwise(2)
    return records.strongest(table(s, d, "prepared_candidates"), "identity_key", [rank, F.col("prep_id")], ["prep_id", "identity_confidence"])


def review_audit(s, d):
    m = table(s, d, "match_results").where(text.code_word(F.col("decision")) == "review")
    return records.audit(m, "left_id", "right_id")


def outcome_counts(s, d):
    t = records.outcomes(table(s, d, "tools"), F.col("rejected"), F.col("verification_status") != "verified")
    return t.groupBy("outcome").agg(F.count("*").alias("n"))


def tool_pages(s, d):
    """Tools with the latest good answer of their website."""
    page = pages.freshest(table(s, d, "fetch_results")).select("page", "fetch_id")
    return table(s, d, "tools").select("tool_no", urls.normalize_url(F.col("website")).alias("page")).join(page, "page").select("tool_no", "page", "fetch_id")


def page_states(s, d):
    """Whether an answer is a page, has little text, was led to another site or tells of an end."""
    f = table(s, d, "fetch_results")
    return f.select("fetch_id", pages.is_html(F.try_element_at("headers", F.lit("content-type")), F.col("text")).alias("html"), pages.failure(F.col("status"), F.col("text"), F.col("url"), F.col("final_url")).alias("failure"))


def domain_names(s, d):
    t = table(s, d, "tools").select("tool_no", text.canonical_name(F.col("name")).alias("key"), "website")
    return t.select("tool_no", brands.domain_tells_name(F.col("key"), F.col("website")).alias("told"))


def brand_texts(s, d):
    t = table(s, d, "tools")
    return t.select("tool_no", brands.tells_name(F.col("name"), F.substring_index("detailed_overview", "\n", 1)).alias("told"))


def overlapping_names(s, d):
    t = table(s, d, "tools").select("tool_no", text.canonical_name(F.col("name")).alias("a"), text.canonical_name(F.col("company")).alias("b"), text.name_tokens(F.col("name")).alias("x"), text.name_tokens(F.col("company")).alias("y"))
    return t.select("tool_no", brands.names_overlap(F.col("a"), F.col("b"), F.col("x"), F.col("y")).alias("overlap"))


def url_tests(s, d):
    t = table(s, d, "raw_candidates")
    return t.select("row_id", urls.is_probably_url(F.col("website")).alias("shaped"), urls.looks_like_asset(F.col("website")).alias("asset"), urls.is_internal(F.col("website"), F.col("listing_url")).alias("internal"))


def scanned_rows(s, d):
    """Sightings written as JSON lines and read again: how many are skipped, and why."""
    t = table(s, d, "raw_candidates")
    line = F.to_json(F.struct("name", "source_key", "listing_url", "website", "tagline"))
    lines = t.select(F.lit("/x/candidates.jsonl").alias("file"), F.col("row_id").alias("line_no"), F.explode(F.array(line, F.col("raw_signals"))).alias("line")).where("trim(line) <> ''")
    rows = jsonl.classify(lines.withColumn("kind", jsonl.root_kind(F.col("line"))))
    return rows.groupBy(F.coalesce("skip_reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


def registry_summary(s, d):
    return registry.summary(table(s, d, "source_configs"))


def primary_sources(s, d):
    return registry.primary(table(s, d, "source_configs")).select("source_key", "name")


def listing_walks(s, d):
    """Each directory's stored listing taken as pages of one card per sighting, to the first repeat or the limit."""
    t = table(s, d, "raw_candidates").where("listing_url is not null and source_key is not null")
    t = t.select("source_key", F.col("row_id").alias("page_no"), F.lit("x").alias("body"), F.lit(200).alias("status"), F.lit(1).alias("cards"), F.col("listing_url").alias("url"))
    p = pages.walk(t.withColumn("body", F.col("url")), max_pages=10**9, limit=100)
    return p.groupBy("source_key").agg(F.count("*").alias("pages"), F.max("stop_reason").alias("stop_reason"))


def merged_signals(s, d):
    return merge.merged_signals(table(s, d, "raw_candidates"))


def contributions(s, d):
    return merge.contributions(table(s, d, "raw_candidates"))


def allowed_pages(s, d):
    """Stored addresses that a robots file of their host lets be fetched."""
    f = table(s, d, "fetch_results").select(urls.normalize_url(F.col("url")).alias("url")).where("url is not null").distinct()
    f = f.withColumn("origin", F.regexp_extract("url", "^(https://[^/?#]*)", 1))
    body = "User-agent: *\nDisallow: /docs\nDisallow: /*.pdf$\nAllow: /docs/a\n\nUser-agent: other\nDisallow: /\n"
    rules = robots.rules(f.select("origin").distinct().withColumn("body", F.lit(body)))
    return robots.can_fetch(f, rules, "reader/1.0")


def page_views(s, d):
    """Tools written as markup and parsed again."""
    t = table(s, d, "tools").select("tool_no", "name", F.coalesce("tags", F.array().cast("array<string>")).alias("tags"), "website", "detailed_overview")
    json = F.to_json(F.struct(F.lit("Product").alias("@type"), F.col("name").alias("name"), F.col("website").alias("url")))
    items = F.array_join(F.transform("tags", lambda x: F.concat(F.lit("<li>"), x, F.lit("</li>"))), "")
    markup = F.concat(F.lit("<html><head><title>"), F.coalesce("name", F.lit("")), F.lit('</title><script type="application/ld+json">'), json, F.lit("</script></head><body><h1>Tool</h1><ul>"), items, F.lit('</ul><a href="'), F.coalesce("website", F.lit("")), F.lit('">site</a></body></html>'))
    v = t.select("tool_no", pages.page_view(markup).alias("v"))
    v = v.select("tool_no", F.col("v.title").alias("title"), F.array_join("v.bullets", "|").alias("bullets"), F.size("v.anchors").alias("anchors"), pages.jsonld_nodes(F.col("v")).alias("nodes"))
    return v.select("tool_no", "title", "bullets", F.col("anchors").cast("bigint").alias("anchors"), F.get_json_object(F.get("nodes", F.lit(0)), "$.name").alias("product"))


def page_evidence(s, d):
    """What markup made from tools proves: a price page where a model is known, documents where there is an interface."""
    t = table(s, d, "tools").select("tool_no", "name", "website", "has_api", F.col("pricing.model").alias("model"))
    price = F.when(F.col("model").isNotNull(), F.lit('<a href="/pricing">Cost</a>')).otherwise(F.lit(""))
    docs = F.when(F.col("has_api"), F.lit('<a href="/x">Docs</a><a href="https://elsewhere.example/login">in</a>')).otherwise(F.lit(""))
    markup = F.concat(F.lit("<html><head><title>"), F.coalesce("name", F.lit("")), F.lit("</title></head><body>"), price, docs, F.lit("</body></html>"))
    e = evidence.evidence(t.select(F.col("tool_no").alias("page_id"), pages.page_view(markup).alias("view"), F.col("website").alias("url"), "name"))
    return e.select(F.col("page_id").alias("tool_no"), F.array_join("offers", "|").alias("offers"), F.array_contains("named", "name_in_title").alias("titled"))


def stream_windows(s, d):
    """Events counted by five-minute windows as a stream that ends when all files are read."""
    schema = table(s, d, "events").schema
    name = f"windows_{uuid.uuid4().hex}"
    stream = s.readStream.schema(schema).parquet(f"{d}/events.parquet*")
    counts = intake.windowed_counts(stream.withColumn("ts", F.col("ts").cast("timestamp")))
    counts.writeStream.format("memory").queryName(name).outputMode("complete").option("checkpointLocation", work_path(s, "windows")).trigger(availableNow=True).start().awaitTermination()
    return s.table(name).select(F.col("window.start").cast("string").alias("start"), "event_type", "n")


_PRICE = "([$€£¥]|usd|eur|gbp)\\s?(\\d{1,5}([.,]\\d{1,2})?)"
_CODES = "case {c} when '$' then 'USD' when '€' then 'EUR' when '£' then 'GBP' when '¥' then 'JPY' when '' then null else upper({c}) end"
_RAW = "(pricing).starting_price_raw"
_HASH = "substr(sha256({x}), 1, 16)"


def _distinct(items: str) -> str:
    return f"list_filter({items}, lambda x, i: list_position(list_transform({items}, lambda y: lower(y)), lower(x)) = i)"


SQL = {
    "price_parts": f"""with r as (select tool_no, {_RAW} as raw, lower(regexp_extract({_RAW}, '(?i){_PRICE}', 1)) as sign, regexp_extract({_RAW}, '(?i){_PRICE}', 2) as amount from tools)
select tool_no, case when amount <> '' then cast(replace(amount, ',', '.') as double) when contains(lower(raw), 'free') or contains(raw, '$0') or contains(lower(raw), 'no cost') then 0.0 end as amount,
  case when amount <> '' then {_CODES.format(c='sign')} end as currency from r""",
    "lowest_prices": f"select doc_id, price from (select doc_id, list_min(list_filter(list_transform(regexp_extract_all(text, '(?i){_PRICE}', 2), lambda x: cast(replace(x, ',', '.') as double)), lambda x: x > 0 and x <= 100000)) as price from documents) where price is not null",
    "date_parts": """with w as (select tool_no, launch_date as l, unnest([strftime(launch_date, '%Y-%m-%d'), strftime(launch_date, '%Y-%m'), strftime(launch_date, '%Y'), strftime(launch_date, '%B %Y')]) as written, unnest(['day', 'month', 'year', 'month']) as p from tools),
r as (select tool_no, written, cast(case p when 'day' then l when 'month' then date_trunc('month', l) else date_trunc('year', l) end as date) as d, p from w)
select tool_no, written, case when d <= date '2026-06-01' and year(d) >= 1990 then strftime(d, '%Y-%m-%d') end as read, case when d <= date '2026-06-01' and year(d) >= 1990 then p end as precision from r""",
    "launch_ages": "select tool_no, case when launch_date <= date '2026-06-01' then date_diff('day', launch_date, date '2026-06-01') end as days from tools",
    "graded_scores": """with g as (select tool_no, case when coalesce(length(detailed_overview), 0) >= 300 then 1.0 when coalesce(length(detailed_overview), 0) >= 120 then 0.5 else 0.0 end as depth,
  case when coalesce(len(tags), 0) >= 4 then 1.0 when coalesce(len(tags), 0) >= 2 then 0.5 else 0.0 end as breadth from tools)
select tool_no, cast(depth as double) as depth, cast(breadth as double) as breadth, cast(20 * 0.2 * depth as double) as points, cast(greatest(0, least(100, 60 * depth + 50 * breadth)) as double) as total from g""",
    "tool_completeness": f"select tool_no, round(({' + '.join(f'''coalesce(({c} is not null{" and len(tags) > 0" if c == "tags" else f" and {c} <> ''" if c not in ("has_api", "launch_date") else ""})::int, 0)''' for c in _FILLED)}) / {len(_FILLED)}, 3) as completeness from tools",
    "ordered_unions": f"with l as (select prep_id, list_filter(list_concat(coalesce(categories, []), coalesce(source_keys, []), [name]), lambda x: x is not null) as v from prepared_candidates) select prep_id, array_to_string({_distinct('v')}, '|') as items from l",
    "merged_settings": """with e as (select source_key, unnest(map_entries(extra)) as e from source_configs), d as (select source_key, unnest([{'k': 'max_pages', 'v': '5'}, {'k': 'language', 'v': 'en'}]) as e from source_configs)
select source_key, e.key as name, e.value as value from e union all select d.source_key, d.e.k, d.e.v from d where not exists (select 1 from e where e.source_key = d.source_key and e.e.key = d.e.k)""",
    "reference_lists": """with u as (select prep_id, unnest(discovery_sources) as r, generate_subscripts(discovery_sources, 1) as nth from prepared_candidates),
n as (select *, row_number() over (partition by prep_id, lower(r.name), coalesce(r.url, '') order by nth) as k from u where r.name is not null and trim(r.name) <> ''),
l as (select prep_id, string_agg(r.name, '|' order by nth) as refs from n where k = 1 group by prep_id)
select p.prep_id, coalesce(l.refs, p.name, '') as refs from prepared_candidates p left join l using (prep_id)""",
    "vague_dropped": """select row_id, array_to_string(list_filter(coalesce(categories, []), lambda x: x is not null and trim(x, ' ') <> '' and lower(trim(x, ' ')) not in
  ('ai content', 'ai', 'content', 'ai output', 'ai input', 'data', 'anything', 'everything', 'various', 'misc', 'miscellaneous', 'other', 'others', 'n/a', 'generic', 'all formats', 'any format', 'any', 'stuff', 'information',
   'ai generated content', 'ai-generated content', 'output', 'input', 'recruiting')), '|') as kept from raw_candidates""",
    "inferred_tasks": """with u as (select row_id, lower(trim(unnest(categories), ' ')) as w, generate_subscripts(categories, 1) as nth from raw_candidates),
t as (select row_id, nth, case when contains(w, 'translation') then 'Translation' when contains(w, 'writing') then 'Writing' when contains(w, 'video') then 'Video' when contains(w, 'search') then 'Search' when contains(w, 'legal') then 'Legal' when contains(w, 'game') then 'Games' end as task from u),
f as (select row_id, arg_min(task, nth) filter (where task is not null) as task from t group by row_id)
select r.row_id, f.task from raw_candidates r left join f using (row_id)""",
    "record_keys": f"select row_id, {_HASH.format(x='''coalesce(source_key, '') || chr(31) || coalesce(name, '') || chr(31) || coalesce(listing_url, '') || chr(31)''')} as key from raw_candidates",
    "verification_keys": f"select prep_id, {_HASH.format(x='''coalesce(candidate_id, '') || chr(31) || coalesce(nullif(website, ''), nullif(identity_key, ''), '') || chr(31) || coalesce(nullif(listing_url, ''), '') || chr(31)''')} as key from prepared_candidates",
    "facts_keys": f"with {addresses('tools', 'tool_no', 'website', 'w')} select t.tool_no, case when w.url is not null then {_HASH.format(x='''concat('official_facts', chr(31), w.url, chr(31))''')} end as key from tools t left join w on w.id = t.tool_no",
    "latest_rows": "select identity_key, prep_id, name, website from (select *, row_number() over (partition by identity_key order by prep_id desc) as n from prepared_candidates where identity_key is not null) where n = 1",
    "same_ids": "select candidate_id, min(prep_id) as kept, count(*) as rows from prepared_candidates where candidate_id is not null group by 1",
    "limited_work": "select prep_id, website from (select *, sum((website is null)::int) over (order by prep_id) as n from prepared_candidates) where n <= 50",
    "gaps_filled": """with f as (select tool_no, short_description as s, split_part(detailed_overview, chr(10), 1) as v, verification_status = 'verified' as sure from tools),
g as (select *, coalesce(s, '') = '' and not coalesce(sure, false) and coalesce(v, '') <> '' as fill from f) select tool_no, case when fill then v else s end as short_description, fill as short_description_filled from g""",
    "facts_applied": """with l as (select left_id as tool_no, arg_max({'t': tier}, pair_no).t as tier from match_results where left_id is not null group by 1)
select t.tool_no, case when coalesce(l.tier, '') <> '' then l.tier else t.status end as status, case when coalesce(l.tier, '') <> '' then 'status' else '' end as applied from tools t left join l using (tool_no)""",
    "enriched_rows": """with f as (select listing_url, arg_min(website, prep_id) as found from prepared_candidates where website is not null and listing_url is not null group by 1)
select r.row_id, coalesce(nullif(trim(r.website), ''), f.found) as website, r.listing_url, case when nullif(trim(r.website), '') is not null then 'discovery_listing' when f.found is not null then 'directory_detail_page' else 'none' end as origin from raw_candidates r left join f using (listing_url)""",
    "strongest_rows": """select identity_key, prep_id, identity_confidence from (select *, row_number() over (partition by identity_key order by case identity_confidence when 'high' then 0 when 'medium' then 1 else 2 end, prep_id) as n
  from prepared_candidates where identity_key is not null) where n = 1""",
    "review_audit": "with p as (select left_id as a, right_id as b from match_results where replace(replace(lower(trim(decision)), ' ', '_'), '-', '_') = 'review' and left_id <> right_id) select a as ident, b as other from p union select b, a from p",
    "outcome_counts": "select case when coalesce(rejected, false) then 'rejected' when coalesce(verification_status <> 'verified', false) then 'review' else 'selected' end as outcome, count(*) as n from tools group by 1",
    "tool_pages": f"""with {addresses('tools', 'tool_no', 'website', 'w')}, {addresses('fetch_results', 'fetch_id', 'url', 'a')},
f as (select a.url as page, arg_max(r.fetch_id, {{'t': coalesce(r.fetched_at, timestamp '1000-01-01'), 'i': r.fetch_id}}) as fetch_id from fetch_results r join a on a.id = r.fetch_id where r.status between 200 and 299 and r.text is not null group by 1)
select w.id as tool_no, w.url as page, f.fetch_id from w join f on f.page = w.url""",
    "page_states": f"""with {addresses('fetch_results', 'fetch_id', 'url', 'a')}, {addresses('fetch_results', 'fetch_id', 'final_url', 'z')},
r as (select f.*, a.domain as d1, z.domain as d2, lower(headers['content-type']) as kind from fetch_results f left join a on a.id = f.fetch_id left join z on z.id = f.fetch_id)
select fetch_id, case when coalesce(kind, '') <> '' then contains(kind, 'text/html') or contains(kind, 'application/xhtml') else coalesce(contains(lower(text), '<html') or contains(lower(text), '<!doctype html'), false) end as html,
  case when text is null or status is null then 'fetch_failed' when status >= 400 then 'http_error' when coalesce(d1 <> d2, false) then 'redirected_off_site'
  when regexp_matches(lower(text), 'domain is for sale|buy this domain|this domain may be for sale|parked domain|account suspended|website expired|site not found|we have shut down|has shut down|shutting down|service discontinued|this project is no longer maintained|404 not found|default web page|welcome to nginx|apache2 ubuntu default page|future home of something quite cool') then 'dead_or_parked'
  when length(text) < 400 then 'thin_content' end as failure from r""",
    "scanned_rows": """with l as (select row_id, 1 as k, name, source_key, listing_url, website, null as j from raw_candidates union all select row_id, 2, null, null, null, null, raw_signals from raw_candidates where trim(raw_signals) <> '')
select case when k = 2 and not json_valid(j) then 'malformed' when k = 2 and json_type(j) <> 'OBJECT' then 'not_a_mapping' when coalesce(trim(name), '') = '' then 'no_name' when coalesce(trim(source_key), '') = '' then 'no_source_key'
  when coalesce(trim(website), '') = '' and coalesce(trim(listing_url), '') = '' then 'no_pointer' else 'kept' end as reason, count(*) as n from l group by 1""",
    "registry_summary": "select tier, count(*) as sources, count(*) filter (where enabled) as enabled_sources, count(distinct access) as accesses from source_configs group by 1",
    "primary_sources": "select source_key, name from source_configs where tier = 1",
    "listing_walks": """with p as (select source_key, row_id, listing_url, row_number() over (partition by source_key order by row_id) as n, row_number() over (partition by source_key, listing_url order by row_id) as k
  from raw_candidates where listing_url is not null and source_key is not null),
r as (select *, case when k > 1 then 'seen_url' when contains(lower(listing_url), 'access denied') then 'bot_challenge' when n >= 100 then 'limit' end as reason from p),
s as (select source_key, min(row_id) filter (where reason is not null) as stop from r group by 1)
select source_key, count(*) as pages, max(reason) as stop_reason from r join s using (source_key) where stop is null or row_id <= stop group by 1""",
    "merged_signals": f"""{_KEYED}, v as (select key, row_id, source_key, raw_signals as j, unnest(json_keys(raw_signals)) as name from k where source_key is not null and json_valid(raw_signals) and json_type(raw_signals) = 'OBJECT'),
s as (select key, row_id, source_key || '.' || name as signal, json_extract_string(j, '$."' || name || '"') as value from v)
select key, signal, arg_min(value, row_id) as value from s where value is not null group by 1, 2""",
    "contributions": f"{_KEYED} select key, source_key, listing_url, min(row_id) as row_id from k group by 1, 2, 3",
    "allowed_pages": f"""with {addresses('fetch_results', 'fetch_id', 'url', 'a')}, u as (select distinct url, regexp_extract(url, '^https://[^/?#]*([^#]*)', 1) as path from a)
select url, not ((starts_with(path, '/docs') and not starts_with(path, '/docs/a')) or regexp_matches(path, '\\.pdf$')) as allowed from u""",
    "page_views": "select tool_no, trim(regexp_replace(coalesce(name, ''), '\\s+', ' ', 'g')) as title, array_to_string(coalesce(tags, []), '|') as bullets, cast(coalesce(website, '') <> '' as bigint) as anchors, name as product from tools",
    "page_evidence": f"""with {addresses('tools', 'tool_no', 'website', 'w')}, {named('tools', 'tool_no', 'name', 'n')}
select t.tool_no, array_to_string(list_filter([case when w.id is not null and (pricing).model is not null then 'pricing_link' end, case when w.id is not null and has_api then 'docs_link' end], lambda x: x is not null), '|') as offers,
  coalesce(length(n.key) >= 4, false) as titled from tools t left join w on w.id = t.tool_no left join n on n.id = t.tool_no""",
    "stream_windows": "select strftime(time_bucket(interval '5 minutes', ts), '%Y-%m-%d %H:%M:%S') as start, event_type, count(*) as n from events group by 1, 2",
    "domain_names": f"""with {addresses('tools', 'tool_no', 'website', 'w')}, {named('tools', 'tool_no', 'name', 'n')}, l as (select id, split_part(domain, '.', 1) as label from w), {named('l', 'id', 'label', 'm')}
select t.tool_no, coalesce(n.key = m.key or (length(n.key) >= 4 and contains(m.key, n.key)), false) as told from tools t left join n on n.id = t.tool_no left join m on m.id = t.tool_no""",
    "overlapping_names": f"""with {named('tools', 'tool_no', 'name', 'n')}, {named('tools', 'tool_no', 'company', 'c')}, k as (select n.id, n.key as a, c.key as b from n join c using (id)),
s as (select *, case when length(a) <= length(b) then a else b end as short, case when length(a) <= length(b) then b else a end as long from k)
select s.id as tool_no, coalesce(s.a = s.b or (length(s.short) >= 4 and contains(s.long, s.short)), false) or coalesce(list_has_any(list_filter(string_split_regex(lower(t.name), '[^a-z0-9]+'), lambda x: length(x) > 4), string_split_regex(lower(t.company), '[^a-z0-9]+')), false) as overlap from s join tools t on t.tool_no = s.id""",
}

QUERIES = {
    f.__name__: f
    for f in (
        price_parts, lowest_prices, date_parts, launch_ages, graded_scores, tool_completeness, ordered_unions, merged_settings, reference_lists, vague_dropped, inferred_tasks, record_keys,
        verification_keys, facts_keys, latest_rows, same_ids, limited_work, gaps_filled, facts_applied, enriched_rows, strongest_rows, review_audit, outcome_counts, tool_pages, page_states,
        domain_names, brand_texts, overlapping_names, url_tests, scanned_rows, registry_summary, primary_sources, listing_walks, merged_signals, contributions, allowed_pages, page_views, page_evidence, stream_windows,
    )
}
