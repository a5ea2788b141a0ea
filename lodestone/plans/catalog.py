"""All queries of the engine's own operators, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone.functions import text, urls
from lodestone.operators import edges, joins, merge, pages, pairs, prepare, reports
from lodestone.operators import select as selection
from lodestone.plans import oracle, workflow
from lodestone.session import table
from lodestone.sources import jsonl, registry

FLAGSHIP = "prepare"


def _flat(df, *arrays):
    """Array columns as texts joined by a bar."""
    for a in arrays:
        df = df.withColumn(a, F.array_join(a, "|"))
    return df


def _prepared(s, d):
    return prepare.prepare(table(s, d, "raw_candidates"))


def prepared_rows(s, d):
    return _flat(_prepared(s, d), "categories", "issues").drop("discovered_at", "candidate_id")


def candidate_ids(s, d):
    return prepare.accepted(_prepared(s, d)).select("row_id", "candidate_id")


def reject_counts(s, d):
    return reports.count_by(_prepared(s, d).withColumn("code", F.coalesce("reject_reason", F.lit("accepted"))), "code")


def issue_counts(s, d):
    return reports.count_items(prepare.accepted(_prepared(s, d)), "issues")


def source_report(s, d):
    return reports.by_source(_prepared(s, d))


def reject_examples(s, d):
    return reports.examples(prepare.rejected(_prepared(s, d)), "reject_reason", "row_id", 5)


def merged_candidates(s, d):
    m = merge.merge_candidates(table(s, d, "raw_candidates"))
    return _flat(m.withColumn("categories", F.array_sort("categories")), "categories").drop("first_seen")


def pending_rows(s, d):
    raw = table(s, d, "raw_candidates").select("row_id", urls.normalize_url(F.col("listing_url")).alias("key"))
    done = table(s, d, "prepared_candidates").select(urls.normalize_url(F.col("listing_url")).alias("key"))
    return joins.pending(raw, done, "key", "row_id")


def cascade_lookup(s, d):
    left = table(s, d, "tools").select("tool_no", urls.product(F.col("website"))["key"].alias("site"), text.canonical_name(F.col("name")).alias("called"))
    right = table(s, d, "prepared_candidates").select("prep_id", "identity_key", urls.product(F.col("website"))["key"].alias("r_site"), text.canonical_name(F.col("name")).alias("r_called"))
    steps = [("identity", "site", "identity_key"), ("website", "site", "r_site"), ("name", "called", "r_called")]
    return joins.cascade(left, right, steps, "prep_id", "prep_id").select("tool_no", "matched", "matched_by")


def known_tools(s, d):
    ids = table(s, d, "match_results").select(F.col("left_id").alias("tool_no")).where("tool_no is not null")
    return joins.allowed(table(s, d, "tools").select("tool_no", "name"), ids, "tool_no")


def block_sizes(s, d):
    return pairs.block_sizes(pairs.blocking_keys(pairs.records(table(s, d, "tools"))))


def candidate_pairs(s, d):
    return pairs.candidate_pairs(pairs.blocking_keys(pairs.records(table(s, d, "tools"))))


def judged_pairs(s, d):
    return pairs.judge_blocks(pairs.records(table(s, d, "tools")))


def match_groups(s, d):
    m = table(s, d, "match_results").where(text.code_word(F.col("decision")) == "merge")
    return pairs.groups(m, "left_id", "right_id")


def golden_records(s, d):
    return _flat(merge.golden_records(table(s, d, "grouped_candidates")), "categories", "source_keys", "issues", "aliases").drop("last_seen")


def quota_selection(s, d):
    t = table(s, d, "tools").select("tool_no", "primary_task", (F.coalesce(F.length("detailed_overview"), F.lit(0)) + F.coalesce(F.size("tags"), F.lit(0)) * 100).cast("double").alias("score"))
    return selection.quota(t, "tool_no", "primary_task", "score", target=200, cap=12)


def relationships(s, d):
    return edges.relationships(table(s, d, "tools")).groupBy("relationship", "confidence").agg(F.count("*").alias("edges"), F.countDistinct(F.lower("target_name")).alias("targets"))


def relationship_rows(s, d):
    return edges.relationships(table(s, d, "tools"))


def active_sources(s, d):
    return registry.active(table(s, d, "source_configs"), "discovery").select("source_key", "name", "tier")


def source_roles(s, d):
    return registry.roles(table(s, d, "source_configs"))


def first_sightings(s, d):
    raw = table(s, d, "raw_candidates").select("row_id", "source_key", "listing_url", "name").where("listing_url is not null")
    return merge.keep_first(raw, ["source_key", "listing_url"], ["row_id"])


def url_parts(s, d):
    raw = table(s, d, "raw_candidates").select("row_id", urls.address(F.col("website")).alias("a"), urls.product(F.col("website")).alias("p"))
    return raw.select("row_id", F.col("a.url").alias("url"), F.col("a.host").alias("host"), F.col("p.domain").alias("domain"), F.col("p.key").alias("product"), F.col("p.root").alias("root"), F.lower(F.try_element_at("a.segments", F.lit(-1))).alias("slug"))


def name_keys(s, d):
    raw = table(s, d, "raw_candidates").select("row_id", text.clean_text(F.col("name")).alias("name"))
    return raw.select("row_id", "name", text.canonical_name(F.col("name")).alias("name_key"), text.slugify(F.col("name")).alias("slug"), F.array_join(F.array_sort(text.name_tokens(F.col("name"))), " ").alias("tokens"))


def name_similarity(s, d):
    """Similarity of each distinct pair of a name's key and its listing's slug."""
    raw = table(s, d, "raw_candidates").select(text.canonical_name(F.col("name")).alias("a"), F.regexp_replace(urls.url_slug(F.col("listing_url")), "[^a-z0-9]", "").alias("b"))
    return raw.groupBy("a", "b").agg(F.count("*").alias("n")).withColumn("ratio", F.round(text.sequence_ratio(F.col("a"), F.col("b")), 6))


def json_roots(s, d):
    raw = table(s, d, "raw_candidates")
    both = raw.select(F.explode(F.array(F.struct(F.lit("raw_signals").alias("field"), F.col("raw_signals").alias("j")), F.struct(F.lit("raw_payload").alias("field"), F.col("raw_payload").alias("j")))).alias("x"))
    return both.select("x.field", F.coalesce(jsonl.root_kind(F.col("x.j")), F.lit("missing")).alias("kind")).groupBy("field", "kind").agg(F.count("*").alias("n"))


def signals(s, d):
    raw = table(s, d, "raw_candidates").select("row_id", "source_key", jsonl.signal(F.col("raw_signals"), "rank").alias("rank"), jsonl.signal(F.col("raw_signals"), "upvotes").alias("upvotes"), F.coalesce(text.tri_state(F.get_json_object("raw_signals", "$.sponsored")), F.lit(False)).alias("sponsored"))
    return raw.groupBy("source_key").agg(F.count("rank").alias("ranked"), F.min("rank").alias("best_rank"), F.max("upvotes").alias("most_upvotes"), F.sum("upvotes").alias("upvotes"), F.count_if("sponsored").alias("sponsored"))


def content_hashes(s, d):
    return table(s, d, "documents").select("doc_id", text.content_hash(F.col("source"), F.col("text")).alias("hash"))


def sentence_counts(s, d):
    return table(s, d, "documents").where("text is not null").select("doc_id", F.size(F.filter(text.sentences(F.col("text")), lambda x: x != "")).alias("sentences"))


def page_challenges(s, d):
    f = table(s, d, "fetch_results").withColumn("challenge", pages.looks_like_challenge(F.col("text"), F.col("status")))
    return f.groupBy("status").agg(F.count("*").alias("pages"), F.count_if("challenge").alias("challenges"))


def page_fingerprints(s, d):
    f = table(s, d, "fetch_results").where("trim(text) <> ''").select("fetch_id", pages.fingerprint(F.col("text")).alias("print"))
    return f.groupBy("print").agg(F.count("*").alias("pages"), F.min("fetch_id").alias("first_id"))


def freshest_pages(s, d):
    return pages.freshest(table(s, d, "fetch_results")).drop("fetched_at")


def decisions(s, d):
    m = table(s, d, "match_results")
    return m.groupBy(F.coalesce(text.code_word(F.col("decision")), F.lit("")).alias("decision"), F.coalesce(text.code_word(F.col("tier")), F.lit("")).alias("tier")).agg(F.count("*").alias("n"), F.round(F.avg("confidence"), 4).alias("confidence"))


QUERIES = {
    "prepare": prepared_rows,
    **{
        f.__name__: f
        for f in (
            candidate_ids, reject_counts, issue_counts, source_report, reject_examples, merged_candidates, pending_rows, cascade_lookup, known_tools, block_sizes,
            candidate_pairs, judged_pairs, match_groups, golden_records, quota_selection, relationships, relationship_rows, active_sources, source_roles,
            first_sightings, url_parts, name_keys, name_similarity, json_roots, signals, content_hashes, sentence_counts, page_challenges, page_fingerprints,
            freshest_pages, decisions,
        )
    },
}


def queries() -> dict:
    return QUERIES | workflow.QUERIES


def oracle_sql() -> dict[str, str]:
    return oracle.SQL | workflow.SQL
