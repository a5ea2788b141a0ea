"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone.llm import canonical, components, contamination, history, linkage, mainbody, mixing, oracles, residue, survivor, visual
from lodestone.session import table


# Further names of entries of the reference list, by label; the table that the queries of problem 2 hand over.
ALIASES = {
    "Writing and Editing": ("blog writer", "ghostwriting"),
    "Image Creation": ("artwork", "illustrations"),
    "Photo Retouching": ("picture cleanup",),
    "Video Production": ("movie maker", "reels"),
    "Music and Sound": ("beat maker", "soundtracks"),
    "Speech Synthesis": ("read aloud", "tts"),
    "Transcription": ("dictation", "captioning"),
    "Translation": ("interpreter",),
    "Customer Service": ("live chat support",),
    "Sales Outreach": ("crm helper", "lead generation"),
    "Marketing Campaigns": ("promotion", "growth"),
    "Search Ranking": ("serp",),
    "Software Development": ("code assistant", "dev tools"),
    "Data Analytics": ("charts",),
    "Spreadsheets": ("tabular work",),
    "Presentations": ("slideshow",),
    "Meeting Assistance": ("standup bot",),
    "Workflow Automation": ("rpa",),
    "Education and Tutoring": ("courses", "e-learning"),
    "Recruiting": ("applicant tracking", "talent search"),
    "Legal Work": ("attorney tools",),
    "Health and Wellness": ("clinic",),
    "Finance and Accounting": ("budgeting", "fintech"),
    "Online Retail": ("storefront",),
    "Games and Play": ("fun",),
    "Research Papers": ("citations", "science"),
    "Security and Privacy": ("data protection",),
    "Social Networks": ("influencers",),
    "Chat Companions": ("chatbot",),
    "Three-Dimensional Modeling": ("cad",),
    "free": ("costs nothing", "$0"),
    "freemium": ("basic free",),
    "subscription": ("per month", "recurring"),
    "one_time": ("single purchase",),
    "usage_based": ("billed by consumption", "per request"),
    "credits": ("prepaid credits",),
    "open_source": ("source available free",),
    "contact_sales": ("custom quote", "ask for price"),
    "paid": ("premium only",),
}


def _aliases(spark, d):
    """(field_name, label, alias): the further names, for the fields that have an entry of the label."""
    named = spark.createDataFrame([(label, x) for label, names in ALIASES.items() for x in names], "label string, alias string")
    return table(spark, d, "canonical_values").select("field_name", "label").join(named, "label")


def _p1(spark, d):
    return linkage.row_pairs(table(spark, d, "raw_candidates"), table(spark, d, "source_configs")).select("left_row_id", "right_row_id")


def _p1_scored(spark, d):
    """The pairs of profiles that were compared, each with the model's posterior."""
    return linkage.scored(table(spark, d, "raw_candidates"), table(spark, d, "source_configs"))


def _p1_products(spark, d):
    """Which product each row shows, with the confidence of its best link."""
    return linkage.products(table(spark, d, "raw_candidates"), table(spark, d, "source_configs")).select("row_id", "product", "confidence")


def _p2(spark, d):
    return canonical.canonical_values(table(spark, d, "raw_candidates"), table(spark, d, "tools"), table(spark, d, "canonical_values"), _aliases(spark, d))


def _p2_all(spark, d):
    """All entries within the distance allowed for a value, with their distances."""
    return canonical.canonical_values(table(spark, d, "raw_candidates"), table(spark, d, "tools"), table(spark, d, "canonical_values"), _aliases(spark, d), every=True)


def _p2_unmatched(spark, d):
    """How many values of each field are on the list, and how many are not."""
    return _p2(spark, d).groupBy("field_name").agg(F.count_if(F.col("canonical_id") > 0).alias("matched"), F.count_if(F.col("canonical_id") == 0).alias("unmatched"))


def _p3(spark, d):
    return residue.excluded(table(spark, d, "fetch_results")).select("fetch_id")


def _p3_lines(spark, d):
    """On how many hosts and addresses each normalised line stands, over all pages."""
    return residue.host_lines(table(spark, d, "fetch_results")).groupBy("hosts", "addresses").agg(F.count("*").alias("lines"))


def _p4(spark, d):
    return history.repeats(table(spark, d, "prepared_candidates"), table(spark, d, "source_configs"))


def _p4_near(spark, d):
    """Rows of later batches whose description nearly repeats an accepted one, with their class."""
    return history.near_repeats(table(spark, d, "prepared_candidates"))


def _p5(spark, d):
    return mainbody.main_body(table(spark, d, "fetch_results"), table(spark, d, "tools"))


def _p6(spark, d):
    return components.grouped_tools(table(spark, d, "match_results"))


def _p6_links(spark, d):
    return components.merge_links(table(spark, d, "match_results"))


def _p7(spark, d):
    return survivor.survivors(table(spark, d, "grouped_candidates"), table(spark, d, "source_configs")).select("group_no", "field_name", "prep_id")


def _p7_records(spark, d):
    """One surviving record per group with a usable value."""
    s = survivor.survivors(table(spark, d, "grouped_candidates"), table(spark, d, "source_configs"))
    return s.groupBy("group_no").agg(F.max("value_text").alias("observed_description"), F.max(F.array_join("value_list", "|")).alias("categories"))


def _p8(spark, d):
    return contamination.leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def _p9_mix(spark, d):
    return mixing.plan(table(spark, d, "documents"), table(spark, d, "mix_targets"))[0]


def _p9_shares(spark, d):
    return mixing.plan(table(spark, d, "documents"), table(spark, d, "mix_targets"))[1]


def _p10(spark, d):
    return visual.look_alike_pairs(table(spark, d, "documents"))


def _p10_forms(spark, d):
    return visual.forms(table(spark, d, "documents"))


def queries() -> dict:
    return {
        "p1_found": _p1,
        "p1_scored": _p1_scored,
        "p1_products": _p1_products,
        "p2_found": _p2,
        "p2_all": _p2_all,
        "p2_unmatched": _p2_unmatched,
        "p3_found": _p3,
        "p3_lines": _p3_lines,
        "p4_found": _p4,
        "p4_near": _p4_near,
        "p5_found": _p5,
        "p6_found": _p6,
        "p6_links": _p6_links,
        "p7_found": _p7,
        "p7_records": _p7_records,
        "p8_found": _p8,
        "p9_mix": _p9_mix,
        "p9_shares": _p9_shares,
        "p10_found": _p10,
        "p10_forms": _p10_forms,
    }


def oracle_sql() -> dict[str, str]:
    return oracles.SQL
