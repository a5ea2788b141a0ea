"""Template residue, filler, error pages and script notices instead of content.

1. Lines are normalised and counted over all pages by address and host (``lines``).
2. A line that recurs on several hosts is judged by what stands beside it: furniture stands beside
   bodies; an error message or a notice that scripts are needed stands, on a good part of its
   pages, where no line is left that is a sentence of the page's own.
3. Recurrent lines are subtracted. What is left of a page is its residual: an unfilled placeholder
   or filler in it, or no sentence at all beside a line that is evidence of an error, excludes it.
4. Seeds (forms of placeholders, words of filler and of errors) start the search; lines that
   recur and stand almost only on pages already found are evidence too.

All of it runs in generated code over exploded lines; texts are not shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm import lines as L
from lodestone.session import cut

# The forms in which template systems write a place to fill.
PLACEHOLDER = (
    r"\{\{[^{}]*\}\}|\$\{[^{}]*\}|#\{[^{}]*\}|<%[^%]*%>|\{%[^%]*%\}|\[\[[^\[\]]*\]\]|@@[\w. -]+@@|\*\|[^|]*\|\*|(?<![\w%])%[A-Z][A-Z0-9_.]*%|(?<!\w)__[A-Z][A-Z0-9_.]*__(?!\w)|"
    r"\$t\('[^']*'\)|(?<![{$#\w])\{[a-z][a-z0-9_.]*\}(?!\})|(?i)\[(?:your|insert|add|enter) [^\[\]]*\]|(?i)<(?:insert|your|add|enter) [^<>]*>"
)
# The words of dummy copy, and how values are printed that a program failed to find.
LATIN = (
    "lorem ipsum dolor sit amet consectetur adipiscing elit sed eiusmod tempor labore dolore magna aliqua enim minim veniam nostrud ullamco laboris nisi aliquip "
    "commodo aute irure reprehenderit voluptate velit esse cillum fugiat nulla pariatur excepteur sint occaecat cupidatat proident culpa officia deserunt mollit anim laborum"
).split()
FAILED = r"(?<![\w-])(?:undefined|NaN|\[object Object\]|Invalid Date|#REF!|#VALUE!|#N/A|NoneType)(?![\w-])|^(?:null|None|nil)$|(?<=\s)null(?=\s|$)"
# Seeds of filler; further lines are found by the company they keep.
FILLER = r"(?i)\b(?:sample|dummy|filler|placeholder) (?:text|copy|paragraph)\b|\b(?:text|description|headline|title|content|summary|tagline) goes here\b|\byour \w+ here\b|\b(?:double )?click to edit\b|\bblindtext\b|\btexte provisoire\b|\btexto de relleno\b|\bTODO:|\b(?:blah|asdf|qwerty) (?:blah|asdf|qwerty)\b"
# Words by which a sentence speaks of placeholders and filler, not holds them.
MENTION = (
    r"(?i)\b(?:such as|like|e\.g\.|for example|for instance|called|named|syntax|placeholders?|variables?|swap(?:s|ped)?|replaces?|fill(?:s|ed)? it|fills? in|converts?|detects?|finds?|checks?|lists?|listed|"
    r"explains?|highlights?|warns?)\b.*(?:{p}|lorem)|(?:{p}|lorem).*\b(?:swap(?:s|ped)?|replaces?|fill(?:s|ed)? it|fills? in|listed|highlighted|explained|syntax|placeholders?|variables?)\b|\b\w+-variable\b"
)
# Seeds of error messages and of notices about scripts.
ERRORS = r"(?i)\b(?:not found|introuvable|nicht gefunden|no encontrada|forbidden|access denied|(?:bad|internal|server|gateway|application|fatal) (?:gateway|error|server|time-?out)|service unavailable|traceback|exception|unavailable|timed? ?out|does not exist|blocked|too many requests)\b|\berror\b"
SCRIPTS = (
    r"(?i)\b(?:javascript|scripts?|scripting)\b.*\b(?:enabled?|disabled|activated?|turn|required?|needed|needs?|switch|on|off|must|blocks?)\b|"
    r"\b(?:enable|activate|activar|activer|aktivieren|allow|turn on|switch|requires?|needs?)\b.*\b(?:javascript|scripts?)\b|\b(?:javascript|scripts?)\b.*\b(?:activar|activer|aktivieren)\b|"
    r"\b(?:checking|looking at|look at|verifying|verify)\b.*\b(?:human|browser|robot|connection)\b|\byour browser\b"
)
#: A recurrent line tells an error when this share of its addresses has no sentence of its own beside it, a notice from the second share on.
ALONE, SOMETIMES = 0.8, 0.25
#: A recurrent line is evidence when this share of its addresses is already found.
COMPANY = 0.9


def _sentences(line: Column) -> Column:
    return F.split(line, "(?<=[.!?])\\s+")


def _unfilled(line: Column) -> Column:
    """Whether a line has an unfilled place that it does not merely speak of."""
    p = PLACEHOLDER.replace("(?i)", "")
    mention = MENTION.replace("{p}", p)
    found = F.exists(_sentences(line), lambda s: s.rlike(PLACEHOLDER) & ~s.rlike(mention))
    return F.when(line.rlike("[{}\\[<%@*]|__|\\$t"), found).otherwise(F.lit(False))


def _filled(line: Column) -> Column:
    """Whether a line has dummy copy or a value that failed to print."""
    latin = "\\b(?:" + "|".join(LATIN) + ")\\b"
    low = F.lower(line)
    dummy = F.when(low.rlike("lorem|ipsum|dolor|amet|elit|tempor|labore|magna|aliqu|nulla|culpa|mollit"), F.regexp_count(low, F.lit(latin)) >= F.greatest(F.lit(3), 0.6 * F.regexp_count(low, F.lit("[a-z]+")))).otherwise(F.lit(False))
    spoken = line.rlike(MENTION.replace("{p}", "undefined|null|NaN"))
    failed = F.when(line.rlike("undefined|NaN|object|Invalid|#|None|nil|null"), line.rlike(FAILED) & ~spoken).otherwise(F.lit(False))
    said = F.when(low.rlike("text|copy|paragraph| here|click|blind|todo|blah|asdf|qwerty"), line.rlike(FILLER) & ~line.rlike("(?i)\\b(?:swaps?|replaces|for real|such as)\\b")).otherwise(F.lit(False))
    return dummy | failed | said


def page_lines(fetches: DataFrame) -> DataFrame:
    """The lines of all pages with what each tells by itself: unfilled, filled, wrong, script."""
    f = fetches.select("fetch_id", "url", "final_url", "text", "status").where("fetch_id is not null")
    x = F.trim(F.col("line"))
    return L.of_pages(f, "fetch_id", ("unfilled", _unfilled(x)), ("filled", _filled(x)), ("wrong", F.lower(x).rlike(ERRORS.replace("(?i)", "")) & ~x.endswith("?")), ("script", x.rlike("(?i)script|browser|human|robot") & x.rlike(SCRIPTS)), ("size", F.length(x)))


def host_lines(fetches: DataFrame) -> DataFrame:
    """(key, hosts, addresses): on how many hosts and addresses each normalised line stands."""
    f = fetches.select("fetch_id", "url", "final_url", "text").where("fetch_id is not null")
    return L.recurrence(L.of_pages(f, "fetch_id"))


def excluded(fetches: DataFrame, hosts: int = L.HOSTS) -> DataFrame:
    """(fetch_id, reason) of the records to exclude: placeholder, filler, error or script.

    Lines are counted over all pages by address and host. A line on ``hosts`` or more hosts is
    subtracted from a page's own sentences; among those lines the ones that mostly stand alone
    are evidence of an error or a notice. Null texts and ids are no cases, and neither is an
    empty text; rows that repeat a fetch_id count once.
    """
    lines = cut(page_lines(fetches))
    rows = lines.count()
    known = L.recurrence(lines).where(F.col("hosts") >= hosts).select("key", "addresses")
    lines = cut(L.with_counts(lines, known, rows).withColumn("recurs", F.col("addresses").isNotNull()).drop("addresses"))
    hit = F.col("unfilled") | F.col("filled")
    own = F.col("prose") & ~F.col("recurs") & ~hit & ~F.col("wrong") & ~F.col("script")
    found = lines.groupBy("fetch_id").agg(F.max(own).alias("bodied"), F.max(hit).alias("hit"))
    told = lines.where("recurs").join(found, "fetch_id")
    alone = ~F.col("bodied") & ~F.col("hit")
    company = L.recurrence(told, ("all_hits", F.col("hit")), ("alone", alone))
    company = company.select("key", "addresses", (F.col("all_hits") >= COMPANY * F.col("addresses")).alias("follows"), (F.col("alone") / F.col("addresses")).alias("share"))
    lines = L.with_counts(lines, company, rows)
    evidence = F.when(F.col("recurs"), (F.col("share") >= ALONE) | ((F.col("share") >= SOMETIMES) & (F.col("wrong") | F.col("script")))).otherwise(F.col("wrong") | F.col("script"))
    page = lines.groupBy("fetch_id").agg(
        F.max(F.col("unfilled")).alias("placeholder"),
        F.max(F.col("filled") | (F.coalesce("follows", F.lit(False)) & ~F.col("unfilled"))).alias("filler"),
        F.max(own).alias("bodied"),
        F.max(F.coalesce(evidence, F.lit(False)) & ~F.col("script")).alias("error"),
        F.max(F.coalesce(evidence, F.lit(False)) & F.col("script")).alias("script"),
    )
    reason = F.when(F.col("placeholder"), "placeholder").when(F.col("filler"), "filler").when(~F.col("bodied") & F.col("error"), "error").when(~F.col("bodied") & F.col("script"), "script")
    return page.select("fetch_id", reason.alias("reason")).where("reason is not null")
