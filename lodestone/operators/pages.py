"""Stored pages: challenges, fingerprints, freshest answers, walks over listings, page views."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.functions import urls

# What the interstitial pages of bot protection say.
CHALLENGE = (
    "just a moment...", "enable javascript and cookies to continue", "checking your browser before accessing", "cf-browser-verification", "cf_chl_opt",
    "attention required! | cloudflare", "ddos protection by", "access denied", "request unsuccessful. incapsula", "please verify you are a human",
)
# Refusals, and from what size on the body of one may be real content.
REFUSED, LONG_BODY = (401, 403, 429), 200_000
VIEW = "struct<title:string,metas:map<string,string>,headings:array<struct<level:int,text:string>>,bullets:array<string>,anchors:array<struct<href:string,label:string>>,images:array<struct<src:string,alt:string>>,jsonld:array<string>,has_password:boolean,text:string>"


def looks_like_challenge(body: Column, status: Column, first: int | None = None) -> Column:
    """Whether a page is a bot check: a refusal without a long body, or what the page says.

    The whole page is searched, or its ``first`` characters if they are given.
    """
    refused = F.coalesce(status.isin(*REFUSED), F.lit(False)) & (F.coalesce(F.length(body), F.lit(0)) < LONG_BODY)
    said = F.lower(body if first is None else F.substring(body, 1, first)).rlike("|".join("\\Q" + m + "\\E" for m in CHALLENGE))
    return refused | F.coalesce(said, F.lit(False))


# What the pages of products say that have ended, and of domains that are for sale.
DEAD = (
    "domain is for sale", "buy this domain", "this domain may be for sale", "parked domain", "account suspended", "website expired", "coming soon", "under construction",
    "site not found", "no longer available", "we have shut down", "has shut down", "shutting down", "service discontinued", "this project is no longer maintained", "sunset",
    "404 not found", "default web page", "welcome to nginx", "apache2 ubuntu default page", "future home of something quite cool",
)
# Those of them that are also names of features and count only in titles and headings.
AMBIGUOUS = ("coming soon", "under construction", "sunset", "no longer available")
#: Characters from which on a page is taken to say something.
THIN = 400


def is_html(content_type: Column, body: Column) -> Column:
    """Whether an answer is a page: by its content type if it names one, else by its beginning tags."""
    kind = F.lower(F.coalesce(content_type, F.lit("")))
    sniffed = F.coalesce(F.lower(body).rlike("<html|<!doctype html"), F.lit(False))
    return F.when(kind != "", kind.rlike("text/html|application/xhtml")).otherwise(sniffed)


def failure(status: Column, body: Column, url: Column, final_url: Column, headings: Column | None = None) -> Column:
    """Why an answer proves no product, the first of: fetch_failed, http_error, redirected_off_site,
    dead_or_parked, thin_content; null where none applies. ``headings`` is the text of title and
    headings, the only place where ambiguous words count."""
    sure = "|".join("\\Q" + m + "\\E" for m in DEAD if m not in AMBIGUOUS)
    dead = F.lower(body).rlike(sure)
    if headings is not None:
        dead = dead | F.coalesce(F.lower(headings).rlike("|".join(AMBIGUOUS)), F.lit(False))
    away = F.coalesce(urls.product(url)["domain"] != urls.product(final_url)["domain"], F.lit(False))
    return (
        F.when(body.isNull() | status.isNull(), "fetch_failed")
        .when(status >= 400, "http_error")
        .when(away, "redirected_off_site")
        .when(dead, "dead_or_parked")
        .when(F.length(body) < THIN, "thin_content")
    )


def link_paths(body: Column) -> Column:
    """The distinct links of a page in order, without query and fragment; links that lead to no page
    and those that change with every answer are left out."""
    links = F.transform(F.regexp_extract_all(body, F.lit("(?i)<a\\s[^>]*?href\\s*=\\s*[\"']([^\"']*)"), 1), F.trim)
    pages = F.filter(links, lambda x: ~x.rlike("^(#|javascript:|mailto:|tel:|data:)"))
    paths = F.transform(pages, lambda x: F.regexp_replace(x, "[?#].*$", ""))
    return F.array_distinct(F.filter(paths, lambda x: (x != "") & ~F.contains(x, F.lit("/cdn-cgi/"))))


def fingerprint(body: Column, links: int | None = None, characters: int | None = None) -> Column:
    """SHA-256 of a page: its distinct link paths in order, else its whole text; null for no page.

    At most ``links`` links or ``characters`` count, if those are given.
    """
    found = link_paths(body) if links is None else F.slice(link_paths(body), 1, links)
    rest = body if characters is None else F.substring(body, 1, characters)
    return F.when(F.trim(body) != "", F.sha2(F.when(F.size(found) > 0, F.array_join(found, "\n")).otherwise(rest), 256))


def freshest(fetches: DataFrame) -> DataFrame:
    """(page, fetch_id, fetched_at, fetches): the latest good answer (2xx with a text) per address.

    Null times are earliest, ties go to the larger fetch_id. One partial aggregation; page texts
    are not moved.
    """
    good = fetches.where("status between 200 and 299 and text is not null").select(urls.normalize_url(F.col("url")).alias("page"), "fetch_id", "fetched_at").where("page is not null")
    top = F.max(F.struct(F.coalesce(F.unix_micros(F.col("fetched_at").cast("timestamp")), F.lit(-(2**62))).alias("t"), "fetch_id", "fetched_at"))
    return good.groupBy("page").agg(top.alias("m"), F.count("*").alias("fetches")).select("page", "m.fetch_id", "m.fetched_at", "fetches")


def walk(pages: DataFrame, max_pages: int = 100, failures: int = 2, limit: int | None = None) -> DataFrame:
    """Stored listing pages (source_key, page_no, body, status, cards) with the walk's stop_reason.

    A walk goes page by page and ends at the first page that is one too many, was seen under its
    ``url`` before, is one of too many failures in a row, is a bot check, repeats an earlier one,
    is empty, brings the cards to the ``limit`` or, where ``next_url`` is a column, names no next
    page; that page's reason is given, later pages are left out. Windows are per source, over
    page numbers, not over texts.
    """
    by = W.partitionBy("source_key").orderBy("page_no")
    own = lambda c, kind: F.col(c) if c in pages.columns else F.lit(None).cast(kind)
    p = pages.select(
        "source_key", "page_no", "cards", "status", looks_like_challenge(F.col("body"), F.col("status")).alias("challenge"), fingerprint(F.col("body")).alias("print"), F.col("body").isNull().alias("failed"),
        own("url", "string").alias("url"), own("next_url", "string").alias("next"),
    )
    again = lambda c: F.col(c).isNotNull() & (F.row_number().over(W.partitionBy("source_key", c).orderBy("page_no")) > 1)
    p = p.withColumn("seen", again("print")).withColumn("seen_url", again("url"))
    lost = F.lit(True)
    for k in range(failures):
        lost = lost & F.coalesce(F.lag("failed", k).over(by), F.lit(False))
    cards = F.coalesce("cards", F.lit(0))
    good = ~F.col("failed")
    reason = (
        F.when(F.row_number().over(by) > max_pages, "max_pages")
        .when(F.col("seen_url"), "seen_url")
        .when(lost, "consecutive_failures")
        .when(good & F.col("challenge"), "bot_challenge")
        .when(good & F.col("seen"), "repeated_content")
        .when(good & (cards == 0), "empty_page")
    )
    if limit is not None:
        reason = reason.when(F.sum(cards).over(by) >= limit, "limit")
    if "next_url" in pages.columns:
        reason = reason.when(good & F.col("next").isNull(), "no_next")
    p = p.withColumn("stop_reason", reason)
    stop = F.min(F.when(F.col("stop_reason").isNotNull(), F.col("page_no"))).over(W.partitionBy("source_key"))
    return p.withColumn("_stop", stop).where("_stop is null or page_no <= _stop").select("source_key", "page_no", "cards", "stop_reason")


def frontier(listing: Column, pages: Column) -> Column:
    """Addresses of a listing's pages, from a template with {page}."""
    return F.transform(F.sequence(F.lit(1), pages), lambda n: F.replace(listing, F.lit("{page}"), n.cast("string")))


class _View(HTMLParser):
    SKIP = frozenset(("script", "style", "noscript", "template", "svg"))

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.title, self.metas, self.headings, self.bullets, self.anchors, self.images, self.jsonld, self.words = "", {}, [], [], [], [], [], []
        self.password = False
        self.seen: dict[int, int] = {}  # images before each open anchor
        self.open: list[tuple[str, list[str], dict]] = []
        self.skip: list[str] = []

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if tag == "meta" and (name := a.get("property") or a.get("name")):
            self.metas.setdefault(name.lower(), a.get("content", ""))
        elif tag == "img":
            self.images.append((a.get("src", ""), a.get("alt", "")))
        elif tag == "input" and a.get("type", "").lower() == "password":
            self.password = True
        elif tag in self.SKIP:
            self.skip.append(tag)
            if tag == "script" and a.get("type", "").lower() == "application/ld+json":
                self.open.append(("jsonld", [], a))
        elif tag in ("title", "a", "li", "h1", "h2", "h3", "h4"):
            if tag == "a":
                self.seen[id(a)] = len(self.images)
            self.open.append((tag, [], a))

    def handle_endtag(self, tag):
        if tag in self.SKIP and self.skip:
            self.skip.pop()
        name = "jsonld" if tag == "script" else tag
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == name:
                for t in reversed(self.open[k:]):
                    self._close(*t)
                del self.open[k:]
                break

    def _close(self, tag, parts, a):
        text = " ".join("".join(parts).split())
        if tag == "title":
            self.title = self.title or text
        elif tag == "jsonld":
            self.jsonld.append("".join(parts))
        elif tag == "li":
            if text:
                self.bullets.append(text)
        elif tag == "a":
            if a.get("href"):
                alt = next((t for _, t in self.images[self.seen.pop(id(a), len(self.images)) :] if t), "")
                self.anchors.append((a["href"], next((x for x in (a.get("title"), a.get("aria-label"), alt, text) if x), "")))
        elif text:
            self.headings.append((int(tag[1]), text))

    def handle_data(self, data):
        if self.skip:
            if self.open and self.open[-1][0] == "jsonld":
                self.open[-1][1].append(data)
            return
        for t in self.open:
            if t[0] != "jsonld":
                t[1].append(data)
        if not self.open or self.open[0][0] != "title":
            self.words.append(data)


def page_view(body: Column) -> Column:
    """The whole parsed page as a struct: title, metas, headings, bullets, anchors, images, JSON-LD blocks,
    whether it has a password field, and its text. Broken markup gives what could be read; null
    gives null. One Arrow-batched pass; everything else is built on this struct with columns."""

    @F.pandas_udf(VIEW)
    def parse(bodies: pd.Series) -> pd.DataFrame:
        rows = []
        for b in bodies:
            if b is None:
                rows.append((None,) * 9)
                continue
            v = _View()
            try:
                v.feed(b)
                v.close()
                for t in reversed(v.open):
                    v._close(*t)
            except (AssertionError, ValueError):
                pass
            rows.append((v.title, v.metas, [{"level": a, "text": t} for a, t in v.headings], v.bullets, [{"href": h, "label": t} for h, t in v.anchors], [{"src": s, "alt": t} for s, t in v.images], v.jsonld, v.password, " ".join(" ".join(v.words).split())))
        return pd.DataFrame(rows, columns=["title", "metas", "headings", "bullets", "anchors", "images", "jsonld", "has_password", "text"])

    return parse(body)


def jsonld_nodes(view: Column) -> Column:
    """JSON-LD objects of a page view as JSON strings: single ones, lists and @graph members."""
    spread = F.transform(view["jsonld"], lambda j: F.coalesce(F.from_json(F.get_json_object(j, "$.@graph"), "array<string>"), F.when(F.trim(j).startswith("["), F.from_json(j, "array<string>")), F.when(F.get_json_object(j, "$").isNotNull(), F.array(j)), F.array().cast("array<string>")))
    return F.flatten(spread)


def outbound(view: Column, base: Column) -> Column:
    """Off-site page links of a view, in order, each once, in normal form."""
    return urls.off_site(F.transform(view["anchors"], lambda a: a["href"]), base)
