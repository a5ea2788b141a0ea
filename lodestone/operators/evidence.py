"""What a parsed page proves: links that a product offers, slots that bear its name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import brands, text, urls

# What links of a product's own site lead to, by parts of their paths and labels.
OFFERS = (
    ("pricing_link", ("pricing", "plans", "/price", "subscription")),
    ("signup_link", ("sign-up", "signup", "register", "create-account", "get-started", "start-free", "start-for-free")),
    ("login_link", ("login", "log-in", "sign-in", "signin")),
    ("docs_link", ("docs", "documentation", "/api", "developers", "developer")),
    ("download_link", ("download", "install", "add-to-chrome")),
    ("demo_link", ("demo", "playground", "try-it", "try-for-free", "free-trial")),
    ("app_link", ("/app", "dashboard", "console", "/studio", "workspace")),
)
# The fields of a page's head that bear a product's name.
NAMED_METAS = ("og:title", "og:site_name", "twitter:title")


def slots(view: Column) -> dict[str, Column]:
    """The places of a page view where a product brands itself, each a text or null."""
    first = lambda level: F.get(F.filter(view["headings"], lambda h: h["level"] == level), F.lit(0))["text"]
    logo = F.get(F.filter(view["images"], lambda i: F.lower(F.concat(i["src"], F.lit(" "), i["alt"])).contains("logo")), F.lit(0))["alt"]
    metas = {m: F.try_element_at(view["metas"], F.lit(m)) for m in NAMED_METAS}
    return {"title": view["title"], **metas, "h1": first(1), "logo_alt": logo}


def evidence(pages: DataFrame) -> DataFrame:
    """(page_id, offers, named) of pages (page_id, view, url, name).

    ``offers`` are the codes of links to the page's own site, and of a form that asks for a
    password; ``named`` are the slots that bear the name, body text and domain included. Links to
    other sites and to no page prove nothing; a null view, address or name gives empty lists.
    """
    view = F.col("view")
    p = pages.select("page_id", "view", "url", "name", urls.product(F.col("url"))["domain"].alias("domain"), text.canonical_name(F.col("name")).alias("key"))
    p = p.withColumn("links", urls.absolutize_all(F.transform(view["anchors"], lambda a: a["href"]), F.col("url")))
    told = {name: brands.tells_name(F.col("name"), c) for name, c in {**slots(view), "body_text": view["text"]}.items()}
    p = p.select("page_id", "view", "domain", "links", *[c.alias(f"in_{n}") for n, c in told.items()], brands.domain_tells_name(F.col("key"), F.col("url")).alias("in_domain"))
    host = lambda u: F.regexp_extract(u, "^https?://([^/:?#]+)", 1)
    own = F.filter(F.arrays_zip("links", F.transform(view["anchors"], lambda a: a["label"]).alias("labels")), lambda x: x["links"].isNotNull() & ((host(x["links"]) == F.col("domain")) | host(x["links"]).endswith(F.concat(F.lit("."), F.col("domain")))))
    said = F.transform(own, lambda x: F.lower(F.concat(F.regexp_extract(x["links"], "^https?://[^/?#]+([^?#]*)", 1), F.lit(" "), F.coalesce(x["labels"], F.lit("")))))
    p = p.withColumn("said", F.coalesce(said, F.array().cast("array<string>")))

    def leads_to(parts: tuple[str, ...]) -> Column:
        return F.exists("said", lambda s: s.rlike("|".join(parts)))

    offers = [F.when(leads_to(parts), F.lit(code)) for code, parts in OFFERS]
    offers.append(F.when(F.coalesce(view["has_password"], F.lit(False)), F.lit("credential_form")))
    named = [F.when(F.col(f"`in_{n}`"), F.lit(f"name_in_{n}")) for n in told] + [F.when(F.col("in_domain"), F.lit("domain_matches_name"))]
    return p.select("page_id", F.array_compact(F.array(*offers)).alias("offers"), F.array_compact(F.array(*named)).alias("named"))
