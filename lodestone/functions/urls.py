"""Web addresses as Spark columns: one normal form, hosts, registrable domains, product identity."""

from functools import partial

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestone.functions.address import GENERIC, INDEX_FILES, SHARED_HOSTS, SUFFIXES, TRACKING, TRACKING_PREFIXES, absolute, is_asset, outside, parsed, registrable
from lodestone.functions.batches import per_value
from lodestone.functions.text import canonical_name

# Fixed value: the name space of entity ids.
NAMESPACE = "96698491-5cba-59c7-87fb-7227140cc168"

_ADDRESS = "struct<url:string,host:string,segments:array<string>,product:struct<host:string,domain:string,segments:array<string>,key:string,root:boolean,shared:boolean>>"
_LIST = pa.list_(pa.string())
_PRODUCT = pa.struct([("host", pa.string()), ("domain", pa.string()), ("segments", _LIST), ("key", pa.string()), ("root", pa.bool_()), ("shared", pa.bool_())])
_KIND = pa.struct([("url", pa.string()), ("host", pa.string()), ("segments", _LIST), ("product", _PRODUCT)])


def address(url: Column, keep_query: bool = True, keep_path: bool = True, force_https: bool = True) -> Column:
    """struct(url, host, segments, product): the normal form of an address, its host, decoded path
    segments and product; null if it is no http address. One Arrow pass per distinct value."""
    fn = partial(parsed, keep_query=keep_query, keep_path=keep_path, force_https=force_https)
    return per_value(f"address {keep_query} {keep_path} {force_https}", fn, _ADDRESS, _KIND)(url)


def normalize_url(url: Column, keep_query: bool = True, keep_path: bool = True, force_https: bool = True) -> Column:
    """The normal form of an address, or null."""
    return address(url, keep_query, keep_path, force_https)["url"]


def registrable_domain(host: Column) -> Column:
    """The domain a host was registered under."""
    return per_value("registrable", registrable, "string", pa.string())(host)


def same_site(a: Column, b: Column) -> Column:
    """Whether two hosts share a registrable domain; false if either is missing."""
    return F.coalesce(registrable_domain(a) == registrable_domain(b), F.lit(False))


def is_internal(url: Column, site: Column) -> Column:
    """Whether two addresses lie under one registrable domain; false if either is none."""
    return F.coalesce(product(url)["domain"] == product(site)["domain"], F.lit(False))


def is_probably_url(value: Column) -> Column:
    """Whether a text has the shape of an address; null is none."""
    v = F.trim(value)
    host = F.regexp_extract(v, "^(?:[a-zA-Z][a-zA-Z0-9+.-]*://)?([^/?#]*)", 1)
    bare = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":.*$", "")
    return F.coalesce((v != "") & ~F.contains(v, F.lit(" ")) & bare.rlike("^[^.].*\\..*[^.]$"), F.lit(False))


def product(url: Column) -> Column:
    """struct(host, domain, segments, key, root, shared): the product that an address stands for.

    A leading locale and trailing pages of any product ('pricing', 'login') are no part of it.
    """
    return address(url)["product"]


def path_conflict(a: Column, b: Column) -> Column:
    """Whether two products of one host lie on paths of which neither leads to the other."""
    n = F.least(F.size(a["segments"]), F.size(b["segments"]))
    return (a["host"] == b["host"]) & ~a["root"] & ~b["root"] & (F.slice(a["segments"], F.lit(1), n) != F.slice(b["segments"], F.lit(1), n))


def identity_of(products: list[tuple[str, Column, str]], name_key: Column, firm_key: Column | None = None) -> Column:
    """struct(key, basis, confidence): the strongest identity of a record, or null.

    ``products`` are (kind, product, confidence), strongest first; after them comes the name's
    key (with the company's). The root of a shared host identifies nothing.
    """
    made = lambda k, b, c: F.named_struct(F.lit("key"), k, F.lit("basis"), b, F.lit("confidence"), F.lit(c))

    def placed(kind: str, p: Column, confidence: str) -> Column:
        basis = F.when(p["root"], F.lit(f"{kind}_domain")).otherwise(F.lit(f"{kind}_product_url"))
        return F.when(p.isNotNull() & ~(p["shared"] & p["root"]), made(p["key"], basis, confidence))

    named = F.when(name_key.isNotNull(), made(name_key, F.lit("name"), "low"))
    if firm_key is not None:
        named = F.when(name_key.isNotNull() & firm_key.isNotNull(), made(F.concat(name_key, F.lit("@"), firm_key), F.lit("name+company"), "medium")).otherwise(named)
    return F.coalesce(*[placed(*p) for p in products], named)


def identity(name: Column, website: Column, listing: Column, company: Column | None = None, canonical: Column | None = None) -> Column:
    """``identity_of`` raw texts: a canonical address before the website, then the listing, then the name."""
    products = [] if canonical is None else [("canonical", product(canonical), "high")]
    products += [("website", product(website), "high"), ("listing", product(listing), "medium")]
    return identity_of(products, canonical_name(name), None if company is None else canonical_name(company))


def entity_id(kind: str, key: Column) -> Column:
    """The version-5 UUID of an entity, from its kind and identity key."""
    seed = F.concat(F.lit(f"{kind.strip().lower()}:"), F.lower(F.trim(key)))
    h = F.sha1(F.concat(F.unhex(F.lit(NAMESPACE.replace("-", ""))), F.encode(seed, "UTF-8")))
    part = lambda a, n: F.substring(h, a, n)
    variant = F.lower(F.hex(F.conv(part(17, 2), 16, 10).cast("int").bitwiseAND(63).bitwiseOR(128)))
    return F.when(key.isNotNull(), F.concat(part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-"), variant, part(19, 2), F.lit("-"), part(21, 12)))


def candidate_key(name: Column, website: Column, listing: Column) -> Column:
    """Exact-identity key of a sighting: its site, else its listing, else its name."""
    p = product(website)
    site = F.when(p.isNotNull(), F.concat(F.when(p["root"], F.lit("domain:")).otherwise(F.lit("url:")), p["key"]))
    page = F.concat(F.lit("listing:"), normalize_url(listing))
    return F.coalesce(site, page, F.concat(F.lit("name:"), F.lower(F.trim(F.coalesce(name, F.lit(""))))))


def url_slug(url: Column) -> Column:
    """Last path segment, lower case, or null."""
    return F.lower(F.try_element_at(address(url)["segments"], F.lit(-1)))


def looks_like_asset(url: Column) -> Column:
    """Whether an address names a file to load, not a page; no address is one."""
    return F.coalesce(per_value("asset", is_asset, "boolean", pa.bool_())(url), F.lit(True))


def absolutize(href: Column, base: Column) -> Column:
    """The normal form of a link on a page, or null where it leads to no page."""

    @F.arrow_udf("string")
    def joined(h: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([None if x is None else absolute(x, y) for x, y in zip(h.to_pylist(), b.to_pylist())], pa.string())

    return joined(href, base)


def absolutize_all(hrefs: Column, base: Column) -> Column:
    """The links of a page in normal form, in order, null where one leads to no page."""

    @F.arrow_udf("array<string>")
    def joined(h: pa.Array, b: pa.Array) -> pa.Array:
        rows = [None if x is None else [None if v is None else absolute(v, y) for v in x] for x, y in zip(h.to_pylist(), b.to_pylist())]
        return pa.array(rows, pa.list_(pa.string()))

    return joined(hrefs, base)


def off_site(hrefs: Column, base: Column) -> Column:
    """The links of a page that lead to pages of other sites, in normal form and order, each once."""

    @F.arrow_udf("array<string>")
    def away(h: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([None if x is None else outside(x, y) for x, y in zip(h.to_pylist(), b.to_pylist())], pa.list_(pa.string()))

    return away(hrefs, base)
