"""DuckDB counterparts of the column functions, as text to put into statements."""

from __future__ import annotations

from lodestone.functions import text, urls


def words(values) -> str:
    """A list of string literals."""
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def plain(c: str) -> str:
    """collapse_whitespace with compatibility forms of the signs that occur."""
    return f"trim(regexp_replace(replace(replace({c}, '™', 'TM'), '…', '...'), '[ \\t\\x{{00A0}}\\x{{200B}}-\\x{{200D}}\\x{{FEFF}}]+', ' ', 'g'))"


def clean(c: str, size: int | None = None) -> str:
    t = f"case when {plain(c)} = '' or lower({plain(c)}) in ({words(text.PLACEHOLDERS)}) then null else {plain(c)} end"
    return t


def fold(c: str) -> str:
    """Compatibility decomposition without what is not ASCII, for accents and the signs that occur."""
    return f"regexp_replace(strip_accents(replace(replace(replace({c}, '™', 'TM'), '…', '...'), chr(160), ' ')), '[^\\x00-\\x7F]', '', 'g')"


def slug(c: str) -> str:
    return f"nullif(trim(regexp_replace(lower({fold(c)}), '[^a-z0-9]+', '-', 'g'), '-'), '')"


def head(c: str) -> str:
    out = c
    for s in reversed(text.SEPARATORS):
        out = f"case when contains({c}, '{s}') and length(trim(split_part({c}, '{s}', 1))) >= 2 then trim(split_part({c}, '{s}', 1)) else {out} end"
    return out


def tokens(c: str) -> str:
    return f"list_filter(string_split_regex(lower({fold(c)}), '[^a-z0-9]+'), lambda x: x <> '')"


def key_of_tokens(t: str) -> str:
    rest = f"list_filter({t}, lambda x: x not in ({words(text.NAME_NOISE)}))"
    return f"nullif(array_to_string(case when len({t}) > 1 and len({rest}) > 0 then {rest} else {t} end, ''), '')"


def named(source: str, ident: str, column: str, out: str) -> str:
    """CTEs <out>(id, name, key) of a name column."""
    return f"""{out}0 as (select {ident} as id, {clean(column)} as name from {source}),
{out}1 as (select id, name, {head('name')} as h from {out}0),
{out}2 as (select id, name, {tokens('h')} as t from {out}1),
{out} as (select id, name, {key_of_tokens('t')} as key from {out}2)"""


_SAFE = [("%2F", "/"), ("%7E", "~"), ("%21", "!"), ("%24", "$"), ("%26", "&"), ("%27", "''"), ("%28", "("), ("%29", ")"), ("%2A", "*"), ("%2B", "+"), ("%2C", ","), ("%3B", ";"), ("%3D", "="), ("%3A", ":"), ("%40", "@"), ("%25", "%")]


def addresses(source: str, ident: str, column: str, out: str) -> str:
    """CTEs <out>(id, url, host, segs, domain, psegs, key, root, shared) of an address column."""
    quoted = "url_encode(array_to_string(segs, '/'))"
    for a, b in _SAFE:
        quoted = f"replace({quoted}, '{a}', '{b}')"
    tracked = f"lower(p) in ({words(urls.TRACKING)}) or " + " or ".join(f"starts_with(lower(p), '{x}')" for x in urls.TRACKING_PREFIXES)
    tracked = tracked.replace("lower(p)", "lower(regexp_extract(p, '^([^=]*)', 1))")
    many = "|".join(s.replace(".", "\\.") for s in urls.SUFFIXES)
    return f"""{out}0 as (select {ident} as id, regexp_replace(regexp_replace({column}, '[\\s\\x{{00A0}}]', '', 'g'), '^[<>"'']+|[<>"'']+$', '', 'g') as u from {source}),
{out}1 as (select id, case when starts_with(u, '//') then 'https:' || u else u end as u from {out}0),
{out}2 as (select id, case when not regexp_matches(u, '^[a-zA-Z][a-zA-Z0-9+.-]*://') then 'https://' || regexp_replace(u, '^/+', '') else u end as u from {out}1),
{out}3 as (select id, regexp_extract(u, '^([a-zA-Z][a-zA-Z0-9+.-]*)://(?:[^/?#@]*@)?([^/?#:@]*)(?::(\\d*))?([^?#]*)(?:\\?([^#]*))?(?:#(.*))?$', ['s', 'h', 'port', 'path', 'q', 'route']) as p from {out}2),
{out}4 as (select id, p, regexp_replace(regexp_replace(lower(p.h), '\\.+$', ''), '^www\\.', '') as host, list_filter(string_split(url_decode(p.path), '/'), lambda x: x <> '') as segs
  from {out}3 where lower(p.s) in ('http', 'https') and contains(regexp_replace(lower(p.h), '\\.+$', ''), '.')),
{out}5 as (select id, p, host, case when lower(segs[-1]) in ({words(urls.INDEX_FILES)}) then segs[:-2] else segs end as segs,
  list_sort(list_transform(list_filter(string_split(p.q, '&'), lambda p: p <> '' and not ({tracked})), lambda x: {{'k': regexp_extract(url_decode(replace(x, '+', ' ')), '^([^=]*)', 1), 'v': regexp_replace(url_decode(replace(x, '+', ' ')), '^[^=]*=?', '')}})) as q from {out}4),
{out}6 as (select id, host, segs, {quoted} as path, array_to_string(list_transform(q, lambda x: url_encode(x.k) || '=' || url_encode(x.v)), '&') as q, p from {out}5),
{out}7 as (select id, host, segs, path, 'https://' || host || case when p.port in ('', '80', '443', '0') then '' else ':' || p.port end || '/' || path || case when q <> '' then '?' || q else '' end || case when regexp_matches(p.route, '^[/!]') then '#' || p.route else '' end as url from {out}6),
{out}8 as (select id, host, segs, case when path <> '' and url[-1] = '/' then url[:-2] else url end as url,
  case when len(string_split(host, '.')) <= 2 then host else array_to_string(string_split(host, '.')[-(case when regexp_matches(host, '\\.({many})$') then len(string_split(regexp_extract(host, '\\.({many})$', 1), '.')) + 1 else 2 end):], '.') end as domain,
  list_transform(segs, lambda x: lower(x)) as s from {out}7),
{out}9 as (select id, url, host, segs, domain, case when regexp_matches(coalesce(s[1], ''), '^[a-z]{{2}}(-[a-z]{{2}})?$') then s[2:] else s end as s from {out}8),
{out}10 as (select id, url, host, segs, domain, s[1:coalesce(list_max(list_transform(s, lambda x, i: case when x not in ({words(urls.GENERIC)}) then i else 0 end)), 0)] as psegs from {out}9),
{out} as (select id, url, host, segs, domain, psegs, host || case when len(psegs) > 0 then '/' || array_to_string(psegs, '/') else '' end as key, len(psegs) = 0 as root, domain in ({words(urls.SHARED_HOSTS)}) as shared from {out}10)"""
