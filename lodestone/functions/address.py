"""One web address taken apart and put into normal form, in plain Python."""

from __future__ import annotations

import re
from urllib.parse import parse_qsl, quote, unquote, urlencode, urljoin

# Parameters that track a visitor.
TRACKING_PREFIXES = ("utm_", "pk_", "mc_", "ml_", "vero_", "_hs", "hsa_", "matomo_")
TRACKING = (
    "ref", "ref_src", "referrer", "source", "fbclid", "gclid", "gclsrc", "dclid", "msclkid", "twclid", "igshid", "yclid", "wbraid", "gbraid", "si", "spm",
    "mkt_tok", "trk", "sc_channel", "sc_campaign", "cmpid", "campaignid", "adgroupid", "aff", "affiliate", "partner", "via", "lang_hint",
)
# Files that stand for their folder.
INDEX_FILES = ("index.html", "index.htm", "index.php", "default.aspx", "home.html")
# Public suffixes of more than one label.
SUFFIXES = (
    "co.uk", "org.uk", "ac.uk", "gov.uk", "co.jp", "or.jp", "ne.jp", "co.kr", "com.au", "net.au", "org.au", "co.nz", "com.br", "com.mx", "com.ar",
    "co.in", "net.in", "org.in", "com.sg", "com.hk", "com.tw", "com.tr", "co.za", "com.cn", "net.cn", "org.cn", "gov.cn", "com.ua", "co.il",
    "com.pl", "com.es", "com.pt", "com.my", "co.id", "com.ph", "com.vn", "github.io", "gitlab.io", "pages.dev", "workers.dev", "vercel.app",
    "netlify.app", "web.app", "firebaseapp.com", "herokuapp.com", "streamlit.app", "hf.space", "notion.site", "framer.website", "wixsite.com",
    "bubbleapps.io", "repl.co", "replit.app", "glitch.me", "on.fleek.co", "surge.sh",
)
# Hosts of many unrelated products.
SHARED_HOSTS = (
    "github.com", "gitlab.com", "huggingface.co", "notion.so", "notion.site", "vercel.app", "netlify.app", "streamlit.app", "gumroad.com", "carrd.co",
    "framer.app", "framer.website", "webflow.io", "wixsite.com", "replit.app", "glitch.me", "herokuapp.com", "pages.dev", "web.app", "firebaseapp.com",
    "bubbleapps.io", "softr.app", "canva.site", "apps.apple.com", "play.google.com", "chromewebstore.google.com", "chrome.google.com",
    "microsoftedge.microsoft.com", "producthunt.com", "theresanaiforthat.com", "creati.ai", "toolpilot.ai", "futurepedia.io", "dang.ai", "opentools.ai",
    "topai.tools", "poweredbyai.app", "aivalley.ai", "easywithai.com", "foundr.ai", "rankmyai.com", "aipure.ai", "aitoolnet.com", "aichief.com",
    "aixploria.com", "rundown.ai",
)
# Path segments that name a page of a product, not a product.
GENERIC = (
    "pricing", "price", "prices", "plans", "plan", "billing", "home", "homepage", "index", "main", "welcome", "start", "landing", "about", "about-us",
    "aboutus", "contact", "contact-us", "login", "log-in", "signin", "sign-in", "signup", "sign-up", "register", "get-started", "getting-started",
    "getstarted", "try", "try-free", "free", "download", "downloads", "install", "en-us", "en-gb", "default",
)

# Endings and host names of files to load.
ASSET_ENDINGS = (".png", ".jpg", ".jpeg", ".webp", ".gif", ".svg", ".ico", ".avif", ".css", ".js", ".mp4", ".webm", ".pdf", ".zip", ".woff", ".woff2")
ASSET_HOSTS = ("cdn-image.", "cdn.", "images.", "img.", "static.", "assets.")

_PARTS = re.compile(r"([a-z][a-z0-9+.-]*)://(?:[^/?#@]*@)?([^/?#:@]*)(?::(\d*))?(?![^/?#])([^?#]*)(?:\?([^#]*))?(?:#(.*))?", re.S)
_SCHEME = re.compile(r"[a-zA-Z][a-zA-Z0-9+.-]*://")
_MANY = frozenset(SUFFIXES)
_SHARED = frozenset(SHARED_HOSTS)
_PLAIN = frozenset(GENERIC)
_NO_PAGE = re.compile(r"(?i)#|javascript:|mailto:|tel:|data:")


def _tracks(name: str) -> bool:
    return name in TRACKING or name.startswith(TRACKING_PREFIXES)


def _ascii_host(host: str) -> str:
    if host.isascii():
        return host
    try:
        return host.encode("idna").decode("ascii")
    except UnicodeError:
        return host


def registrable(host: str) -> str:
    """The domain a host was registered under."""
    labels = host.split(".")
    for n in (3, 2):  # the longest listed suffix first
        if len(labels) > n and ".".join(labels[-n:]) in _MANY:
            return ".".join(labels[-n - 1 :])
    return ".".join(labels[-2:])


def product_path(segments: list[str]) -> list[str]:
    """Path segments that tell a product: without a leading locale and trailing pages of any product."""
    s = [x.lower() for x in segments]
    if s and re.fullmatch(r"[a-z]{2}(-[a-z]{2})?", s[0]):
        s = s[1:]
    while s and s[-1] in _PLAIN:
        s.pop()
    return s


def parsed(text: str, keep_query: bool = True, keep_path: bool = True, force_https: bool = True) -> dict | None:
    """url, host, segments and the product of an address, or None if it is no http address."""
    u = "".join(text.split()).strip("<>\"'")
    if u.startswith("//"):
        u = f"https:{u}"
    if not _SCHEME.match(u):
        u = f"https://{u.lstrip('/')}"
    scheme, _, rest = u.partition(":")
    m = _PARTS.fullmatch(f"{scheme.lower()}:{rest}")
    if m is None or m[1] not in ("http", "https"):
        return None
    host, port, path, query, route = m[2].lower().rstrip("."), m[3] or "", m[4], m[5] or "", m[6] or ""
    if "." not in host:
        return None
    host = _ascii_host(host).removeprefix("www.")
    segments = [x for x in unquote(path).split("/") if x] if keep_path else []
    if segments and segments[-1].lower() in INDEX_FILES:
        segments.pop()
    kept = sorted((k, v) for k, v in parse_qsl(query, keep_blank_values=True) if not _tracks(k.lower())) if keep_query and query else []
    url = f"{'https' if force_https else m[1]}://{host}{'' if port.lstrip('0') in ('', '80', '443') else ':' + port}/"
    url += quote("/".join(segments), safe="/-_.~!$&'()*+,;=:@%")
    if kept:
        url += "?" + urlencode(kept)
    if route[:1] in ("/", "!"):
        url += "#" + route
    if segments and url.endswith("/"):
        url = url[:-1]
    domain, path = registrable(host), product_path(segments)
    key = "/".join((host, *path))
    product = {"host": host, "domain": domain, "segments": path, "key": key, "root": not path, "shared": domain in _SHARED}
    return {"url": url, "host": host, "segments": segments, "product": product}


def absolute(href: str, base: str | None) -> str | None:
    """The normal form of a link on a page, or None where it leads to no page."""
    h = href.strip()
    if not h or _NO_PAGE.match(h):
        return None
    try:
        whole = urljoin(base or "", h)
    except ValueError:
        return None
    if not whole.startswith(("http://", "https://")):
        return None
    p = parsed(whole)
    return p and p["url"]


def is_asset(url: str) -> bool:
    """Whether an address names a file to load."""
    m = re.match(r"(?:[a-z][a-z0-9+.-]*:)?//([^/?#]*)", url.lower())
    return re.sub(r"[?#].*", "", url.lower(), flags=re.S).endswith(ASSET_ENDINGS) or bool(m and m[1].startswith(ASSET_HOSTS)) or not url


def outside(hrefs: list, base: str | None) -> list[str]:
    """Links that lead to pages of other sites, in order, each once."""
    own = parsed(base) if base else None
    found: dict[str, None] = {}
    for h in hrefs:
        u = absolute(h, base) if h else None
        if u and not is_asset(u) and (own is None or parsed(u)["product"]["domain"] != own["product"]["domain"]):
            found[u] = None
    return list(found)
