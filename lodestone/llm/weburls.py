"""One spelling for every web address, as a Spark column.

``page`` keeps what selects a page (host, path, meaningful query, in-app route) and drops what
does not: scheme, ``www``, default ports, index files, doubled or trailing slashes, tracking
parameters and anchors.
"""

import re
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column

from lodestone.functions.batches import per_value

# Parameters that tell where a visitor came from.
TRACKING = re.compile(r"(utm_[a-z_]*|gclid|fbclid|msclkid|dclid|yclid|igshid|mc_cid|mc_eid|ref|referrer|source|src|via|campaign|affiliate|aff)")
_SHAPE = re.compile(r"(?:https?:)?(?://)?(?:[^/?#@\s]*@)?([^/?#:\s@]+\.[a-z][a-z0-9-]*)\.?(?::(\d*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?", re.S)
_INDEX = re.compile(r"/(index|home|default)\.(html?|php\d?|aspx?|jsp)$")
_ENDS = " \t\n\r\f\v\xa0​﻿"


def spelled(url: str) -> dict | None:
    """host, path, page and front of one address, or None if it is none."""
    m = _SHAPE.fullmatch(url.strip(_ENDS).lower())
    if m is None:
        return None
    host = m[1].removeprefix("www.") + ("" if m[2] in (None, "", "80", "443") else f":{m[2]}")
    path = _INDEX.sub("/", re.sub("/{2,}", "/", unquote(m[3]))).rstrip("/")
    query = "&".join(sorted(unquote(x) for x in (m[4] or "").split("&") if x and not TRACKING.fullmatch(x.split("=", 1)[0])))
    route = m[5] or ""
    route = re.sub(r"[?].*$|/+$", "", unquote(route), flags=re.S) if route[:1] in ("/", "!") else ""
    page = host + path + (f"?{query}" if query else "") + (f"#{route}" if route else "")
    return {"host": host, "path": path, "page": page, "front": not (path or query or route)}


_KIND = pa.struct([("host", pa.string()), ("path", pa.string()), ("page", pa.string()), ("front", pa.bool_())])


def parts(url: Column) -> Column:
    """struct(host, path, page, front) of an address, all lower case, or null if it is none.

    ``page`` is the address in its one spelling; ``front`` tells whether it is the front page of
    its host. Each distinct value of an Arrow batch is parsed once.
    """
    return per_value("web address", spelled, "struct<host:string,path:string,page:string,front:boolean>", _KIND)(url)
