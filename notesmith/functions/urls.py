"""URL expressions (O-F1 normalise, O-F2 hash, O-F3 doc id)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from notesmith.functions.common import col

# Query parameters dropped by normalisation (prefix match, case-sensitive).
TRACKING_PREFIXES = ("utm_", "ref=", "source=", "fbclid=", "gclid=")


def _rstrip_slash(c: Column) -> Column:
    return F.regexp_replace(c, "/+$", "")


def normalize_url(url) -> Column:
    """O-F1. Order matters: strip '/', drop tracking params, cut '#', strip '/'."""
    u = _rstrip_slash(col(url))
    qpos = F.instr(u, "?")
    base = F.substring_index(u, "?", 1)
    params = F.split(u.substr(qpos + 1, F.lit(1 << 30)), "&")

    def keep(p: Column) -> Column:
        dropped = F.lit(False)
        for prefix in TRACKING_PREFIXES:
            dropped = dropped | p.startswith(prefix)
        return ~dropped

    kept = F.filter(params, keep)
    with_query = F.when(F.size(kept) > 0, F.concat(base, F.lit("?"), F.array_join(kept, "&"))).otherwise(base)
    u2 = F.when(qpos > 0, with_query).otherwise(u)
    u3 = F.substring_index(u2, "#", 1)
    return _rstrip_slash(u3)


def url_hash(url) -> Column:
    """O-F2: md5 hex of the normalised URL."""
    return F.md5(normalize_url(url))


def doc_id_from_url(url) -> Column:
    """O-F3: document id for workspace-doc URLs, else null.

    Host must contain 'feishu.cn'; path must start /wiki|docx|docs/<id>.
    """
    u = col(url)
    host = F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    path = F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    doc = F.regexp_extract(path, r"^/(?:wiki|docx|docs)/([^/?]+)", 1)
    return F.when(host.contains("feishu.cn") & (F.length(doc) > 0), doc)
