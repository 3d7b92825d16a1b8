"""HTML expressions (O-F4 title, O-F5 title chain, O-F6 text, O-F7 Markdown, O-F8 entities).

All are native regexp chains, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from notesmith.functions.common import WS, col, py_strip


def html_title(html) -> Column:
    """O-F4: <title> cut at the first | - – — separator, else first <h1> without tags, else ''."""
    h = col(html)
    t = py_strip(F.regexp_extract(h, r"(?is)<title[^>]*>(.*?)</title>", 1))
    t = F.regexp_replace(t, f"{WS}*[|\\-–—].*$", "")
    h1 = py_strip(F.regexp_replace(F.regexp_extract(h, r"(?is)<h1[^>]*>(.*?)</h1>", 1), r"<[^>]+>", ""))
    return F.when(F.length(t) > 0, t).when(F.length(h1) > 0, h1).otherwise(F.lit(""))


def url_slug_title(url) -> Column:
    """Last path segment, 50 chars, '-' and '_' to spaces."""
    seg = F.element_at(F.split(F.regexp_replace(col(url), "/+$", ""), "/"), -1)
    return F.translate(F.substring(seg, 1, 50), "-_", "  ")


def title_chain(meta_title, html, url) -> Column:
    """O-F5: metadata title -> O-F4 -> URL slug -> 'Untitled'."""
    m = col(meta_title)
    t = html_title(html)
    s = url_slug_title(url)
    return (
        F.when(F.length(m) > 0, m)
        .when(F.length(t) > 0, t)
        .when(F.length(s) > 0, s)
        .otherwise(F.lit("Untitled"))
    )


def html_to_text(html) -> Column:
    """O-F6: drop script/style blocks, tags to a space, collapse whitespace, strip."""
    t = F.regexp_replace(col(html), r"(?is)<script[^>]*>.*?</script>", "")
    t = F.regexp_replace(t, r"(?is)<style[^>]*>.*?</style>", "")
    t = F.regexp_replace(t, r"<[^>]+>", " ")
    t = F.regexp_replace(t, f"{WS}+", " ")
    return py_strip(t)


# Named entities decoded by the Markdown conversion, in order.
NAMED_ENTITIES = (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'))


def decode_numeric_entities(c) -> Column:
    """O-F8: '&#N;' -> the character with code point N (not chr(), which wraps at 256)."""
    c = col(c)
    ents = F.array_distinct(F.regexp_extract_all(c, F.lit(r"&#(\d+);"), 1))

    def step(acc: Column, n: Column) -> Column:
        cp = n.try_cast("int")
        ch = F.decode(F.unhex(F.lpad(F.hex(cp), 8, "0")), "UTF-32")
        return F.when(cp.isNull() | (cp > 0x10FFFF), acc).otherwise(F.replace(acc, F.concat(F.lit("&#"), n, F.lit(";")), ch))

    return F.when(F.instr(c, "&#") > 0, F.aggregate(ents, c, step)).otherwise(c)


def html_to_markdown(html) -> Column:
    """O-F7: headings, paragraphs, divs, links, bold, italic, list items, breaks, entities.

    Tag names are word-bounded so <b> does not eat <body>/<br> and <p> does not eat <pre>.
    """
    t = F.regexp_replace(col(html), r"(?is)<style\b[^>]*>.*?</style>", "")
    t = F.regexp_replace(t, r"(?is)<script\b[^>]*>.*?</script>", "")
    for i in range(1, 7):
        t = F.regexp_replace(t, f"(?is)<h{i}\\b[^>]*>{WS}*(.*?){WS}*</h{i}>", "#" * i + " $1")
    t = F.regexp_replace(t, r"(?is)<p\b[^>]*>(.*?)</p>", "$1\n\n")
    t = F.regexp_replace(t, r"(?is)<div\b[^>]*>(.*?)</div>", "$1\n")
    t = F.regexp_replace(t, r"""(?is)<a\b[^>]*href=["']([^"']*)["'][^>]*>(.*?)</a>""", "[$2]($1)")
    t = F.regexp_replace(t, r"(?is)<b\b[^>]*>(.*?)</b>", "**$1**")
    t = F.regexp_replace(t, r"(?is)<strong\b[^>]*>(.*?)</strong>", "**$1**")
    t = F.regexp_replace(t, r"(?is)<i\b[^>]*>(.*?)</i>", "*$1*")
    t = F.regexp_replace(t, r"(?is)<em\b[^>]*>(.*?)</em>", "*$1*")
    t = F.regexp_replace(t, r"(?is)<li\b[^>]*>(.*?)</li>", "- $1\n")
    t = F.regexp_replace(t, r"(?i)<br\s*/?>", "\n")
    t = F.regexp_replace(t, r"<[^>]+>", "")
    for ent, ch in NAMED_ENTITIES:
        t = F.replace(t, F.lit(ent), F.lit(ch))
    t = decode_numeric_entities(t)
    t = F.regexp_replace(t, r"\n{3,}", "\n\n")
    t = F.regexp_replace(t, r" {2,}", " ")
    return py_strip(t)
