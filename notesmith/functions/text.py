"""Text expressions: hashes, slugs, summaries, mail fields, truncation (O-P1, O-F9..F21)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from notesmith.functions.common import WORD_CHARS, WS, WS_CHARS, col, py_strip
from notesmith.functions.html import html_to_markdown, html_to_text


def content_hash(url, title, content_raw) -> Column:
    """O-P1: first 16 hex chars of sha256(url + title + first 500 chars of the raw text)."""
    return F.substring(
        F.sha2(F.concat(F.coalesce(col(url), F.lit("")), F.coalesce(col(title), F.lit("")),
                        F.substring(F.coalesce(col(content_raw), F.lit("")), 1, 500)), 256), 1, 16)


def word_count(c) -> Column:
    """O-F17: number of whitespace-separated tokens (str.split())."""
    return F.size(F.filter(F.split(F.coalesce(col(c), F.lit("")), f"{WS}+"), lambda w: w != "")).cast("bigint")


def truncate_with_marker(c, n: int, marker: str = "\n[...truncated]") -> Column:
    """O-F18: cut at n chars and append the marker; unchanged when length <= n."""
    c = col(c)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit(marker))).otherwise(c)


def note_slug(c) -> Column:
    """O-F11: lower, drop non-word chars, whitespace/_ runs to '-', trim '-', 80 chars, 'untitled'."""
    s = F.regexp_replace(F.lower(col(c)), f"[^{WORD_CHARS}{WS_CHARS}-]", "")
    s = F.regexp_replace(s, f"[{WS_CHARS}_]+", "-")
    s = F.substring(F.regexp_replace(s, "^-+|-+$", ""), 1, 80)
    return F.when(F.length(s) > 0, s).otherwise(F.lit("untitled"))


def topic_slug(c) -> Column:
    """O-F12: other chars to '-', collapse, trim, 60 chars; keeps case and CJK."""
    s = F.regexp_replace(col(c), f"[^{WORD_CHARS}-]", "-")
    s = F.regexp_replace(F.regexp_replace(s, "-+", "-"), "^-+|-+$", "")
    return F.when(F.length(s) > 0, F.substring(s, 1, 60)).otherwise(F.lit("untitled"))


def heading_title(c) -> Column:
    """O-F13: text of a '# ' heading on the first line, else ''."""
    return py_strip(F.regexp_extract(col(c), f"^#{WS}+([^\\n]+)", 1))


def note_summary(content) -> Column:
    """O-F14: body after frontmatter without Markdown marks, blank lines collapsed, 500 chars.

    Frontmatter ends at the first line that starts with '---' after the opening one.
    """
    c = col(content)
    end = F.locate("\n---", c, 4)
    body = F.when(c.startswith("---") & (end > 0), c.substr(end + 4, F.lit(1 << 30))).otherwise(c)
    t = F.regexp_replace(body, f"#+{WS}+", "")
    t = F.regexp_replace(t, r"\[([^\]]+)\]\([^)]+\)", "$1")
    t = F.regexp_replace(t, r"[*#|>]", "")
    t = F.regexp_replace(t, r"\n{2,}", "\n")
    return F.substring(py_strip(t), 1, 500)


def note_filename(score, title) -> Column:
    """O-F15: '[S<score>] ' prefix when score > 0, note slug, '.md'."""
    prefix = F.when(col(score) > 0, F.concat(F.lit("[S"), col(score).cast("string"), F.lit("] "))).otherwise(F.lit(""))
    return F.concat(prefix, note_slug(title), F.lit(".md"))


def path_stem(path) -> Column:
    return F.regexp_extract(col(path), r"([^/]+?)(\.[^./]*)?$", 1)


def wikilink(path, title) -> Column:
    """O-F16: [[stem|title]] when a path is known, else [[title]]."""
    p = col(path)
    t = F.coalesce(col(title), F.lit("Untitled"))
    return F.when(F.length(p) > 0, F.concat(F.lit("[["), path_stem(p), F.lit("|"), t, F.lit("]]"))).otherwise(
        F.concat(F.lit("[["), t, F.lit("]]")))


# Footer markers removed from newsletter bodies.
FOOTER_UNSUBSCRIBE = r"(?:unsubscribe|opt.?out|click here to unsubscribe)"
FOOTER_RECEIVED = r"(?:you received this email|you're receiving this)"
FOOTER_STREET = r"(?:St|Street|Ave|Avenue|Blvd|Road|Rd)"


def footer_patterns(greedy: bool = False) -> list[str]:
    """The three footer patterns (Java/RE2 syntax).

    Default cuts from the line holding the marker; greedy=True cuts from the
    first newline of the text, as the original single-line-agnostic patterns do.
    """
    lead = ".*" if greedy else "[^\\n]*"
    return [
        f"(?is)\\n{lead}{FOOTER_UNSUBSCRIBE}.*\\n.*",
        f"(?is)\\n{lead}{FOOTER_RECEIVED}.*",
        f"(?is)\\n\\p{{Nd}}+{WS}+[{WORD_CHARS}]+{WS}+{FOOTER_STREET}.*?(?:\\n\\n|\\z)",
    ]


def remove_footer(c, greedy: bool = False) -> Column:
    """O-F9: drop unsubscribe / 'you received this' / street-address footers, then strip."""
    t = col(c)
    for p in footer_patterns(greedy):
        t = F.regexp_replace(t, p, "")
    return py_strip(t)


def sender_name(from_header) -> Column:
    """O-F19 display name: before <..>, or a comment behind a bare address ('' for an address alone)."""
    f = col(from_header)
    return F.when(F.contains(f, F.lit("<")), F.regexp_extract(f, f'^{WS}*"?(.*?)"?{WS}*<([^>]+)>', 1)).otherwise(
        F.regexp_extract(f, f"\\(([^()]*)\\){WS}*$", 1))


def sender_address(from_header) -> Column:
    """O-F19 lower-case address: inside <..> when present, else the bare header."""
    f = col(from_header)
    inner = F.regexp_extract(f, r"<([^>]+)>", 1)
    return F.lower(F.when(F.length(inner) > 0, inner).otherwise(
        py_strip(F.regexp_replace(f, f"\\([^()]*\\){WS}*$", ""))))


def message_id_hash(message_id, subject, date_header, from_header) -> Column:
    """O-F20: sha256(Message-ID)[:16], else of Subject + Date + From."""
    mid = col(message_id)
    fallback = F.concat(F.coalesce(col(subject), F.lit("")), F.coalesce(col(date_header), F.lit("")),
                        F.coalesce(col(from_header), F.lit("")))
    src = F.when(F.length(mid) > 0, mid).otherwise(fallback)
    return F.substring(F.sha2(src, 256), 1, 16)


def body_choice(parts) -> Column:
    """O-F21 with O-P9: non-attachment parts; plain parts (non-blank, newline-joined) win
    whenever any plain part exists, else HTML parts converted to Markdown."""
    p = F.filter(col(parts), lambda x: ~F.coalesce(x["disposition"], F.lit("")).contains("attachment"))
    plain = F.filter(p, lambda x: x["content_type"] == "text/plain")
    html = F.filter(p, lambda x: x["content_type"] == "text/html")
    plain_txt = F.array_join(F.filter(F.transform(plain, lambda x: x["text"]), lambda t: F.length(py_strip(t)) > 0), "\n")
    html_txt = F.array_join(
        F.filter(F.transform(html, lambda x: html_to_markdown(x["text"])), lambda t: F.length(py_strip(t)) > 0), "\n")
    return F.when(F.size(plain) > 0, plain_txt).when(F.size(html) > 0, html_txt).otherwise(F.lit(""))


def feed_content(content_html, description, summary) -> Column:
    """Feed-provided text: content > 100 chars, description > 200 chars (both as text), else summary."""
    c, d, s = col(content_html), col(description), col(summary)
    return (F.when(F.length(c) > 100, html_to_text(c))
            .when(F.length(d) > 200, html_to_text(d))
            .otherwise(F.coalesce(s, F.lit(""))))


def feed_cascade(page_text, content_html, description, summary) -> Column:
    """O-F10: page text unless shorter than 100 chars; then feed text if it is longer."""
    pt = F.coalesce(col(page_text), F.lit(""))
    fc = feed_content(content_html, description, summary)
    return F.when((F.length(pt) < 100) & (F.length(fc) > F.length(pt)), fc).otherwise(pt)
