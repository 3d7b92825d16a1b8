"""DuckDB SQL text for the oracle side of the driver check.

Independent re-statements of the column expressions in ``notesmith.functions``
in DuckDB's dialect (RE2 regex, ``\\1`` back-references, ``'g'`` for global
replace, ``lambda x:`` list functions). Only used to build ``oracle_sql()``.
"""

from __future__ import annotations

import re

from notesmith.functions.common import WORD_CHARS, WS, WS_CHARS
from notesmith.functions.html import NAMED_ENTITIES
from notesmith.functions.text import footer_patterns
from notesmith.functions.urls import TRACKING_PREFIXES
from notesmith.sources.derived import derived_sql  # noqa: F401  (re-exported)


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rx_replace(x: str, pattern: str, repl: str, global_: bool = True) -> str:
    repl = re.sub(r"\$(\d)", r"\\\1", repl)
    return f"regexp_replace({x}, {lit(pattern)}, {lit(repl)}{', ' + lit('g') if global_ else ''})"


def rx_extract(x: str, pattern: str, group: int = 0) -> str:
    return f"regexp_extract({x}, {lit(pattern)}, {group})"


def strip(x: str) -> str:
    return rx_replace(x, f"^{WS}+|{WS}+$", "")


def with_ctes(*names: str, extra: list[tuple[str, str]] | None = None) -> str:
    parts = [f"{n} AS (\n{derived_sql(n)}\n)" for n in names]
    for n, q in extra or []:
        parts.append(f"{n} AS (\n{q}\n)")
    return "WITH " + ",\n".join(parts) + "\n" if parts else ""


# ---- URLs -----------------------------------------------------------------

def normalize_url(x: str) -> str:
    u = rx_replace(x, "/+$", "")
    base = f"split_part({u}, '?', 1)"
    params = f"string_split(substr({u}, strpos({u}, '?') + 1), '&')"
    cond = " OR ".join(f"starts_with(p, {lit(pfx)})" for pfx in TRACKING_PREFIXES)
    kept = f"list_filter({params}, lambda p: NOT ({cond}))"
    with_q = f"CASE WHEN len({kept}) > 0 THEN {base} || '?' || array_to_string({kept}, '&') ELSE {base} END"
    u2 = f"CASE WHEN strpos({u}, '?') > 0 THEN {with_q} ELSE {u} END"
    u3 = f"split_part({u2}, '#', 1)"
    return rx_replace(u3, "/+$", "")


def url_hash(x: str) -> str:
    return f"md5({normalize_url(x)})"


def doc_id_from_url(x: str) -> str:
    host = rx_extract(x, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    path = rx_extract(x, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    doc = rx_extract(path, r"^/(?:wiki|docx|docs)/([^/?]+)", 1)
    return f"CASE WHEN contains({host}, 'feishu.cn') AND length({doc}) > 0 THEN {doc} END"


# ---- HTML -----------------------------------------------------------------

def html_title(x: str) -> str:
    t = strip(rx_extract(x, r"(?is)<title[^>]*>(.*?)</title>", 1))
    t = rx_replace(t, f"{WS}*[|\\-–—].*$", "")
    h1 = strip(rx_replace(rx_extract(x, r"(?is)<h1[^>]*>(.*?)</h1>", 1), r"<[^>]+>", ""))
    return f"CASE WHEN length({t}) > 0 THEN {t} WHEN length({h1}) > 0 THEN {h1} ELSE '' END"


def url_slug_title(x: str) -> str:
    seg = f"list_extract(string_split({rx_replace(x, '/+$', '')}, '/'), -1)"
    return f"translate(substr({seg}, 1, 50), '-_', '  ')"


def title_chain(meta: str, html: str, url: str) -> str:
    t, s = html_title(html), url_slug_title(url)
    return (f"CASE WHEN length({meta}) > 0 THEN {meta} WHEN length({t}) > 0 THEN {t} "
            f"WHEN length({s}) > 0 THEN {s} ELSE 'Untitled' END")


def html_to_text(x: str) -> str:
    t = rx_replace(x, r"(?is)<script[^>]*>.*?</script>", "")
    t = rx_replace(t, r"(?is)<style[^>]*>.*?</style>", "")
    t = rx_replace(t, r"<[^>]+>", " ")
    t = rx_replace(t, f"{WS}+", " ")
    return strip(t)


def decode_numeric_entities(x: str) -> str:
    ents = f"list_distinct(regexp_extract_all({x}, '&#(\\d+);', 1))"
    body = (f"list_reduce(list_prepend({x}, {ents}), lambda acc, n: CASE WHEN TRY_CAST(n AS INTEGER) IS NULL "
            f"OR TRY_CAST(n AS INTEGER) > 1114111 THEN acc ELSE replace(acc, '&#' || n || ';', chr(CAST(n AS INTEGER))) END)")
    return f"CASE WHEN strpos({x}, '&#') > 0 THEN {body} ELSE {x} END"


def html_to_markdown(x: str) -> str:
    t = rx_replace(x, r"(?is)<style\b[^>]*>.*?</style>", "")
    t = rx_replace(t, r"(?is)<script\b[^>]*>.*?</script>", "")
    for i in range(1, 7):
        t = rx_replace(t, f"(?is)<h{i}\\b[^>]*>{WS}*(.*?){WS}*</h{i}>", "#" * i + " $1")
    t = rx_replace(t, r"(?is)<p\b[^>]*>(.*?)</p>", "$1\n\n")
    t = rx_replace(t, r"(?is)<div\b[^>]*>(.*?)</div>", "$1\n")
    t = rx_replace(t, r"""(?is)<a\b[^>]*href=["']([^"']*)["'][^>]*>(.*?)</a>""", "[$2]($1)")
    t = rx_replace(t, r"(?is)<b\b[^>]*>(.*?)</b>", "**$1**")
    t = rx_replace(t, r"(?is)<strong\b[^>]*>(.*?)</strong>", "**$1**")
    t = rx_replace(t, r"(?is)<i\b[^>]*>(.*?)</i>", "*$1*")
    t = rx_replace(t, r"(?is)<em\b[^>]*>(.*?)</em>", "*$1*")
    t = rx_replace(t, r"(?is)<li\b[^>]*>(.*?)</li>", "- $1\n")
    t = rx_replace(t, r"(?i)<br\s*/?>", "\n")
    t = rx_replace(t, r"<[^>]+>", "")
    for ent, ch in NAMED_ENTITIES:
        t = f"replace({t}, {lit(ent)}, {lit(ch)})"
    t = decode_numeric_entities(t)
    t = rx_replace(t, r"\n{3,}", "\n\n")
    t = rx_replace(t, r" {2,}", " ")
    return strip(t)


# ---- text -----------------------------------------------------------------

def content_hash(url: str, title: str, raw: str) -> str:
    return (f"substr(sha256(coalesce({url}, '') || coalesce({title}, '') || "
            f"substr(coalesce({raw}, ''), 1, 500)), 1, 16)")


def word_count(x: str) -> str:
    return (f"CAST(len(list_filter(regexp_split_to_array(coalesce({x}, ''), {lit(WS + '+')}), "
            f"lambda w: w <> '')) AS BIGINT)")


def truncate_with_marker(x: str, n: int, marker: str = "\n[...truncated]") -> str:
    return f"CASE WHEN length({x}) > {n} THEN substr({x}, 1, {n}) || {lit(marker)} ELSE {x} END"


def note_slug(x: str) -> str:
    s = rx_replace(f"lower({x})", f"[^{WORD_CHARS}{WS_CHARS}-]", "")
    s = rx_replace(s, f"[{WS_CHARS}_]+", "-")
    s = f"substr({rx_replace(s, '^-+|-+$', '')}, 1, 80)"
    return f"CASE WHEN length({s}) > 0 THEN {s} ELSE 'untitled' END"


def topic_slug(x: str) -> str:
    s = rx_replace(x, f"[^{WORD_CHARS}-]", "-")
    s = rx_replace(rx_replace(s, "-+", "-"), "^-+|-+$", "")
    return f"CASE WHEN length({s}) > 0 THEN substr({s}, 1, 60) ELSE 'untitled' END"


def heading_title(x: str) -> str:
    return strip(rx_extract(x, f"^#{WS}+([^\\n]+)", 1))


def note_summary(x: str) -> str:
    end = f"strpos(substr({x}, 4), chr(10) || '---')"
    body = f"CASE WHEN starts_with({x}, '---') AND {end} > 0 THEN substr({x}, {end} + 3 + 4) ELSE {x} END"
    t = rx_replace(body, f"#+{WS}+", "")
    t = rx_replace(t, r"\[([^\]]+)\]\([^)]+\)", "$1")
    t = rx_replace(t, r"[*#|>]", "")
    t = rx_replace(t, r"\n{2,}", "\n")
    return f"substr({strip(t)}, 1, 500)"


def note_filename(score: str, title: str) -> str:
    return (f"CASE WHEN {score} > 0 THEN '[S' || CAST({score} AS VARCHAR) || '] ' ELSE '' END "
            f"|| {note_slug(title)} || '.md'")


def path_stem(p: str) -> str:
    return rx_extract(p, r"([^/]+?)(\.[^./]*)?$", 1)


def wikilink(path: str, title: str) -> str:
    t = f"coalesce({title}, 'Untitled')"
    return (f"CASE WHEN length({path}) > 0 THEN '[[' || {path_stem(path)} || '|' || {t} || ']]' "
            f"ELSE '[[' || {t} || ']]' END")


def remove_footer(x: str, greedy: bool = False) -> str:
    t = x
    for p in footer_patterns(greedy):
        t = rx_replace(t, p, "")
    return strip(t)


def sender_name(x: str) -> str:
    return rx_extract(x, f'^{WS}*"?(.*?)"?{WS}*<([^>]+)>', 1)


def sender_address(x: str) -> str:
    inner = rx_extract(x, r"<([^>]+)>", 1)
    return f"lower(CASE WHEN length({inner}) > 0 THEN {inner} ELSE {strip(x)} END)"


def message_id_hash(mid: str, subject: str, date: str, frm: str) -> str:
    fb = f"coalesce({subject}, '') || coalesce({date}, '') || coalesce({frm}, '')"
    return f"substr(sha256(CASE WHEN length({mid}) > 0 THEN {mid} ELSE {fb} END), 1, 16)"


def feed_content(c: str, d: str, s: str) -> str:
    return (f"CASE WHEN length({c}) > 100 THEN {html_to_text(c)} WHEN length({d}) > 200 THEN {html_to_text(d)} "
            f"ELSE coalesce({s}, '') END")


def feed_cascade(pt: str, c: str, d: str, s: str) -> str:
    p = f"coalesce({pt}, '')"
    fc = feed_content(c, d, s)
    return f"CASE WHEN length({p}) < 100 AND length({fc}) > length({p}) THEN {fc} ELSE {p} END"


# ---- dates ----------------------------------------------------------------

def rfc_epoch(x: str) -> str:
    from notesmith.functions.dates import RFC_ZONES
    s = rx_replace(strip(x), f"^[A-Za-z]{{3}},{WS}*", "")
    for name, off in RFC_ZONES:
        s = rx_replace(s, f" {name}$", f" {off}")
    return f"CAST(epoch(try_strptime({s}, '%d %b %Y %H:%M:%S %z')) AS BIGINT)"


def iso_epoch(x: str) -> str:
    return f"CAST(epoch(TRY_CAST({x} AS TIMESTAMPTZ)) AS BIGINT)"


def epoch_date_label(e: str) -> str:
    return f"strftime(DATE '1970-01-01' + CAST(floor({e} / 86400) AS INTEGER), '%Y-%m-%d')"


# ---- source builders (same column set as notesmith.sources.articles) -------

STRIDE = 1 << 40
ART_COLS = "ord, url, title, source, content_raw, author, published_epoch, source_name, tags, content_hash"


def _art(select_sql: str, source: str, rank: int) -> str:
    """Wrap a select that yields ord,url,title,content_raw,author,published_epoch,source_name,tags."""
    return (f"SELECT {rank} * {STRIDE} + ord AS ord, url, title, '{source}' AS source, content_raw, author, "
            f"published_epoch, source_name, tags, {content_hash('url', 'title', 'content_raw')} AS content_hash "
            f"FROM ({select_sql})")


def feed_cap_sql() -> str:
    return ("SELECT * FROM (SELECT e.*, f.max_articles, row_number() OVER (PARTITION BY e.feed ORDER BY e.ord) AS rn "
            "FROM feed_entries e JOIN feeds f ON f.name = e.feed WHERE coalesce(f.enabled, true)) "
            "WHERE rn <= max_articles")


def feed_articles() -> str:
    sel = (f"SELECT ord, link AS url, coalesce(title, 'Untitled') AS title, "
           f"{feed_cascade('page_text', 'content', 'description', 'summary')} AS content_raw, "
           f"coalesce(author, '') AS author, {rfc_epoch('published')} AS published_epoch, feed AS source_name, "
           f"CAST([] AS VARCHAR[]) AS tags FROM ({feed_cap_sql()}) WHERE length(link) > 0")
    return _art(sel, "rss", 0)


def page_articles() -> str:
    txt = html_to_text("html")
    sel = (f"SELECT ord, url, {title_chain(lit(''), 'html', 'url')} AS title, content_raw, '' AS author, "
           f"CAST(NULL AS BIGINT) AS published_epoch, 'web' AS source_name, CAST([] AS VARCHAR[]) AS tags "
           f"FROM (SELECT page_id AS ord, url, html, {txt} AS content_raw FROM pages) WHERE length(content_raw) > 0")
    return _art(sel, "web_url", 1)


def doc_articles() -> str:
    head = heading_title("content")
    sel = (f"SELECT ord, url, CASE WHEN length(api_title) > 0 THEN api_title WHEN length({head}) > 0 THEN {head} "
           f"ELSE doc_id END AS title, content AS content_raw, '' AS author, CAST(NULL AS BIGINT) AS published_epoch, "
           f"'feishu' AS source_name, CAST([] AS VARCHAR[]) AS tags FROM (SELECT *, {doc_id_from_url('url')} AS doc_id "
           f"FROM docs_export) WHERE doc_id IS NOT NULL AND length(content) > 0")
    return _art(sel, "feishu", 2)


def repo_tags(topics: str, language: str) -> str:
    lang = f"lower(coalesce({language}, ''))"
    t1 = (f"CASE WHEN length({lang}) > 0 AND len(list_filter({topics}, lambda x: lower(x) = {lang})) = 0 "
          f"THEN list_concat({topics}, [{lang}]) ELSE {topics} END")
    t2 = f"CASE WHEN NOT list_contains({t1}, 'github') THEN list_concat({t1}, ['github']) ELSE {t1} END"
    return f"list_slice({t2}, 1, 8)"


def repo_articles(as_of: str, max_repos: int | None = None) -> str:
    src = "repos" if not max_repos else f"(SELECT * FROM repos ORDER BY ord LIMIT {max_repos})"
    short = "list_extract(string_split(repo, '/'), -1)"
    topics = "CASE WHEN length(topics_csv) > 0 THEN string_split(topics_csv, ',') ELSE CAST([] AS VARCHAR[]) END"
    sel = (f"SELECT ord, 'https://github.com/' || repo AS url, "
           f"CASE WHEN length(d) > 0 THEN {short} || ': ' || d ELSE {short} END AS title, "
           f"CASE WHEN length(r) > 0 THEN r WHEN length(d) > 0 THEN d ELSE '*No README available for ' || repo || '.*' END "
           f"AS content_raw, list_extract(string_split(repo, '/'), 1) AS author, "
           f"CAST(epoch(TIMESTAMP '{as_of} 00:00:00') AS BIGINT) AS published_epoch, repo AS source_name, "
           f"{repo_tags(topics, 'language')} AS tags "
           f"FROM (SELECT *, coalesce(description, '') AS d, coalesce(readme, '') AS r FROM {src}) "
           f"WHERE NOT coalesce(fork, false) AND (length(r) > 0 OR length(d) > 0)")
    return _art(sel, "github", 3)


def sender_allowed(addr: str, whitelist, exact: bool = False) -> str:
    if not whitelist:
        return "TRUE"
    conds = []
    for e in whitelist:
        e = e.lower()
        if "@" in e:
            conds.append(f"lower({addr}) = {lit(e)}")
        conds.append(f"ends_with(lower({addr}), {lit('@' + e)})")
        if not exact:
            conds.append(f"contains(lower({addr}), {lit(e)})")
    return "(" + " OR ".join(conds) + ")"


def message_body() -> str:
    """Flat restatement of the part choice: a plain part (non-attachment) exists iff has_plain."""
    return (f"CASE WHEN has_plain THEN (CASE WHEN length({strip('plain')}) > 0 THEN plain ELSE '' END) "
            f"ELSE (CASE WHEN length({strip(html_to_markdown('html'))}) > 0 THEN {html_to_markdown('html')} ELSE '' END) END")


def message_articles(whitelist=(), max_emails: int | None = None, exact: bool = False) -> str:
    src = "messages_flat" if not max_emails else f"(SELECT * FROM messages_flat ORDER BY ord DESC LIMIT {max_emails})"
    name, addr = sender_name("from_header"), sender_address("from_header")
    mid = message_id_hash("message_id", "subject", "date_header", "from_header")
    sel = (f"SELECT ord, 'email://' || {mid} AS url, coalesce(subject, 'Untitled Newsletter') AS title, "
           f"{remove_footer('body')} AS content_raw, who AS author, {rfc_epoch('date_header')} AS published_epoch, "
           f"who AS source_name, ['newsletter'] AS tags FROM (SELECT *, {message_body()} AS body, "
           f"CASE WHEN length({name}) > 0 THEN {name} ELSE {addr} END AS who FROM {src} "
           f"WHERE {sender_allowed(addr, whitelist, exact)}) WHERE length({strip('body')}) > 0")
    return _art(sel, "email", 4)


# ---- model replies ----------------------------------------------------------

def _whole_object(s: str) -> str:
    return f"(starts_with({s}, '{{') AND ends_with({s}, '}}') AND coalesce(json_valid({s}), false))"


def extract_flat_json(raw: str) -> str:
    s = strip(raw)
    found = rx_extract(s, r"(?s)\{[^{}]*\}", 0)
    return f"CASE WHEN {_whole_object(s)} THEN {s} WHEN length({found}) > 0 THEN {found} END"


def extract_greedy_json(raw: str) -> str:
    s = strip(rx_replace(raw, f"(?s)<think\\b[^>]*>.*?</think{WS}*>", ""))
    found = rx_extract(s, r"(?s)\{.*\}", 0)
    return f"CASE WHEN {_whole_object(s)} THEN {s} WHEN length({found}) > 0 THEN {found} END"


def l1_num(js: str) -> str:
    t = f"json_type({js}, '$.relevance_score')"
    st = f"json_extract_string({js}, '$.relevance_score')"
    return (f"CASE {t} WHEN 'VARCHAR' THEN (CASE WHEN regexp_matches({st}, {lit('^' + WS + '*[+-]?[0-9]+' + WS + '*$')}) "
            f"THEN TRY_CAST({strip(st)} AS BIGINT) END) WHEN 'NULL' THEN NULL WHEN 'ARRAY' THEN NULL WHEN 'OBJECT' THEN NULL "
            f"WHEN 'BOOLEAN' THEN (CASE WHEN {st} = 'true' THEN 1 ELSE 0 END) "
            f"ELSE TRY_CAST(trunc(TRY_CAST({st} AS DOUBLE)) AS BIGINT) END")


def l1_select(src: str, key: str = "doc_id") -> str:
    """Rows of src (with raw, error) -> key, score, tags (array), language, parsed_ok."""
    js = "js"
    vld = "jv IS NOT NULL"
    present = "json_type(jv, '$.relevance_score') IS NOT NULL"
    num = l1_num("jv")
    score = (f"CAST(CASE WHEN error IS NOT NULL THEN 5 WHEN coalesce(length(raw), 0) = 0 THEN 0 "
             f"WHEN {js} IS NULL THEN 0 WHEN NOT {vld} THEN 5 WHEN NOT {present} THEN 0 ELSE coalesce({num}, 5) END AS INTEGER)")
    ok = (f"(error IS NULL AND coalesce(length(raw), 0) > 0 AND {js} IS NOT NULL AND {vld} AND "
          f"(NOT {present} OR ({num}) IS NOT NULL))")
    tags = "coalesce(TRY_CAST(json_extract(jv, '$.tags') AS VARCHAR[]), CAST([] AS VARCHAR[]))"
    lang = "coalesce(json_extract_string(jv, '$.language'), '')"
    return (f"SELECT *, {score} AS relevance_score, {ok} AS parsed_ok, {tags} AS reply_tags, {lang} AS reply_language "
            f"FROM ({_with_js(src, extract_flat_json('raw'))})")


def _with_js(src: str, js_expr: str) -> str:
    return (f"SELECT *, CASE WHEN coalesce(json_valid(js), false) THEN js END AS jv "
            f"FROM (SELECT *, {js_expr} AS js FROM ({src}))")


def assign_tier(score: str, discard_max: int = 3, compressed_max: int = 6) -> str:
    return (f"CASE WHEN {score} <= 0 THEN '' WHEN {score} <= {discard_max} THEN 'discard' "
            f"WHEN {score} <= {compressed_max} THEN 'compressed' ELSE 'detailed' END")


def l2_select(src: str) -> str:
    """Rows of src (with raw, error) -> + summary, key_points, related_topics."""
    js, vld = "js", "jv IS NOT NULL"
    summ = "coalesce(json_extract_string(jv, '$.summary'), '')"
    tldr = "coalesce(json_extract_string(jv, '$.tldr'), '')"
    full = f"CASE WHEN length({tldr}) > 0 THEN '**TL;DR:** ' || {tldr} || chr(10) || chr(10) || {summ} ELSE {summ} END"
    kp = "coalesce(TRY_CAST(json_extract(jv, '$.key_points') AS VARCHAR[]), CAST([] AS VARCHAR[]))"
    rt = "coalesce(TRY_CAST(json_extract(jv, '$.related_topics') AS VARCHAR[]), CAST([] AS VARCHAR[]))"
    fail = "error IS NOT NULL OR coalesce(length(raw), 0) = 0 OR js IS NULL OR NOT " + vld
    summary = (f"CASE WHEN error IS NOT NULL THEN '[Summary generation failed: ' || substr(error, 1, 100) || ']' "
               f"WHEN coalesce(length(raw), 0) = 0 THEN '[Summary generation returned empty]' "
               f"WHEN {js} IS NULL OR NOT {vld} THEN substr(raw, 1, 500) ELSE {full} END")
    return (f"SELECT *, {summary} AS content_summary, CASE WHEN {fail} THEN CAST([] AS VARCHAR[]) ELSE {kp} END AS key_points, "
            f"CASE WHEN {fail} THEN CAST([] AS VARCHAR[]) ELSE {rt} END AS related_topics "
            f"FROM ({_with_js(src, extract_greedy_json('raw'))})")


def l3_select(src: str) -> str:
    """Rows of src (with raw, error) -> + ok, concepts, structure_type, key_insight, content_deep."""
    js, vld = "jv", "jv IS NOT NULL"
    ctype = f"json_type({js}, '$.concepts')"
    absent = f"({ctype} IS NULL OR {ctype} = 'NULL')"
    cast = f"TRY_CAST(json_extract({js}, '$.concepts') AS STRUCT(name VARCHAR, definition VARCHAR)[])"
    concepts = f"CASE WHEN {absent} THEN [] ELSE {cast} END"
    c_ok = f"({absent} OR ({cast} IS NOT NULL AND len(list_filter({cast}, lambda c: c.name IS NULL)) = 0))"
    st = f"coalesce(json_extract_string({js}, '$.structure_type'), '')"
    ki = f"coalesce(json_extract_string({js}, '$.key_insight'), '')"
    asm = f"coalesce(TRY_CAST(json_extract({js}, '$.assumptions') AS VARCHAR[]), CAST([] AS VARCHAR[]))"
    pos = f"coalesce(json_extract_string({js}, '$.position'), '')"
    nl = "chr(10)"
    deep = (f"concat_ws({nl} || {nl}, CASE WHEN length(ki) > 0 THEN '**核心洞见:** ' || ki END, "
            f"CASE WHEN length(st) > 0 THEN '**文章类型:** ' || st END, "
            f"CASE WHEN len(asm) > 0 THEN '**前提假设:**' || {nl} || array_to_string(list_transform(asm, lambda a: '- ' || a), {nl}) END, "
            f"CASE WHEN length(pos) > 0 THEN '**作者立场:** ' || pos END, "
            f"CASE WHEN len(concepts) > 0 THEN '**核心概念:**' || {nl} || array_to_string(list_transform(concepts, "
            f"lambda c: '- **' || c.name || '**: ' || coalesce(c.definition, '')), {nl}) END)")
    ok = f"(error IS NULL AND coalesce(length(raw), 0) > 0 AND js IS NOT NULL AND {vld} AND c_ok)"
    inner = (f"SELECT *, {concepts} AS concepts, {c_ok} AS c_ok, {st} AS st, {ki} AS ki, {asm} AS asm, {pos} AS pos "
             f"FROM ({_with_js(src, extract_greedy_json('raw'))})")
    return f"SELECT *, {ok} AS ok, {deep} AS content_deep FROM ({inner})"


# ---- note rendering ---------------------------------------------------------

SOURCE_DIR_CASE = ("CASE source WHEN 'rss' THEN '2-Articles' WHEN 'web_url' THEN '2-Articles' WHEN 'feishu' THEN '2-Articles' "
                   "WHEN 'github' THEN '3-GitHub' WHEN 'email' THEN '4-Newsletters' WHEN 'manual' THEN '0-Inbox' "
                   "ELSE '0-Inbox' END")


def yaml_quoted(x: str) -> str:
    e = f"replace({x}, '\\', '\\\\')"
    for a, b in (('"', '\\"'), ("chr(10)", "'\\n'"), ("chr(13)", "'\\r'"), ("chr(9)", "'\\t'")):
        if a.startswith("chr"):
            e = f"replace({e}, {a}, {b})"
        else:
            e = f"replace({e}, {lit(a)}, {lit(b)})"
    return f"('\"' || {e} || '\"')"


def frontmatter(as_of: str) -> str:
    nl = "chr(10)"
    tags = "coalesce(tags, CAST([] AS VARCHAR[]))"
    return (f"concat_ws({nl}, 'title: ' || {yaml_quoted('title')}, 'source: ' || {yaml_quoted('url')}, "
            f"'source_name: ' || {yaml_quoted('coalesce(source_name, ' + lit('') + ')')}, "
            f"CASE WHEN length(author) > 0 THEN 'author: ' || {yaml_quoted('author')} END, "
            f"'date_processed: ' || {yaml_quoted(lit(as_of))}, "
            f"CASE WHEN published_epoch IS NOT NULL THEN 'date_published: ' || {yaml_quoted(epoch_date_label('published_epoch'))} END, "
            f"CASE WHEN len({tags}) > 0 THEN 'tags:' || {nl} || array_to_string(list_transform({tags}, "
            f"lambda t: '- ' || {yaml_quoted('t')}), {nl}) ELSE 'tags: []' END, "
            f"'relevance: ' || CAST(relevance_score AS VARCHAR), 'level: ' || {yaml_quoted('processing_level')}, "
            f"'hash: ' || {yaml_quoted('content_hash')})")


def body() -> str:
    nl = "chr(10)"
    e = "CAST([] AS VARCHAR[])"
    author = "coalesce(author, '')"
    meta = (f"'> Source: [' || coalesce(source_name, '') || '](' || url || ')' || "
            f"CASE WHEN length({author}) > 0 THEN ' | Author: ' || {author} ELSE '' END || {nl}")
    summ = "coalesce(content_summary, '')"
    kp = f"coalesce(key_points, {e})"
    deep = "coalesce(content_deep, '')"
    rel = f"coalesce(related_topics, {e})"
    tags = f"coalesce(tags, {e})"
    raw = "coalesce(content_raw, '')"
    parts = (f"list_concat(['# ' || title || {nl}, {meta}], "
             f"CASE WHEN length({summ}) > 0 THEN ['## Summary' || {nl}, {summ} || {nl}] ELSE {e} END, "
             f"CASE WHEN len({kp}) > 0 THEN list_concat(['## Key Points' || {nl}], list_transform({kp}, lambda p: '- ' || p), ['']) ELSE {e} END, "
             f"CASE WHEN length({deep}) > 0 THEN ['## Deep Analysis' || {nl}, {deep} || {nl}] ELSE {e} END, "
             f"CASE WHEN len({rel}) > 0 THEN ['## Related' || {nl}, array_to_string(list_transform({rel}, lambda t: '[[' || t || ']]'), ' ') || {nl}] ELSE {e} END, "
             f"CASE WHEN len({tags}) > 0 THEN ['## Tags' || {nl}, array_to_string(list_transform({tags}, lambda t: '#' || t), ' ') || {nl}] ELSE {e} END, "
             f"CASE WHEN content_tier = 'detailed' AND length({raw}) > 0 THEN ['## 原文内容' || {nl}, {raw} || {nl}] "
             f"WHEN length({raw}) > 0 THEN [{nl} || '---' || {nl} || '*原文: ' || CAST({word_count(raw)} AS VARCHAR) || ' words*' || {nl}] ELSE {e} END, "
             f"[{nl} || '## Personal Notes' || {nl}])")
    return f"array_to_string({parts}, {nl})"


def note_content(as_of: str) -> str:
    return f"('---' || chr(10) || {frontmatter(as_of)} || chr(10) || '---' || chr(10) || {body()})"


def target_dir(as_of: str) -> str:
    repo = "CASE WHEN length(source_name) > 0 THEN list_extract(string_split(source_name, '/'), -1) ELSE 'unknown' END"
    return f"({SOURCE_DIR_CASE} || '/' || CASE WHEN source = 'github' THEN {repo} ELSE '{as_of}' END)"


def family_slots(filename: str) -> str:
    """Existing file name -> list of (stem, slot) interpretations."""
    stem = rx_extract(filename, r"^(.*)\.md$", 1)
    base = rx_extract(stem, r"^(.*)-([1-9][0-9]*)$", 1)
    k = rx_extract(stem, r"^(.*)-([1-9][0-9]*)$", 2)
    return (f"CASE WHEN length({k}) > 0 THEN [{{'stem': {stem}, 'slot': 0}}, {{'stem': {base}, 'slot': CAST({k} AS BIGINT)}}] "
            f"ELSE [{{'stem': {stem}, 'slot': 0}}] END")


def resolve_collisions(notes: str, existing: str | None, key: str) -> str:
    """notes: rows with key, dir, filename -> + final filename (first-free-slot rule, computed by brute force
    over a bounded slot range for the oracle)."""
    n = (f"SELECT *, {rx_extract('filename', r'^(.*)\.md$', 1)} AS stem, "
         f"row_number() OVER (PARTITION BY dir, {rx_extract('filename', r'^(.*)\.md$', 1)} ORDER BY {key}) - 1 AS r "
         f"FROM ({notes})")
    base = rx_extract(rx_extract("filename", r"^(.*)\.md$", 1), r"^(.*)-([1-9][0-9]*)$", 1)
    k = rx_extract(rx_extract("filename", r"^(.*)\.md$", 1), r"^(.*)-([1-9][0-9]*)$", 2)
    ex = (f"SELECT DISTINCT dir, {base} AS stem, CAST({k} AS BIGINT) AS slot FROM ({notes}) WHERE length({k}) > 0")
    if existing is not None:
        ex += (f" UNION SELECT DISTINCT dir, f.stem AS stem, f.slot AS slot FROM (SELECT dir, "
               f"unnest({family_slots('filename')}) AS f FROM ({existing}))")
    # Free slots of a family: 0..(r + #existing); pick the r-th free one.
    free = (f"SELECT n.{key}, n.dir, n.stem, n.r, s.k FROM ({n}) n, "
            f"LATERAL (SELECT unnest(range(0, n.r + 1 + (SELECT count(*) FROM ({ex}) e WHERE e.dir = n.dir AND e.stem = n.stem))) AS k) s "
            f"WHERE NOT EXISTS (SELECT 1 FROM ({ex}) e WHERE e.dir = n.dir AND e.stem = n.stem AND e.slot = s.k)")
    pick = (f"SELECT {key}, dir, stem, k FROM (SELECT *, row_number() OVER (PARTITION BY {key}, dir ORDER BY k) - 1 AS j "
            f"FROM ({free})) WHERE j = r")
    return (f"SELECT x.* REPLACE (CASE WHEN p.k = 0 THEN x.filename ELSE p.stem || '-' || CAST(p.k AS VARCHAR) || '.md' END "
            f"AS filename) FROM ({notes}) x JOIN ({pick}) p ON p.{key} = x.{key} AND p.dir = x.dir")
