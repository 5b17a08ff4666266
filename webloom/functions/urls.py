"""URL functions: native Spark SQL functions, no Python UDFs.

Each function is defined once as a Spark SQL function
(``CREATE TEMPORARY FUNCTION webloom_<name> ... RETURN <expr>``), registered
the first time a session uses it.  The Python wrappers below are single
``call_function`` calls, so building a query costs one JVM round trip per
use, and SQL users can call ``webloom_normalize_url(url)`` and friends
directly.  Catalyst inlines the bodies, so they are optimised and
code-generated like any built-in expression.

The bodies follow the component rules of the standard ``urlsplit`` /
``urlunsplit`` pair the crawl contract is written against: the scheme is
the ``[A-Za-z][A-Za-z0-9+.-]*`` prefix before the first ``:``; ``//``
starts a netloc that runs to the first ``/ ? #``; the fragment follows the
first ``#`` and the query the first ``?`` before it; ``;params`` start at
the first ``;`` of the last path segment; empty query and fragment are
dropped when a URL is put back together.  Values used several times are
bound once with a one-element ``transform`` (a lambda binding), which keeps
expression trees small.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# --------------------------------------------------------------------------
# Fixed values
# --------------------------------------------------------------------------

# Schemes that allow relative references / carry a netloc.
USES_RELATIVE = ["", "ftp", "http", "gopher", "nntp", "imap", "wais", "file", "https",
                 "shttp", "mms", "prospero", "rtsp", "rtsps", "rtspu", "sftp", "svn",
                 "svn+ssh", "ws", "wss"]
USES_NETLOC = ["", "ftp", "http", "gopher", "nntp", "telnet", "imap", "wais", "file",
               "mms", "https", "shttp", "snews", "prospero", "rtsp", "rtsps", "rtspu",
               "rsync", "svn", "svn+ssh", "sftp", "nfs", "git", "git+ssh", "ws", "wss",
               "itms-services"]
# Rejected file extensions (last suffix of the path, lower case).
SKIP_EXTENSIONS = [
    ".pdf", ".jpg", ".jpeg", ".png", ".gif", ".svg", ".ico", ".css",
    ".js", ".mp3", ".mp4", ".mov", ".avi", ".zip", ".rar", ".tar",
    ".gz", ".7z", ".xml", ".json", ".rss", ".atom", ".doc", ".docx",
    ".xls", ".xlsx", ".ppt", ".pptx",
]
# Rejected substrings anywhere in the lower-cased URL.
SKIP_SUBSTRINGS = [
    "format=xml", "format=json", "feed=", "rss", "atom", "print=",
    "download=", "attachment", "calendar", ".ashx", ".axd",
    "/wp-admin/", "/wp-login", "/wp-content/uploads/",
    "/admin/", "/login", "/logout", "/signin", "/signout",
    "share=", "comment", "/search/",
]

# --------------------------------------------------------------------------
# SQL text builders (pure string composition, no JVM calls)
# --------------------------------------------------------------------------

_S = r"[A-Za-z][A-Za-z0-9+.\-]*"
SCHEME_RE = rf"^({_S}):"
PY_SPACE = r"(?U)[\s\x1c-\x1f]"


def L(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _in(e: str, values) -> str:
    return f"{e} IN ({', '.join(L(v) for v in values)})"


def ex(e: str, pat: str, g: int = 1) -> str:
    return f"regexp_extract({e}, {L(pat)}, {g})"


def rp(e: str, pat: str, rep: str = "") -> str:
    return f"regexp_replace({e}, {L(pat)}, {L(rep)})"


def let(e: str, var: str, body: str) -> str:
    return f"element_at(transform(array({e}), {var} -> {body}), 1)"


_WS_LITERAL = "'" + "".join(f"\\u{c:04x}" for c in range(0x3001) if chr(c).isspace()) + "'"


def py_strip_sql(e: str) -> str:
    return f"btrim({e}, {_WS_LITERAL})"


def clean(e: str) -> str:
    return rp(rp(e, r"[\t\r\n]"), r"^[\x00-\x20]+")


def scheme(e: str) -> str:
    return f"lower({ex(e, SCHEME_RE)})"


def rest(e: str) -> str:
    return rp(e, SCHEME_RE)


def parts(r: str) -> str:
    return (f"named_struct('net', {ex(r, r'^//([^/?#]*)')}, "
            f"'path', {ex(r, r'^(?://[^/?#]*)?([^?#]*)')}, "
            f"'query', {ex(r, r'(?s)^[^?#]*[?]([^#]*)')}, "
            f"'frag', {ex(r, r'(?s)^[^#]*#(.*)$')}, "
            f"'has_net', startswith({r}, '//'))")


def unsplit(s: str, n: str, p: str, q: str, f: str) -> str:
    return (f"concat(CASE WHEN {s} <> '' THEN concat({s}, ':') ELSE '' END, "
            f"CASE WHEN {n} <> '' THEN concat('//', {n}) WHEN startswith({p}, '//') THEN '//' "
            f"WHEN {_in(s, USES_NETLOC)} AND ({p} = '' OR startswith({p}, '/')) THEN '//' ELSE '' END, "
            f"CASE WHEN {n} <> '' AND {p} <> '' AND NOT startswith({p}, '/') THEN concat('/', {p}) ELSE {p} END, "
            f"CASE WHEN {q} <> '' THEN concat('?', {q}) ELSE '' END, "
            f"CASE WHEN {f} <> '' THEN concat('#', {f}) ELSE '' END)")


def split_struct(u: str) -> str:
    """``struct(s, p)``: scheme and remainder parts of a cleaned URL."""
    return f"named_struct('s', {scheme(u)}, 'p', {parts(rest(u))})"


# --------------------------------------------------------------------------
# Function bodies
# --------------------------------------------------------------------------

# A URL that normalisation leaves unchanged: http(s), a port-free netloc, a
# path that is "/" or does not end in "/", no ;params, no empty query or
# fragment, no control characters or spaces, no trailing Unicode space.
CANONICAL = (r"^https?://[^/?#:@\[\]\x00-\x20]+(?:/|/[^?#;\x00-\x20]*[^/?#;\x00-\x20])"
             r"(?:[?][^#\x00-\x20]+)?(?:#[^\x00-\x20]+)?(?<=[\x21-\x7e])$")
ROOT_ONLY = r"(?s)^[a-z]+://[^/?#]*/(;[^/?#]*)?([?#].*)?$"
TRAILING = r"(?s)^([a-z]+://[^/?#]*)((?:/[^?#]*?[^/?#])?)/+(;[^/?#]*)?([?#].*)?$"


def _bad_port(net: str) -> str:
    port = (f"CASE WHEN contains(hi, '[') THEN {ex('hi', r'^[^\[]*\[[^\]]*\][^:]*:(.*)$')} "
            f"ELSE {ex('hi', r'^[^:]*:(.*)$')} END")
    digits = rp("pt", r"^0+(?=.)")
    check = (f"pt <> '' AND NOT coalesce(pt RLIKE '^[0-9]+$' AND length({digits}) <= 5 "
             f"AND CAST(CASE WHEN pt RLIKE '^[0-9]+$' AND length({digits}) <= 5 THEN {digits} END AS INT) "
             f"<= 65535, false)")
    return let(ex(net, r"^(?:.*@)?(.*)$"), "hi", let(port, "pt", check))


def _normalize(u: str) -> str:
    s = rp("s", r"[\t\r\n]")
    s = rp(s, r"^(http://[^/?#]*?):0*80(?=[/?#]|$)", "$1")
    s = rp(s, r"^(https://[^/?#]*?):0*443(?=[/?#]|$)", "$1")
    s = rp(s, r"^([a-z]+://[^/?#]*)(?=[?#]|$)", "$1/")
    s = rp(s, r"^([^?#]*)[?](?=#|$)", "$1")
    s = rp(s, r"(?s)^([^#]*)#$", "$1")
    # empty netloc, all-slash path and ;params: the path empties and the
    # URL is put back together without "//"
    s = rp(s, r"(?s)^([a-z]+:)///+(;[^/?#]*)([?#].*)?$", "$1$2$3")
    body = let(s, "t", f"CASE WHEN t RLIKE {L(ROOT_ONLY)} THEN t ELSE {rp('t', TRAILING, '$1$2$3$4')} END")
    net = ex(rest(rp("s", r"[\t\r\n]")), r"^//([^/?#]*)")
    checked = f"CASE WHEN {_bad_port(net)} THEN CAST(NULL AS STRING) ELSE {body} END"
    prefixed = let(py_strip_sql(u), "s0", "CASE WHEN startswith(s0, 'http://') OR startswith(s0, 'https://') "
                                          "THEN s0 ELSE concat('https://', s0) END")
    return f"CASE WHEN {u} RLIKE {L(CANONICAL)} THEN {u} ELSE {let(prefixed, 's', checked)} END"


def _merge_paths(bpath: str, hpath: str) -> str:
    bdir = let(f"split({bpath}, '/', -1)", "bq",
               "CASE WHEN element_at(bq, -1) <> '' THEN slice(bq, 1, size(bq) - 1) ELSE bq END")
    tidy = let(f"concat({bdir}, split({hpath}, '/', -1))", "m",
               "concat(slice(m, 1, 1), filter(slice(m, 2, greatest(size(m) - 2, 0)), z -> z <> ''), "
               "slice(m, -1, 1))")
    segs = f"CASE WHEN startswith({hpath}, '/') THEN split({hpath}, '/', -1) ELSE {tidy} END"
    walk = ("aggregate(sg, CAST(array() AS ARRAY<STRING>), (acc, e) -> CASE WHEN e = '..' THEN "
            "CASE WHEN size(acc) > 0 THEN slice(acc, 1, size(acc) - 1) ELSE acc END "
            "WHEN e = '.' THEN acc ELSE array_append(acc, e) END)")
    fixed = f"CASE WHEN element_at(sg, -1) IN ('.', '..') THEN array_append({walk}, '') ELSE {walk} END"
    joined = let(f"array_join({fixed}, '/')", "jp", "CASE WHEN jp = '' THEN '/' ELSE jp END")
    return let(segs, "sg", joined)


def _resolve(b: str, h: str) -> str:
    keep_query = "CASE WHEN hp.query <> '' THEN hp.query ELSE y.bp.query END"
    inner = (f"CASE WHEN hp.has_net AND hp.net <> '' THEN {unsplit('y.sc', 'hp.net', 'hp.path', 'hp.query', 'hp.frag')} "
             f"WHEN hp.path = '' THEN {unsplit('y.sc', 'y.bp.net', 'y.bp.path', keep_query, 'hp.frag')} "
             f"ELSE {let(_merge_paths('y.bp.path', 'hp.path'), 'mp', unsplit('y.sc', 'y.bp.net', 'mp', 'hp.query', 'hp.frag'))} END")
    joined = let(parts(f"CASE WHEN y.hs <> '' THEN {rest('x.h')} ELSE x.h END"), "hp", inner)
    with_scheme = f"CASE WHEN y.sc <> y.bs OR NOT {_in('y.sc', USES_RELATIVE)} THEN x.raw ELSE {joined} END"
    ys = (f"named_struct('bs', {scheme('x.b')}, 'hs', {ex('x.h', SCHEME_RE)}, "
          f"'sc', CASE WHEN {ex('x.h', SCHEME_RE)} <> '' THEN lower({ex('x.h', SCHEME_RE)}) ELSE {scheme('x.b')} END, "
          f"'bp', {parts(rest('x.b'))})")
    general = let(f"named_struct('b', {clean(b)}, 'h', {clean(h)}, 'raw', {h})", "x", let(ys, "y", with_scheme))
    # fast paths, exact for the shapes they accept (tested against urljoin)
    hs = ex(h, SCHEME_RE)
    bs = f"lower({ex(b, SCHEME_RE)})"
    plain = f"NOT {h} RLIKE {L(r'[\x00-\x20]')} AND NOT {h} RLIKE {L(r'[?](#|$)|#$')}"
    no_dots = f"NOT {ex(h, r'^([^?#]*)')} RLIKE {L(r'(^|/)[.][.]?(/|$)')}"
    simple_base = f"{b} RLIKE {L(rf'^{_S}://')} AND NOT {b} RLIKE {L(r'^[^#]*[\x00-\x20]')}"
    rooted = (f"{plain} AND {no_dots} AND ({h} RLIKE {L(r'^/[^/]')} OR {h} = '/') AND {simple_base} "
              f"AND {bs} IN ('http', 'https')")
    absolute = f"{plain} AND {h} RLIKE {L(r'^(http|https)://[^/?#]')} AND {hs} = {bs}"
    foreign = (f"{hs} <> '' AND lower({hs}) <> {bs} AND {bs} IN ('http', 'https') "
               f"AND NOT {b} RLIKE {L(r'^[\x00-\x20]')}")
    root = ex(b, rf"^{_S}(://[^/?#]*)")
    return (f"CASE WHEN {b} IS NULL OR {b} = '' THEN {h} WHEN {h} IS NULL OR {h} = '' THEN {b} "
            f"WHEN {foreign} THEN {h} WHEN {absolute} THEN {h} "
            f"WHEN {rooted} THEN concat({bs}, {root}, {h}) ELSE {general} END")


def _variants(u: str) -> str:
    s, n, p, q, f = "v.s", "v.p.net", "v.p.path", "v.p.query", "v.p.frag"
    www = f"CASE WHEN startswith({n}, 'www.') THEN substring({n}, 5) ELSE concat('www.', {n}) END"
    slash = (f"CASE WHEN {p} = '' THEN {unsplit(s, n, L('/'), q, f)} "
             f"WHEN {p} = '/' THEN {unsplit(s, n, L(''), q, f)} END")
    other = f"CASE WHEN {s} = 'https' THEN 'http' ELSE 'https' END"
    body = (f"filter(array({unsplit(s, www, p, q, f)}, {slash}, {unsplit(other, n, p, q, f)}), "
            f"w -> w IS NOT NULL)")
    return let(split_struct(clean(u)), "v", body)


def _url_path(u: str) -> str:
    return rp(ex(rest(clean(u)), r"^(?://[^/?#]*)?([^?#]*)"), r";[^/]*$")


def _file_name(u: str) -> str:
    name = "CASE WHEN endswith(lf, '.html') THEN lf ELSE concat(lf, '.html') END"
    body = (f"CASE WHEN fp = '' OR fp = '/' THEN 'index.html' "
            f"WHEN contains(lower(fc), 'about') THEN 'aboutus.html' "
            f"ELSE {rp(name, r'[^a-zA-Z0-9_\-.]', '_')} END")
    last = f"CASE WHEN {ex('fc', r'([^/]*)$')} = '' THEN 'page' ELSE {ex('fc', r'([^/]*)$')} END"
    return let(_url_path(u), "fp", let(rp("fp", r"^/+|/+$"), "fc", let(last, "lf", body)))


def _md_name(u: str) -> str:
    stem = ex("mf", r"(?s)^(\.*[^.].*)\.[^.]*$")
    return let(_file_name(u), "mf", f"concat(CASE WHEN {stem} <> '' THEN {stem} ELSE mf END, '.md')")


def _extension(path: str) -> str:
    return ex(ex(path, r"([^/]*)$"), r"(?s)^\.*[^.].*(\.[^.]*)$")


def _is_page(u: str) -> str:
    subs = " OR ".join(f"contains(lw, {L(s)})" for s in SKIP_SUBSTRINGS)
    return (f"NOT {_in(f'lower({_extension(_url_path(u))})', SKIP_EXTENSIONS)} "
            f"AND NOT {let(f'lower({u})', 'lw', f'({subs})')}")


def _strip_www(u: str) -> str:
    return let(split_struct(clean(u)), "v",
               unsplit("v.s", rp("v.p.net", r"^www(\.|$)"), "v.p.path", "v.p.query", "v.p.frag"))


def _host(e: str) -> str:
    return ex(clean(e), rf"^(?:{_S}:)?//([^/?#]*)")


def link_info_sql(page: str, href: str) -> str:
    """One expression for a link found on a page: ``struct(link, same,
    internal, dst)`` - the resolved link, whether it points back to the page,
    whether it is internal, and its normalised form (internal) or itself
    (external).  Each URL function is evaluated once per link."""
    same = f"substring_index(q.l, '#', 1) = substring_index({page}, '#', 1)"
    info = (f"named_struct('link', q.l, 'same', {same}, 'internal', q.i, "
            f"'dst', CASE WHEN q.i THEN {_normalize('q.l')} ELSE q.l END)")
    internal = (f"{rp(_host('l'), r'^www(\.|$)')} = {rp(_host(page), r'^www(\.|$)')}")
    return let(_resolve(page, href), "l", let(f"named_struct('l', l, 'i', {internal})", "q", info))


def follow_target_sql(src: str, dst: str) -> str:
    """``struct(dst, ok)``: the normalised target and whether a crawl follows
    it (internal to the source's host, a valid port, a page-like URL)."""
    internal = f"{rp(_host(dst), r'^www(\.|$)')} = {rp(_host(src), r'^www(\.|$)')}"
    ok = f"{internal} AND n IS NOT NULL AND {_is_page('n')}"
    return let(_normalize(dst), "n", f"named_struct('dst', n, 'ok', coalesce({ok}, false))")


# name -> (argument list, return type, body)
DEFINITIONS = {
    "normalize_url": ("u STRING", "STRING", _normalize("u")),
    "resolve_url": ("b STRING, h STRING", "STRING", _resolve("b", "h")),
    "host_of": ("u STRING", "STRING", ex(clean("u"), rf"^(?:{_S}:)?//([^/?#]*)")),
    "site_root": ("u STRING", "STRING",
                  let(clean("u"), "c", f"concat({scheme('c')}, '://', {ex(rest('c'), r'^//([^/?#]*)')})")),
    "strip_www": ("u STRING", "STRING", _strip_www("u")),
    "url_path": ("u STRING", "STRING", _url_path("u")),
    "is_page_url": ("u STRING", "BOOLEAN", _is_page("u")),
    "url_variants": ("u STRING", "ARRAY<STRING>", _variants("u")),
    "page_file_name": ("u STRING", "STRING", _file_name("u")),
    "markdown_file_name": ("u STRING", "STRING", _md_name("u")),
}

# set in a session's own configuration once a function is defined there: it lives and
# dies with the session, and is inherited where temporary functions are
_MARK = "webloom.defined."


def register_functions(spark: SparkSession, names=None) -> None:
    """Define the ``webloom_*`` SQL functions in this session (each once)."""
    for name in names or DEFINITIONS:
        if spark.conf.get(_MARK + name, None):
            continue
        args, ret, body = DEFINITIONS[name]
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION webloom_{name}({args}) RETURNS {ret} RETURN {body}")
        spark.conf.set(_MARK + name, "true")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _call(name: str, *cols) -> Column:
    spark = SparkSession.getActiveSession()
    if spark is None:
        raise RuntimeError("URL functions need an active SparkSession")
    register_functions(spark, [name])
    return F.call_function(f"webloom_{name}", *[_c(c) for c in cols])


# --------------------------------------------------------------------------
# Column functions
# --------------------------------------------------------------------------

def normalize_url(c) -> Column:
    """#9 Canonical form of a page URL: strip; prefix ``https://`` unless it
    starts with ``http://``/``https://``; drop ``:80`` on http and ``:443`` on
    https; empty path becomes ``/``; trailing slashes go when the path is
    longer than one character; query, fragment and host case are kept.  A
    non-numeric or out-of-range port gives null."""
    return _call("normalize_url", c)


def host_of(c) -> Column:
    """#11 Network location (user info and port included, case kept)."""
    return _call("host_of", c)


def site_root(c) -> Column:
    """#12 ``scheme://netloc``."""
    return _call("site_root", c)


def drop_www(host) -> Column:
    """Remove one leading ``www`` label of a host."""
    return F.regexp_replace(_c(host), r"^www(\.|$)", "")


def strip_www(c) -> Column:
    """#10 URL with one leading ``www`` label removed from its host."""
    return _call("strip_www", c)


def is_internal(link, base_host) -> Column:
    """#13 Same host once a leading ``www`` label is removed from each side;
    other subdomains and ports make a link external."""
    return drop_www(host_of(link)) == drop_www(_c(base_host))


def url_path(c) -> Column:
    """Path component (without ``;params``)."""
    return _call("url_path", c)


def is_page_url(c) -> Column:
    """#14 Not a file download or an admin / feed / search style URL."""
    return _call("is_page_url", c)


def resolve_url(base, href) -> Column:
    """#15 Resolve ``href`` against ``base`` (RFC 3986 style, dot segments
    removed, ``<base href>`` not considered)."""
    return _call("resolve_url", base, href)


def is_followable_href(href) -> Column:
    """#16 False for empty hrefs and ``javascript:`` / ``mailto:`` / ``tel:``
    ones (case-sensitive, no trimming)."""
    h = _c(href)
    return (h.isNotNull() & (h != "") & ~h.startswith("javascript:")
            & ~h.startswith("mailto:") & ~h.startswith("tel:"))


def same_page(link, page_url) -> Column:
    """#17 Link and page are equal once everything from the first ``#`` goes."""
    return F.substring_index(_c(link), "#", 1) == F.substring_index(_c(page_url), "#", 1)


def url_variants(c) -> Column:
    """#18 Ordered alternatives tried when a URL cannot be captured: toggle
    ``www.``, then toggle an empty/``/`` path, then swap http/https."""
    return _call("url_variants", c)


def page_file_name(c) -> Column:
    """#19/#20 File name a page is stored under inside its host directory."""
    return _call("page_file_name", c)


def markdown_file_name(c) -> Column:
    """#5 The page file name with its extension replaced by ``.md``."""
    return _call("markdown_file_name", c)


def capture_key(c) -> Column:
    """#21 Hex MD5 of the UTF-8 URL."""
    return F.md5(_c(c))
