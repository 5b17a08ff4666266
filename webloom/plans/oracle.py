"""DuckDB SQL building blocks for the oracle queries.

These are written independently of the Spark operators: plain regular
expressions and string functions over the same tables, valid for the URL
and HTML shapes present in the inputs and fixtures.
"""

from __future__ import annotations

from . import fixtures as FX

NL2 = "chr(10) || chr(10)"

# -- fixture CTEs -------------------------------------------------------------
PAGES_X = f"pages_x as (select page_id, url, {FX.PAGES_X_HTML} as html from pages)"
EDGES = (f"edges as (select {FX.EDGE_SRC} as src, {FX.EDGE_DST} as dst from "
         f"(select page_id, unnest(range({FX.EDGE_K})) as k, (select count(*) from pages) as n from pages))")
GRAPH_CAPTURES = f"graph_captures as (select {FX.EDGE_SRC} as url, html from pages)"
ROBOTS = (f"robots as (select host, {FX.ROBOTS_BODY} as body from "
          f"(select distinct {FX.ROBOTS_HOST} as host from pages))")
_METHOD_OF = "case ord " + " ".join(f"when {o} then '{m}'" for o, m in FX.ATTEMPT_METHODS) + " end"
ATTEMPTS = ("attempts as (select page_id, url, ord, " + _METHOD_OF + " as method, "
            + ", ".join(f"{v} as {k}" for k, v in FX.ATTEMPT_COLS.items())
            + f" from (select page_id, url, html, unnest(range({len(FX.ATTEMPT_METHODS)})) as ord from pages))")
REPEATS = f"repeats as (select doc_id, {FX.REPEATS_TEXT} as text from documents)"
SEEDS = ("seeds as (select page_id, variant, case variant "
         + " ".join(f"when {i} then {e}" for i, e in enumerate(FX.SEED_VARIANTS))
         + f" end as website from (select page_id, url, unnest(range({len(FX.SEED_VARIANTS)})) as variant from pages))")


def with_(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


# -- URL expressions ----------------------------------------------------------------

def host(u: str) -> str:
    return f"regexp_extract({u}, '^[a-z]+://([^/?#]*)', 1)"


def scheme(u: str) -> str:
    return f"regexp_extract({u}, '^([a-z]+)://', 1)"


def path(u: str) -> str:
    return f"regexp_extract({u}, '^[a-z]+://[^/?#]*([^?#]*)', 1)"


def no_frag(u: str) -> str:
    return f"split_part({u}, '#', 1)"


def drop_www(h: str) -> str:
    return f"regexp_replace({h}, '^www(\\.|$)', '')"


def normalize(u: str) -> str:
    """Trim, default scheme, default port, empty path, trailing slashes."""
    s = f"trim({u})"
    s = f"(case when starts_with({s}, 'http://') or starts_with({s}, 'https://') then {s} else 'https://' || {s} end)"
    s = f"regexp_replace({s}, '^(http://[^/?#]*):80([/?#]|$)', '\\1\\2')"
    s = f"regexp_replace({s}, '^(https://[^/?#]*):443([/?#]|$)', '\\1\\2')"
    s = f"regexp_replace({s}, '^(https?://[^/?#]*)([?#].*)?$', '\\1/\\2')"
    return f"regexp_replace({s}, '^(https?://[^/?#]+/[^?#]*[^/?#])/+([?#].*)?$', '\\1\\2')"


def resolve(base: str, href: str) -> str:
    """Resolution for the href shapes present: absolute, scheme-relative,
    root-relative, query-only, fragment-only and one parent-directory form."""
    root = f"({scheme(base)} || '://' || {host(base)})"
    bpath = path(base)
    bdir = f"regexp_replace({bpath}, '[^/]*$', '')"
    return (f"(case when regexp_matches({href}, '^[A-Za-z][A-Za-z0-9+.-]*:') then {href} "
            f"when starts_with({href}, '//') then {scheme(base)} || ':' || {href} "
            f"when starts_with({href}, '/') then {root} || {href} "
            f"when starts_with({href}, '?') then {root} || {bpath} || {href} "
            f"when starts_with({href}, '#') then split_part({base}, '#', 1) || {href} "
            f"when starts_with({href}, '../') then {root} || '/' || ltrim(regexp_replace({bdir}, '[^/]+/$', ''), '/') || substr({href}, 4) "
            f"else {root} || {bdir} || {href} end)")


def unescape(x: str) -> str:
    return (f"regexp_replace(replace(replace(replace({x}, '&copy;', '©'), '&middot;', '·'), "
            f"'&quot;', '\"'), '&amp;?', '&', 'g')")


def py_strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


TITLE = py_strip(unescape("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)"))

BODY_TEXT = ("trim(regexp_replace(" + unescape(
    "regexp_replace(regexp_replace(regexp_extract(html, '(?s)<body>(.*)', 1), "
    "'(?s)<!--.*?-->|</body>.*', ' ', 'g'), '<[^>]*>', ' ', 'g')") + ", '\\s+', ' ', 'g'))")

CONTENT_TEXT_F2 = """c as (select page_id, regexp_replace(html,'(?s)<!--.*?-->|<!DOCTYPE[^>]*>|<script.*?</script>|<style.*?</style>|<noscript.*?</noscript>|<svg.*?</svg>',' ','g') h from pages_x),
 a as (select page_id, h, regexp_extract(h,'(?s)<article (?:id|class)[^>]*>(.*?)</article>',1) art, page_id % 4 m from c),
 x as (select page_id, case m when 0 then art when 1 then art when 2 then concat(art,' ',art)
   else case when contains(h,'<body>') then regexp_replace(regexp_extract(h,'(?s)<body>(.*)',1),'(?s)</body>.*','') else h end end r from a),
 ct as (select page_id, trim(regexp_replace(""" + unescape("regexp_replace(r,'<[^>]*>',' ','g')") + """,'\\s+',' ','g')) as text from x)"""

NO_CONTENT = "'No content extracted from page'"

# whitespace that Python's str methods and re treat as such
PY_WS_CLASS = ("[\\s\\x{0b}\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
               "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]")

# -- line splitting (documents use \n only) -----------------------------------------

def lines_cte(src: str, name: str = "l") -> str:
    return (f"{name} as (select doc_id, u.i - 1 as pos, trim(u.s, E' \\t') as line from {src}, "
            f"lateral (select unnest(string_split(text, E'\\n')) s, "
            f"generate_subscripts(string_split(text, E'\\n'), 1) i) u)")


def words(x: str) -> str:
    return f"len(regexp_split_to_array({x}, '\\s+'))"
