"""Column expressions over text: cleaning, hashing, keys, previews, URLs, HTML."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: ASCII white space, the same class in Java's and DuckDB's regular expressions.
WS = "[ \\t\\n\\x0B\\f\\r]"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ws_ascii(x: Column | str) -> Column:
    """Runs of ASCII white space become one space; the ends are trimmed."""
    return F.trim(F.regexp_replace(_c(x), WS + "+", " "))


def ws_unicode(x: Column | str) -> Column:
    """The same for all Unicode white space."""
    return F.trim(F.regexp_replace(_c(x), r"(?U)\s+", " "))


def non_empty(x: Column | str) -> Column:
    """Not null and not only spaces; never null itself."""
    return F.coalesce(F.length(F.trim(_c(x))) > 0, F.lit(False))


def truncate(x: Column | str, n: int) -> Column:
    return F.when(F.length(_c(x)) > n, F.substring(_c(x), 1, n)).otherwise(_c(x))


def key_hash(*parts: Column | str) -> Column:
    """SHA-256 of the parts joined by two bars (nulls are skipped)."""
    return F.sha2(F.concat_ws("||", *(_c(p).cast("string") for p in parts)), 256)


CLEAN_STEPS = ("nul", "replacement", "nbsp", "amp", "tags", "spaces", "trim")


def clean(x: Column | str, steps: tuple[str, ...] = CLEAN_STEPS) -> Column:
    """The cleaning steps in this fixed order; each can be left out."""
    out = _c(x)
    if "nul" in steps:
        out = F.replace(out, F.lit("\0"), F.lit(" "))
    if "replacement" in steps:
        out = F.replace(out, F.lit("�"), F.lit(" "))
    if "nbsp" in steps:
        out = F.regexp_replace(out, "&nbsp;|&#160;", " ")
    if "amp" in steps:
        out = F.replace(out, F.lit("&amp;"), F.lit("&"))
    if "tags" in steps:
        out = F.regexp_replace(out, "<[^>]+>", " ")
    if "spaces" in steps:
        out = F.regexp_replace(out, WS + "+", " ")
    return F.trim(out) if "trim" in steps else out


def lang_code(x: Column | str) -> Column:
    return F.lower(F.replace(_c(x), F.lit("_"), F.lit("-")))


def resolve_lang(own: Column | str, metadata: Column | str, default: str) -> Column:
    """The row's language, else that of its metadata (JSON), else the default; blanks count as missing."""
    other = F.get_json_object(_c(metadata), "$.lang")
    return F.when(non_empty(own), _c(own)).when(non_empty(other), other).otherwise(default)


def fill(template: Column | str, **values: Column | str) -> Column:
    """Replaces {{name}} by each value in turn; later names are also replaced inside earlier values."""
    out = F.lit(template) if isinstance(template, str) else template
    for name, value in values.items():
        out = F.replace(out, F.lit("{{" + name + "}}"), _c(value))
    return out


def excerpt(x: Column | str, n: int = 500) -> Column:
    return F.substring(ws_ascii(F.coalesce(_c(x), F.lit(""))), 1, n)


def preview(x: Column | str, n: int = 280) -> Column:
    """Collapsed text; if longer than n, cut at the last space of the first n + 1 characters and dotted."""
    flat = ws_ascii(x)
    head = F.substring(flat, 1, n + 1)
    at_space = F.regexp_extract(head, "(?s)^(.*) [^ ]*$", 1)
    return F.when(F.length(flat) <= n, flat).otherwise(F.concat(F.when(head.contains(" "), at_space).otherwise(F.substring(flat, 1, n)), F.lit("...")))


def compact(x: Column | str, n: int) -> Column:
    flat = ws_ascii(F.coalesce(_c(x), F.lit("")))
    return F.when(F.length(flat) <= n, flat).otherwise(F.concat(F.rtrim(F.substring(flat, 1, n - 3)), F.lit("...")))


def normalize_url(x: Column | str) -> Column:
    """Lower scheme and host, no fragment, no trailing slash (path at least /), query parameters sorted."""
    url = F.regexp_replace(F.trim(_c(x)), "#.*$", "")
    scheme, host = F.lower(F.regexp_extract(url, "^([A-Za-z][A-Za-z0-9+.-]*)://", 1)), F.lower(F.regexp_extract(url, "^[^:/?]+://([^/?]*)", 1))
    path = F.regexp_replace(F.regexp_extract(url, "^[^:/?]+://[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(url, "\\?(.*)$", 1)
    ordered = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: p != "")), "&")
    return F.concat(scheme, F.lit("://"), host, F.when(path == "", "/").otherwise(path), F.when(ordered != "", F.concat(F.lit("?"), ordered)).otherwise(""))


def url_host(x: Column | str) -> Column:
    return F.lower(F.regexp_extract(_c(x), "^[^:/?#]+://([^/?#:]*)", 1))


def doc_key(source: Column | str, url: Column | str) -> Column:
    """The first 24 hex digits of SHA-256 of source|url."""
    return F.substring(F.sha2(F.concat(_c(source), F.lit("|"), _c(url)), 256), 1, 24)


def safe_part(x: Column | str) -> Column:
    part = F.regexp_replace(F.regexp_replace(F.lower(F.trim(F.coalesce(_c(x), F.lit("")))), "[^a-z0-9._-]+", "-"), "^-+|-+$", "")
    return F.when(part == "", "unknown").otherwise(part)


def object_key(kind: str, day: Column | str, source: Column | str, doc: Column | str, suffix: str = ".json") -> Column:
    """kind/yyyy/MM/dd/source/doc.json with safe parts."""
    return F.concat(F.lit(kind + "/"), F.date_format(_c(day), "yyyy/MM/dd"), F.lit("/"), safe_part(source), F.lit("/"), safe_part(doc), F.lit(suffix))


@F.pandas_udf(T.StringType())
def ascii_fold(texts: pd.Series) -> pd.Series:
    """đ to d, combining marks dropped, case folded (no built-in function decomposes characters)."""

    def fold(t):
        if t is None:
            return None
        parts = unicodedata.normalize("NFD", t.replace("đ", "d").replace("Đ", "D"))
        return "".join(c for c in parts if unicodedata.category(c) != "Mn").casefold()

    return texts.map(fold)


@F.pandas_udf(T.StringType())
def nfkc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def answer_form(x: Column | str, compatibility: bool = False) -> Column:
    """Lower-cased, punctuation to spaces, collapsed: for comparing answers. compatibility: NFKC first (Python)."""
    base = nfkc(_c(x)) if compatibility else _c(x)
    return ws_unicode(F.regexp_replace(F.lower(F.coalesce(base, F.lit(""))), r"[^\p{L}\p{M}\p{N}_\s]", " "))


def answer_tokens(x: Column | str) -> Column:
    return F.filter(F.split(answer_form(x), " "), lambda t: t != "")


def fuzzy_query(x: Column | str) -> Column:
    """The tokens joined by OR; tokens of 4 and more characters that aren't numbers are fuzzy (~1); none: *."""
    tokens = F.filter(F.regexp_extract_all(F.lower(_c(x)), F.lit(r"[\p{L}\p{N}_]+"), 0), lambda t: t != "")
    terms = F.transform(tokens, lambda t: F.when((F.length(t) >= 4) & ~t.rlike("^[0-9]+$"), F.concat(t, F.lit("~1"))).otherwise(t))
    return F.when(F.size(tokens) > 0, F.array_join(terms, " OR ")).otherwise("*")


def split_list(x: Column | str, separator: str = "<SEP>") -> Column:
    """Trimmed non-empty parts."""
    parts = F.split(F.coalesce(_c(x), F.lit("")), "\\Q" + separator + "\\E", -1)
    return F.filter(F.transform(parts, lambda p: F.trim(p)), lambda p: p != "")


def html_title(html: Column | str, url: Column | str) -> Column:
    """The title, else the first h1, else the URL."""
    inside = lambda tag: clean(F.regexp_extract(_c(html), f"(?is)<{tag}[^>]*>(.*?)</{tag}>", 1))
    return F.when(inside("title") != "", inside("title")).when(inside("h1") != "", inside("h1")).otherwise(_c(url))


def html_text(html: Column | str) -> Column:
    """The body's text without scripts, styles, comments and tags."""
    body = F.regexp_replace(_c(html), "(?is)<head[^>]*>.*?</head>|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->", " ")
    return clean(body)


def html_links(html: Column | str) -> Column:
    """The distinct href values in order of first appearance."""
    return F.array_distinct(F.regexp_extract_all(_c(html), F.lit("(?i)<a[^>]*\\shref=\"([^\"#]*)"), 1))


def absolute_url(link: Column | str, base: Column | str) -> Column:
    """A link seen on the page `base`: absolute, rooted, or relative to the page's folder."""
    link, root = _c(link), F.regexp_extract(_c(base), "^([^:/?#]+://[^/?#]*)", 1)
    folder = F.regexp_extract(F.regexp_replace(_c(base), "[?#].*$", ""), "^[^:/]+://[^/]*(/.*/|/)", 1)
    return (
        F.when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(F.regexp_extract(_c(base), "^([^:/?#]+:)", 1), link))
        .when(link.startswith("/"), F.concat(root, link))
        .otherwise(F.concat(root, F.when(folder == "", "/").otherwise(folder), link))
    )


ASSETS = "css js png jpg jpeg gif svg ico webp mp4 mp3 zip rar woff woff2 ttf".split()


def url_class(url: Column | str, domains: list[str], deny: list[str] = (), pdf: str = r"\.pdf($|\?)") -> Column:
    """html, pdf or dropped: other schemes and hosts, assets and denied patterns are dropped."""
    u, host = _c(url), url_host(url)
    allowed = F.lit(False)
    for d in domains:
        allowed = allowed | (host == d) | host.endswith("." + d)
    denied = F.lit(False)
    for p in deny:
        denied = denied | u.rlike(p)
    asset = F.lower(F.regexp_replace(u, "[?#].*$", "")).rlike("\\.(" + "|".join(ASSETS) + ")$")
    keep = u.rlike("(?i)^https?://") & allowed & ~denied & ~asset
    return F.when(~keep, "dropped").when(F.lower(u).rlike(pdf), "pdf").otherwise("html")
