"""URL functions: canonical keys, tokens, parts and kinds."""

from __future__ import annotations

from urllib.parse import urljoin, urlsplit

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.functions.text import clean_punctuation, strip

IMAGE_EXTENSIONS = ("jpg", "jpeg", "png", "tif", "tiff", "gif", "svg", "webp", "bmp", "ico")
INLINE = "hash:"


def is_inline(url: Column) -> Column:
    return url.startswith(INLINE)


def url_tokens(url: Column) -> Column:
    return F.when(is_inline(url), F.lit("")).otherwise(clean_punctuation(url))


def decoded_url_tokens(url: Column) -> Column:
    """Tokens after percent-decoding; a URL with a bad escape is taken as it is."""
    return url_tokens(F.coalesce(F.try_url_decode(url), url))


def with_scheme(url: Column) -> Column:
    return F.when(url.startswith("http"), url).otherwise(F.concat(F.lit("http://"), url))


def protocol(url: Column) -> Column:
    return F.regexp_extract(url, "^([A-Za-z][A-Za-z0-9+.-]*):", 1)


def host(url: Column) -> Column:
    return F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)


def path(url: Column) -> Column:
    return F.regexp_extract(url, "^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)


def links_to_image(url: Column) -> Column:
    return F.lower(F.regexp_extract(path(url), r"\.([^./\\]*)$", 1)).isin(*IMAGE_EXTENSIONS)


def image_filename(url: Column) -> Column:
    """Base name of the path without its last extension, as tokens; null if there is none."""
    base = F.regexp_replace(F.regexp_extract(path(url), r"([^/\\]*)$", 1), r"\.[^.]*$", "")
    return F.when(is_inline(url), F.lit(None)).otherwise(F.nullif(clean_punctuation(base), F.lit("")))


def too_long(url: Column, most: int = 10_000) -> Column:
    return F.length(url) > most


def to_surt(url: Column) -> Column:
    """Canonical key: host labels reversed in parentheses, then the path; non-ASCII percent-encoded in lower case.

    Letters of the path, ports and the order of a query stay as they are.
    """
    bare = F.regexp_replace(F.regexp_replace(url, "^(//|https://|http://)", ""), "^(www[.]|ww2[.]|ww3[.])", "")
    name = F.lower(F.regexp_extract(bare, "^([^/?#:]*)", 1))
    rest = F.regexp_extract(bare, "(?s)^[^/?#:]*(.*)$", 1)
    port = F.regexp_extract(rest, "^(:[0-9]+)", 1)
    rest = F.regexp_replace(F.substring(rest, F.length(port) + 1, F.length(rest)), "#.*$", "")
    rest = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    key = F.concat(F.lit("("), F.array_join(F.reverse(F.split(name, "[.]")), ","), F.lit(","), F.regexp_replace(port, "^:", ":"), F.lit(")"), _escaped(rest))
    return F.when(url.startswith("data:") | is_inline(url) | (strip(bare) == ""), url).otherwise(key)


def _escaped(c: Column) -> Column:
    chars = F.split(c, "")
    one = lambda x: F.when(x.rlike("^[\\x00-\\x7f]*$"), x).otherwise(F.regexp_replace(F.lower(F.hex(F.encode(x, "UTF-8"))), "(..)", "%$1"))
    return F.when(c.rlike("[^\\x00-\\x7f]"), F.array_join(F.transform(chars, one), "")).otherwise(c)


def resolve(base: str, relative: str) -> str:
    """Absolute URL; '' if it can't be made or its scheme isn't one of the web."""
    try:
        out = urljoin(base, relative.strip())
        return out if urlsplit(out).scheme in ("http", "https", "ftp", "file", "jar") else ""
    except ValueError:
        return ""
