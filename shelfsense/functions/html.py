"""URL and HTML handling as column expressions."""

from __future__ import annotations

import json
from collections.abc import Callable
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfsense.functions.text import SPACE

# Patterns of the URL and HTML syntax.
SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
SCHEME_AND_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/]*)?"
QUERY_OR_FRAGMENT = r"(?s)[?#].*$"
HIDDEN_ELEMENTS = (
    r"(?is)<script\b.*?</script\s*>",
    r"(?is)<style\b.*?</style\s*>",
    r"(?is)<template\b.*?</template\s*>",
    r"(?s)<!--.*?-->",
)
# A tag ends at the first > outside a quoted value; without a closing quote, at the first >.
INSIDE_TAG = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+>"""
TAG = r"(?s)<[/!?A-Za-z]" + INSIDE_TAG
BREAK = "\x01"
BREAK_RUN = f"[{SPACE}]*\x01[{SPACE}\x01]*"
OUTER_SPACE = f"^[{SPACE}]+|[{SPACE}]+$"
TITLE = r"(?is)<title\b" + INSIDE_TAG + "(.*?)</title"
ANCHOR_TAG = r"(?is)<a[\s/]" + INSIDE_TAG
VALUE = r"""("[^"]*"|'[^']*'|[^\s>]*)"""
OTHER_ATTRIBUTE = r"""[\s/]*+(?!href[\s=])[^\s=>/]++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?+"""
HREF = rf"(?is)^<a(?:{OTHER_ATTRIBUTE})*+[\s/]*+href\s*+=\s*+{VALUE}"
# Old names count without a semicolon; of those the longest is meant.
OLD_NAMES = sorted((name for name in html5 if not name.endswith(";")), key=lambda name: (-len(name), name))
OLD_NAME = "&(" + "|".join(OLD_NAMES) + ")"
ENTITY = "(?:&#[0-9]+;?|&#[xX][0-9a-fA-F]+;?|&[A-Za-z][A-Za-z0-9]*;|" + OLD_NAME.replace("(", "(?:") + ")"
REPLACEMENT = "\ufffd"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(text: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(text, OUTER_SPACE, "")


def canonical_url(url: Column) -> Column:
    """URL without query, fragment and closing slashes; the path is at least `/`."""
    return bind(F.regexp_replace(strip(url), QUERY_OR_FRAGMENT, ""), _without_closing_slashes)


def _without_closing_slashes(bare: Column) -> Column:
    head = F.regexp_extract(bare, SCHEME_AND_AUTHORITY, 0)
    scheme = F.regexp_extract(bare, SCHEME, 0)
    authority = F.substring(head, F.length(scheme) + 1, F.length(head))
    path = F.regexp_replace(F.substring(bare, F.length(head) + 1, F.length(bare)), "/+$", "")
    return F.concat(F.lower(scheme), authority, F.when(path == "", "/").otherwise(path))


def url_host(url: Column) -> Column:
    """Network location, with the port if there is one."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)


def _without_dot_segments(path: Column) -> Column:
    """Resolve `.` and `..` in an absolute path; `..` above the root is dropped."""
    def step(done: Column, segment: Column) -> Column:
        shorter = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return (
            F.when(segment == "..", shorter)
            .when(segment == ".", done)
            .otherwise(F.concat(done, F.array(segment)))
        )

    segments = F.split(F.substring(path, F.lit(2), F.length(path)), "/")
    clean = F.aggregate(segments, F.array().cast("array<string>"), step)
    return F.when(path.contains("/."), F.concat(F.lit("/"), F.array_join(clean, "/"))).otherwise(path)


def resolve_url(base: Column, link: Column) -> Column:
    """Absolute, canonical form of a link found on the page with the canonical URL `base`."""
    def absolute(bare: Column) -> Column:
        site = F.regexp_extract(base, SCHEME_AND_AUTHORITY, 0)
        base_path = F.substring(base, F.length(site) + 1, F.length(base))
        merged = F.regexp_replace(F.concat(F.regexp_replace(base_path, "[^/]*$", ""), bare), "/+", "/")
        return (
            F.when(bare.rlike(SCHEME), bare)
            .when(bare == "", base)
            .when(bare.startswith("//"), F.concat(F.regexp_extract(base, SCHEME, 0), bare))
            .when(bare.startswith("/"), F.concat(site, bind(bare, _without_dot_segments)))
            .otherwise(F.concat(site, bind(merged, _without_dot_segments)))
        )

    return canonical_url(bind(F.regexp_replace(strip(link), QUERY_OR_FRAGMENT, ""), absolute))


def _code_point(digits: Column, base: int) -> Column:
    """Character of a numeric reference. What is no character becomes U+FFFD; 128 to 159 are read as Windows-1252."""
    number = F.conv(digits, base, 10).cast("decimal(20,0)")
    wrong = (number == 0) | number.between(0xD800, 0xDFFF) | (number > 0x10FFFF)
    old = [bytes([code]).decode("cp1252", "replace") for code in range(128, 160)]
    return (
        F.when(wrong | number.isNull(), REPLACEMENT)
        .when(number.between(128, 159), F.element_at(F.array(*map(F.lit, old)), (number - 127).cast("int")))
        .otherwise(F.decode(F.unhex(F.lpad(F.conv(digits, base, 16), 8, "0")), "UTF-32"))
    )


def unescape(text: Column) -> Column:
    """Replace named and numeric character references, each once: what a reference gives is not read again.

    An unknown name that begins with an old one keeps its rest, as browsers read it.
    """
    names = {f"&{name}": value for name, value in html5.items()}
    named = F.from_json(F.lit(json.dumps(names)), "map<string,string>")

    def replacement(entity: Column) -> Column:
        decimal = F.regexp_extract(entity, "^&#([0-9]+);?$", 1)
        hexadecimal = F.regexp_extract(entity, "^&#[xX]([0-9a-fA-F]+);?$", 1)
        known = F.try_element_at(named, entity)
        old = F.regexp_extract(entity, "^" + OLD_NAME, 0)
        return (
            F.when(decimal != "", _code_point(decimal, 10))
            .when(hexadecimal != "", _code_point(hexadecimal, 16))
            .when(known.isNotNull(), known)
            .when(old != "", F.concat(F.try_element_at(named, old), F.substring(entity, F.length(old) + 1, F.length(entity))))
            .otherwise(entity)
        )

    def replaced(text: Column) -> Column:
        found = F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))
        between = F.split(text, ENTITY, -1)
        given = F.concat(F.array(F.lit("")), F.transform(found, replacement))
        return F.array_join(F.zip_with(given, between, lambda one, rest: F.concat(one, rest)), "")

    return bind(text, lambda bound: F.when(bound.contains("&"), replaced(bound)).otherwise(bound))


def without_hidden(html: Column) -> Column:
    """Markup without scripts, styles, templates and comments."""
    for pattern in HIDDEN_ELEMENTS:
        html = F.regexp_replace(html, pattern, BREAK)
    return html


def visible_text(html: Column) -> Column:
    """Text of a page: no scripts, styles, comments; pieces between tags joined by one blank."""
    text = unescape(F.regexp_replace(without_hidden(html), TAG, BREAK))
    return strip(F.regexp_replace(text, BREAK_RUN, " "))


def page_title(html: Column, url: Column) -> Column:
    """Title of a page, or its URL where there is none."""
    title = unescape(F.regexp_extract(without_hidden(html), TITLE, 1))
    return F.when(title != "", title).otherwise(url)


def page_links(html: Column) -> Column:
    """The href of every anchor, in page order, as written."""
    anchors = F.regexp_extract_all(without_hidden(html), F.lit(ANCHOR_TAG), F.lit(0))
    return F.filter(F.transform(anchors, lambda tag: F.regexp_extract(tag, HREF, 1)), lambda href: href != "")


def unquote_link(link: Column) -> Column:
    """Drop the quotes around an href value and resolve its character references."""
    return unescape(F.regexp_replace(link, r"""^["']|["']$""", ""))
