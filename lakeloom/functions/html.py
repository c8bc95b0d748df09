"""Links of a web page, read in one regular-expression pass.

The pattern walks a page the way an HTML tokenizer does: comments, CDATA,
declarations, end tags, the text of scripts and style sheets and the quoted
attribute values of other tags are consumed whole, so an ``<a`` inside any of
them is never taken for a link. Only an ``<a>`` tag fills the group, with the
value of its last ``href``. All loops are possessive and whatever starts like
markup matches, if need be up to the end of the page: no page can make the match
back-track, start over or overflow the stack.

Differences from a full parser: a tag that never closes is no tag, text areas
and titles are not treated specially, and NUL characters stay.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import apply_sql, let, literal, literal_map
from .urls import RESOLVE, base_sql

_S = r"[\t\n\f\r ]"
_GAP = r"[\t\n\f\r /]"
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\t\n\f\r "'>][^\t\n\f\r >]*+)?+"""
_NAME = r"[^\t\n\f\r />][^\t\n\f\r />=]*+"
_ATTRIBUTE = rf"{_NAME}(?:{_S}*+={_S}*+{_VALUE})?+"
# At the end of the page the group is emptied: an unclosed tag is no link.
_HREF = rf"(?:[hH][rR][eE][fF]{_S}*+={_S}*+|\z)({_VALUE})"
_CLOSE = rf"{_GAP}*+(?:>|\z)"

# One leading '<' for all alternatives: plain text fails on a single comparison.
LINK_PATTERN = "".join(
    (
        r"(?s)<(?:!--(?:-?>|.*?(?:--!?>|\z))",
        r"|!\[(?i:cdata)\[.*?(?:\]\]>|\z)",
        r"|[!?/][^>]*+(?:>|\z)",
        rf"|[aA]{_GAP}(?:{_GAP}*+(?:{_HREF}|{_ATTRIBUTE}))*+{_CLOSE}",
        r"|(?i:script)[\t\n\f\r />].*?(?:</(?i:script)[\t\n\f\r />]|\z)",
        r"|(?i:style)[\t\n\f\r />].*?(?:</(?i:style)[\t\n\f\r />]|\z)",
        rf"|[a-zA-Z][^\t\n\f\r />]*+(?:{_GAP}*+{_ATTRIBUTE})*+{_CLOSE})",
    )
)

# Character references: named ones come from Python's own HTML5 table, those
# with ';' and the older ones that also stand without it.
_NAMED = dict(html5)
# Numbers 0x80-0x9F mean Windows-1252 characters.
_CP1252 = {
    str(n): bytes([n]).decode("cp1252", "ignore")
    for n in range(0x80, 0xA0)
    if bytes([n]).decode("cp1252", "ignore")
}
_TOKEN = r"&#[0-9]+;?|&#[xX][0-9a-fA-F]+;?|&[A-Za-z][A-Za-z0-9]*[;=]?|[^&]+|&"

# Text of the code point n; one that does not exist becomes U+FFFD.
_CHARACTER = f"""
coalesce(
  try_element_at({literal_map(_CP1252)}, cast(n AS string)),
  decode(unhex(lpad(hex(CASE WHEN n BETWEEN 1 AND 55295 OR n BETWEEN 57344 AND 1114111
                             THEN n ELSE 65533 END), 8, '0')), 'UTF-32'))"""

_DIGITS = "regexp_extract(t, '^&#[xX]?([0-9a-fA-F]+)', 1)"
_NUMBER = f"""
CASE WHEN length({_DIGITS}) > 9 THEN 2147483647
     ELSE cast(conv({_DIGITS}, CASE WHEN t RLIKE '^&#[xX]' THEN 16 ELSE 10 END, 10) AS bigint)
END"""

# As in browsers, a named reference without its ';' that a letter, digit or '='
# follows is plain text (?a=1&copy=2).
_UNESCAPE = f"""
CASE WHEN NOT contains(v, '&') THEN v ELSE array_join(
  transform(regexp_extract_all(v, {literal(_TOKEN)}, 0), t ->
    CASE WHEN NOT startswith(t, '&') OR endswith(t, '=') OR t = '&' THEN t
         WHEN t = '&amp;' THEN '&'
         WHEN startswith(t, '&#') THEN {let("n", _NUMBER, _CHARACTER)}
         ELSE coalesce(try_element_at({literal_map(_NAMED)}, substr(t, 2)), t)
    END), '') END"""

_UNQUOTE = "CASE WHEN r RLIKE '^[\"\\']' THEN substr(r, 2, length(r) - 2) ELSE r END"

_LINKS = f"""
transform(
  filter(regexp_extract_all(x.html, {literal(LINK_PATTERN)}, 1), r -> r <> ''),
  (r, i) -> named_struct('link_pos', cast(i AS bigint), 'href', {let("v", _UNQUOTE, _UNESCAPE)}))"""

# The base of the page is taken apart once, whatever the number of its links.
_FILE = f"""
named_struct('link_pos', l.link_pos, 'href', l.href, 'file_url', {let("href", "l.href", RESOLVE)})"""


def _links(suffix: str | None) -> str:
    """SQL for the links, all or those with an ending, before anything becomes a row."""
    if suffix is None:
        return _LINKS
    return f"filter({_LINKS}, l -> l.href <> '' AND endswith(l.href, {literal(suffix)}))"


def unescape_attribute(value: Column) -> Column:
    """Replace the character references of an attribute value."""
    return apply_sql(let("v", "x.value", _UNESCAPE), value=value)


def page_links(html: Column, suffix: str | None = None) -> Column:
    """Every link of a page: an array of ``(link_pos, href)`` in document order.

    With ``suffix`` only links ending in it are kept. The test is case-sensitive
    and sees query and fragment.
    """
    return apply_sql(_links(suffix), html=html)


def page_files(html: Column, url: Column, suffix: str | None = None) -> Column:
    """Like :func:`page_links`, with the absolute ``file_url`` of each link."""
    files = f"transform({_links(suffix)}, l -> {_FILE})"
    return apply_sql(let("base", base_sql("x.url"), files), html=html, url=url)
