"""URL lists, dataset names, link resolution and object keys as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import CONTROL_OR_SPACE, apply_sql, let, literal, null_if_empty, strip

# The dataset-page pattern, the archive ending and the longest
# URL that counts as valid.
DATASET_PATTERN = r"kaggle\.com/datasets/([^/]+/[^/]+)"
ARCHIVE_SUFFIX = ".zip"
MAX_URL_LENGTH = 2083

# ---- lists -------------------------------------------------------------------


def parse_url_list(c: Column) -> Column:
    """``'a, b,,c'`` -> ``['a', 'b', 'c']``; order and duplicates stay."""
    return F.filter(F.transform(F.split(c, ","), strip), lambda url: url != "")


def join_url_list(urls: Column) -> Column:
    """The reverse of :func:`parse_url_list` for a list in one row."""
    return F.array_join(urls, ",")


def second_or_first(urls: Column) -> Column:
    """The second element, else the first, else NULL."""
    return F.coalesce(F.try_element_at(urls, F.lit(2)), F.try_element_at(urls, F.lit(1)))


# ---- dataset names -----------------------------------------------------------


def dataset_slug(url: Column) -> Column:
    """``owner/name`` of a dataset page, NULL for any other URL."""
    return null_if_empty(F.regexp_extract(url, DATASET_PATTERN, 1))


def archive_name(slug: Column) -> Column:
    """File name an archive lands under. ``a_b/c`` and ``a/b_c`` share one name."""
    return F.concat(F.replace(slug, F.lit("/"), F.lit("_")), F.lit(ARCHIVE_SUFFIX))


def download_name(slug: Column) -> Column:
    """File name the hosting site gives the archive."""
    return F.concat(F.substring_index(slug, "/", -1), F.lit(ARCHIVE_SUFFIX))


# ---- keys --------------------------------------------------------------------


def basename(path: Column) -> Column:
    """What follows the last ``/``, query and fragment included."""
    return F.substring_index(path, "/", -1)


def target_key(destination: Column, name: Column) -> Column:
    """Path join: a rooted name replaces the destination, no ``/`` is doubled."""
    bare = F.startswith(name, F.lit("/")) | (destination == "")
    closed = F.endswith(destination, F.lit("/"))
    return (
        F.when(bare, name)
        .when(closed, F.concat(destination, name))
        .otherwise(F.concat(destination, F.lit("/"), name))
    )


# ---- resolution --------------------------------------------------------------

# RFC 3986, appendix B: scheme, authority, path, query, fragment.
_URL = (
    r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?"
    r"([^?#]*)(?:\?([^#]*))?(?:#(.*))?\z"
)


def _parts(pattern: str, groups: int, text: str) -> str:
    """The groups of ``pattern`` as an array, from one match.

    Line breaks separate them: ``text`` must hold none.
    """
    marks = "\n".join(f"${i}" for i in range(1, groups + 1))
    return f"split(regexp_replace({text}, {literal(pattern)}, {literal(marks)}), '\\n')"


def _split(url: str) -> str:
    """Scheme, host, path, query and fragment of a URL as lenient parsers see it."""
    text = f"translate(trim(LEADING {literal(CONTROL_OR_SPACE)} FROM {url}), '\\t\\r\\n', '')"
    return _parts(_URL, 5, text)


def _no_params(path: str) -> str:
    return f"regexp_replace({path}, ';[^/]*$', '')"


def _params(path: str) -> str:
    return f"regexp_extract({path}, ';([^/]*)$', 1)"


def _rooted(path: str) -> str:
    return f"CASE WHEN startswith({path}, '/') THEN {path} ELSE '/' || {path} END"


def _led(mark: str, part: str) -> str:
    return f"CASE WHEN {part} = '' THEN '' ELSE '{mark}' || {part} END"


_ENDS_IN_DOTS, _HAS_DOTS = literal(r"(^|/)\.\.?\z"), literal(r"(^|/)\.\.?(/|\z)")

# Path p without dot segments: '.' goes, '..' takes back the segment before it.
_FOLDED = f"""
array_join(concat(
  aggregate(split(p, '/'), cast(array() AS array<string>), (done, s) ->
    CASE WHEN s = '..' THEN slice(done, 1, greatest(size(done) - 1, 0))
         WHEN s = '.' THEN done ELSE concat(done, array(s)) END),
  CASE WHEN p RLIKE {_ENDS_IN_DOTS} THEN array('') ELSE cast(array() AS array<string>) END), '/')"""
_WALKED = f"""
CASE WHEN p RLIKE {_HAS_DOTS} THEN {let("f", _FOLDED, _rooted("f"))} ELSE p END"""

# Start of every plain link from the page; NULL if the page's path has dot segments.
_FOLDER = """
CASE WHEN NOT contains(part[2], '/.') THEN lower(part[0]) || '://' || part[1] || regexp_replace(
  '/' || regexp_replace(regexp_replace(part[2], ';[^/]*$', ''), '[^/]*$', ''), '/{2,}', '/') END"""


def base_sql(url: str) -> str:
    """SQL for the parts of a page's URL that links are resolved against."""
    parts = f"""named_struct(
  'url', {url}, 'scheme', lower(part[0]), 'netloc', part[1], 'folder', {_FOLDER},
  'path', {_no_params("part[2]")}, 'params', {_params("part[2]")}, 'query', part[3])"""
    return let("part", _split(url), parts)


# A link's path seen from the page's folder.
_MERGED = f"""
CASE WHEN startswith(path, '/') THEN path
     ELSE regexp_replace('/' || regexp_replace(base.path, '[^/]*$', '') || path, '/{{2,}}', '/')
END"""
_FROM_PAGE = let("p", _MERGED, _WALKED)
_SAME_PAGE = f"""
CASE WHEN base.path = '' THEN '' ELSE {_rooted("base.path")} END
|| {_led(";", "base.params")}
|| CASE WHEN part[3] <> '' THEN '?' || part[3] ELSE {_led("?", "base.query")} END"""
_OTHER_PATH = f"""
CASE WHEN part[1] = '' THEN {_FROM_PAGE}
     WHEN path = '' THEN '' ELSE {_rooted("path")} END
|| {let("params", _params("part[2]"), _led(";", "params"))} || {_led("?", "part[3]")}"""
_RESOLVED = f"""
CASE WHEN contains(part[1], '[') <> contains(part[1], ']') THEN NULL
     WHEN part[0] <> '' AND lower(part[0]) <> base.scheme THEN href
     ELSE base.scheme || '://' || CASE WHEN part[1] = '' THEN base.netloc ELSE part[1] END
          || CASE WHEN part[1] = '' AND part[2] IN ('', ';') THEN {_SAME_PAGE}
                  ELSE {let("path", _no_params("part[2]"), _OTHER_PATH)} END
          || {_led("#", "part[4]")}
END"""

# Most links: a path, rooted or not, without anything that needs a closer look.
_PLAIN = literal(r"^/?[^/?#;:.\x00-\x20][^?#;:\x00-\x20]*\z")

# Whole URLs that come back as written, whatever the page.
_WHOLE = literal(r"^https?://[^/?#;\[\]\x00-\x20]+(/[^?#;\x00-\x20]*)?\z")

# The absolute URL of the link ``href`` on the page whose parts are ``base``.
RESOLVE = f"""
CASE WHEN href = '' THEN base.url
     WHEN href RLIKE {_PLAIN} AND NOT contains(href, '/.') AND NOT contains(href, '//')
          AND base.folder IS NOT NULL
     THEN CASE WHEN startswith(href, '/') THEN base.scheme || '://' || base.netloc
               ELSE base.folder END || href
     WHEN href RLIKE {_WHOLE} THEN href
     ELSE {let("part", _split("href"), _RESOLVED)} END"""


def resolve_url(base: Column, href: Column) -> Column:
    """The absolute URL of a link on the page ``base``, an http(s) URL.

    A link of another scheme comes back as written; a link whose host has an
    unpaired bracket cannot be resolved and gives NULL.
    """
    return apply_sql(
        let("base", base_sql("x.base"), let("href", "x.href", RESOLVE)), base=base, href=href
    )


def resolve_all(base: Column, hrefs: Column) -> Column:
    """:func:`resolve_url` for an array of links of one page, which is taken apart once."""
    each = f"transform(x.hrefs, href -> {RESOLVE})"
    return apply_sql(let("base", base_sql("x.base"), each), base=base, hrefs=hrefs)


# ---- http(s) URLs ------------------------------------------------------------

# Scheme, user, host and port, path, query, fragment, as browsers take them apart.
_HTTP = r"(?is)^(https?):[/\\]*((?:[^/\\?#]*@)?)([^/\\?#@]*)([^?#]*)(\?[^#]*)?(#.*)?\z"
_HOST_PORT = r"(?s)^(\[[0-9A-Fa-f:.]+\]|[^:\[\]]*?)(?::([0-9]*))?\z"
_BAD_HOST = r"[\x00-\x20#/<>?@\\^|%\x7f]"

# What each part holds unescaped, as a character class.
_PATH_SAFE = r"!$-;=@-_a-z|~"
_QUERY_SAFE = r"!$-&(-;=?-~"
_FRAGMENT_SAFE = r"!#-;=?-_a-~"

_HTTP_PARTS = _parts(
    _HTTP, 6, f"translate(trim(BOTH {literal(CONTROL_OR_SPACE)} FROM x.url), '\\t\\r\\n', '')"
)
_HOST = f"regexp_extract(part[2], {literal(_HOST_PORT)}, 1)"
_PORT = f"regexp_extract(part[2], {literal(_HOST_PORT)}, 2)"
_IS_HTTP = f"""
size(part) = 6 AND coalesce(
  {_HOST} <> '' AND NOT {_HOST} RLIKE {literal(_BAD_HOST)}
  AND ({_PORT} = '' OR try_cast({_PORT} AS bigint) <= 65535), false)"""


def _percent(name: str, safe: str) -> str:
    """Percent-encode what is not in the character class ``safe``."""
    unsafe, runs = literal(f"[^{safe}]"), literal(f"[{safe}]+|[^{safe}]+")
    return f"""
CASE WHEN NOT {name} RLIKE {unsafe} THEN {name} ELSE array_join(
  transform(regexp_extract_all({name}, {runs}, 0), run ->
    CASE WHEN run RLIKE {unsafe} THEN regexp_replace(hex(encode(run, 'UTF-8')), '(..)', '%$1')
         ELSE run END), '') END"""


_SHOWN_PORT = """
CASE WHEN port = '' OR port = CASE WHEN lower(part[0]) = 'http' THEN '80' ELSE '443' END THEN ''
     ELSE ':' || port END"""
_SHORT_PORT = f"regexp_replace({_PORT}, '^0+(?=[0-9])', '')"
_CLEAN_PATH = let("p", let("q", "replace(part[3], '\\\\', '/')", _rooted("q")), _WALKED)
_NORMAL = f"""
lower(part[0]) || '://' || part[1] || lower({_HOST}) || {let("port", _SHORT_PORT, _SHOWN_PORT)}
|| {let("path", _CLEAN_PATH, _percent("path", _PATH_SAFE))}
|| {_percent("part[4]", _QUERY_SAFE)} || {_percent("part[5]", _FRAGMENT_SAFE)}"""


def is_http_url(url: Column) -> Column:
    """Whether the text parses as an http or https URL with a host."""
    valid = apply_sql(let("part", _HTTP_PARTS, _IS_HTTP), url=url)
    return F.coalesce((F.length(url) <= MAX_URL_LENGTH) & valid, F.lit(False))


def normalize_http_url(url: Column, longest: int | None = MAX_URL_LENGTH) -> Column:
    """The form a settings record holds a URL in; NULL if it is not http(s) or too long.

    Scheme and host in lower case, default port dropped, empty path ``/``, dot
    segments folded, unsafe characters percent-encoded. Hosts outside ASCII stay
    as written (no punycode).
    """
    normal = apply_sql(let("part", _HTTP_PARTS, f"CASE WHEN {_IS_HTTP} THEN {_NORMAL} END"), url=url)
    return normal if longest is None else F.when(F.length(url) <= longest, normal)
