"""Content type of a key, by its file extension."""

from __future__ import annotations

import mimetypes

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import literal_map

# Fixed value: the type of everything unknown.
DEFAULT_TYPE = "application/octet-stream"

_REGISTRY = mimetypes.MimeTypes()

# Extension -> type, as Python's own registry lists them (no machine's files).
EXTENSION_TYPES: dict[str, str] = dict(_REGISTRY.types_map[1])
# Extensions that only say how a file is packed; the type is that of what is in it.
ENCODINGS = list(_REGISTRY.encodings_map)
# ``.tgz`` stands for ``.tar.gz`` and so on: extension -> extension of the content.
SHORTHANDS = {short: "." + full.split(".")[1] for short, full in _REGISTRY.suffix_map.items()}

# Last ``.xyz`` of the file name; a leading dot does not start one.
_EXTENSION = r"[^/.][^/]*(\.[^/.]*)\z"


def _extension(key: Column) -> Column:
    return F.regexp_extract(key, _EXTENSION, 1)


def _looked_up(table: dict[str, str], c: Column) -> Column:
    """The value of a constant map, or NULL. Only keys of the same length are compared."""
    by_length: dict[int, dict[str, str]] = {}
    for key, value in table.items():
        by_length.setdefault(len(key), {})[key] = value
    found = F.lit(None).cast("string")
    for n, part in sorted(by_length.items(), key=lambda item: len(item[1])):
        found = F.when(F.length(c) == n, F.try_element_at(F.expr(literal_map(part)), c)).otherwise(found)
    return found


def content_type(key: Column, table: dict[str, str] | None = None) -> Column:
    """Type of a key by its extension, looked up in ``table`` or the usual one."""
    last = _extension(key)
    before = _extension(F.substr(key, F.lit(1), F.length(key) - F.length(last)))
    short = F.coalesce(_looked_up(SHORTHANDS, F.lower(last)), last)
    inner = F.when(last.isin(ENCODINGS), before).otherwise(short)
    return F.coalesce(_looked_up(table or EXTENSION_TYPES, F.lower(inner)), F.lit(DEFAULT_TYPE))
