from . import builtin  # noqa: F401  (registers the built-in sources)
from .registry import SOURCES, SourceSpec, candidates, source  # noqa: F401
