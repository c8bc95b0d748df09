from . import landing, layers, scalars, settings  # noqa: F401  (registers the queries)
from .catalog import QUERIES, SQL  # noqa: F401
