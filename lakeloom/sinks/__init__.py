from . import object_sinks  # noqa: F401  (registers the built-in sinks)
from .layer import Layer, layer_path, layer_root  # noqa: F401
from .registry import SINKS, sink  # noqa: F401
