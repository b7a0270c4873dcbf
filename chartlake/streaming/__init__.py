from .dimensions import read_dimension, start_dimension_stream
from .staging import start_staging_stream

__all__ = ["read_dimension", "start_dimension_stream", "start_staging_stream"]
