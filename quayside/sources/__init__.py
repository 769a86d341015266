"""Where tables are read from."""

from quayside.sources.files import ParquetSource
from quayside.sources.frames import FrameSource
from quayside.sources.jdbc import JdbcSource

__all__ = ["FrameSource", "JdbcSource", "ParquetSource"]
