"""Sources: the supplied tables, the fixture derivations, and message topics."""

from tidemill.sources.fixtures import ip_dim, raw_messages, raw_order
from tidemill.sources.tables import load_table
from tidemill.sources.topics import read_topic, write_topic

__all__ = ["ip_dim", "load_table", "raw_messages", "raw_order", "read_topic", "write_topic"]
