"""Collections and shared storage."""

from .catalog import Catalog, Collection, ReadOnlyError, schema_for
from .shared import drop_intermediates, materialize, shared_dir, write_version

__all__ = ["Catalog", "Collection", "ReadOnlyError", "drop_intermediates", "materialize", "schema_for", "shared_dir", "write_version"]
