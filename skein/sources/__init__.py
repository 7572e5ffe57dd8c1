"""Sources: delimited-text readers, lenient line parsing and the test-table views."""

from skein.operators.relational import require_not_null
from skein.sources.delimited import AIRPORTS_SCHEMA, ROUTES_SCHEMA, POINTS_SCHEMA, VIEWS_SCHEMA, read_delimited
from skein.sources.lines import LAYOUTS, parse_lines

__all__ = ["AIRPORTS_SCHEMA", "ROUTES_SCHEMA", "POINTS_SCHEMA", "VIEWS_SCHEMA", "read_delimited",
           "require_not_null", "LAYOUTS", "parse_lines"]
