"""Column-level functions (pure expressions, stay inside whole-stage codegen)."""

from skein.functions.geo import EARTH_RADIUS_KM, great_circle_km
from skein.functions.text import field_or_null, split_fields

__all__ = ["EARTH_RADIUS_KM", "great_circle_km", "field_or_null", "split_fields"]
