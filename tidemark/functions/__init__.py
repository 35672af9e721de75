from tidemark.functions.clean import (
    LATITUDE_BOUNDS,
    LONGITUDE_BOUNDS,
    clean_phone,
    clean_url,
    date_of,
    fill_default,
    first_non_null,
    full_address,
    valid_coord,
    valid_latitude,
    valid_longitude,
)
from tidemark.functions.sanitize import NO_VALUE, sanitize

__all__ = [
    "LATITUDE_BOUNDS", "LONGITUDE_BOUNDS", "NO_VALUE", "clean_phone", "clean_url",
    "date_of", "fill_default", "first_non_null", "full_address", "sanitize",
    "valid_coord", "valid_latitude", "valid_longitude",
]
