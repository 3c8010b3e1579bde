"""Column functions: each takes columns (or names) and returns a Column."""

from regweave.functions.text import (
    blank_to_null,
    composite_key,
    digits_only,
    phone_number,
)

__all__ = ["blank_to_null", "composite_key", "digits_only", "phone_number"]
