"""Column expressions: JVM-side, codegen-friendly, ANSI-safe."""

from starbuild.functions.casts import safe_cast, to_int_truncated
from starbuild.functions.dates import (
    EPOCH_1960,
    calendar_parts,
    epoch_days_to_date,
    pattern_to_date,
)
from starbuild.functions.strings import normalize_name, split_part

__all__ = [
    "EPOCH_1960",
    "calendar_parts",
    "epoch_days_to_date",
    "normalize_name",
    "pattern_to_date",
    "safe_cast",
    "split_part",
    "to_int_truncated",
]
