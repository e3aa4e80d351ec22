from cohortrec.functions.scalars import (
    centered,
    id_items,
    manhattan,
    round_half_up,
    same_truncated,
    two_decimals,
)

__all__ = [
    "centered",
    "id_items",
    "manhattan",
    "round_half_up",
    "same_truncated",
    "two_decimals",
]
