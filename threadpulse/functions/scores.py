"""Popularity weights in integer cents, so that sums are exact and order-free."""

from __future__ import annotations

# 0.3 per like, 10 % more on an editor's selection, 0.7 per reply.
LIKE_CENTS = 30
SELECTED_LIKE_CENTS = 33
REPLY_CENTS = "70L"

LIKE_CENTS_SQL = (
    f"CAST(recommendations AS BIGINT)"
    f" * CASE WHEN editors_selection THEN {SELECTED_LIKE_CENTS} ELSE {LIKE_CENTS} END"
)
