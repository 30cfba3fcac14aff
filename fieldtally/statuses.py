"""Status values of an assignment and the order of their columns."""

from __future__ import annotations

from collections.abc import Iterable

# The statuses that reports always show, in their order.
STATUSES = [
    "DRAFT",
    "OPEN",
    "SUBMITTED RESPONDENT",
    "SUBMITTED BY Pencacah",
    "APPROVED BY Pengawas",
    "REJECTED BY Pengawas",
    "REVOKED BY Pengawas",
    "COMPLETED BY Admin Kabupaten",
    "EDITED BY Admin Kabupaten",
    "EDITED BY Pengawas",
    "REJECTED BY Admin Kabupaten",
    "REVOKED BY Admin Kabupaten",
]


def columns(found: Iterable[str | None] = ()) -> list[str]:
    """The fixed statuses, then the others that were found, in order of their code units."""
    extra = {s for s in found if s} - set(STATUSES)
    return [*STATUSES, *sorted(extra, key=lambda s: s.encode("utf-16-be"))]
