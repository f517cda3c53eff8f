"""Support tickets: display columns and chosen custom fields."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanops.functions.rules import value_by_id

# Display names of the ticket columns.
TICKET_DISPLAY = {
    "id": "Ticket ID",
    "status": "Ticket Status",
    "subject": "Subject",
    "type": "Type",
    "requester_id": "Requester",
    "assignee_id": "Assignee",
    "tags": "Tags",
}


def tickets(frame: DataFrame, custom_fields: Mapping[int, str], display: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """The shown columns, one column per custom field id (the value of its first entry, or null), and ``keep``."""
    extra = [value_by_id(F.col("custom_fields"), field).alias(name) for field, name in custom_fields.items()]
    names = {c: (name if display else c) for c, name in TICKET_DISPLAY.items()}
    return frame.select(*[F.col(c).alias(name) for c, name in names.items()], *extra, *keep)
