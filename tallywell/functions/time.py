from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_timestamp(moment: datetime | str | None) -> Column:
    """A literal timestamp; now, read once on the driver, when none is given.

    Text without an offset is read in the session time zone, as in the messages.
    """
    if moment is None:
        moment = datetime.now(timezone.utc)
    if isinstance(moment, datetime):
        if moment.tzinfo is None:
            raise ValueError("a run time needs a time zone")
        moment = moment.isoformat()
    return F.lit(moment).cast("timestamp")
