"""One clock for a whole run.

Every date, timestamp and audit string a run writes comes from a single instant, so a run that crosses
midnight, or a driver whose operating system sits in another zone, cannot mix two days. The values reach
the plan as literals, which Catalyst folds.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone as fixed_zone
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

# The zone the business day is counted in, the end date of a version that is still
# open, and the pattern of the audit strings.
BUSINESS_ZONE = "America/Sao_Paulo"
OPEN_END = date(9999, 12, 31)
AUDIT_PATTERN = "%Y-%m-%d %H:%M:%S"

_EPOCH = datetime(1970, 1, 1, tzinfo=fixed_zone.utc)


@dataclass(frozen=True)
class AsOf:
    """The instant a run is computed for, and the zone that turns it into a calendar day."""

    instant: datetime
    zone: str = BUSINESS_ZONE

    def __post_init__(self) -> None:
        if self.instant.tzinfo is None:
            raise ValueError("AsOf needs a zone-aware datetime; use AsOf.at() for wall-clock text")

    @classmethod
    def now(cls, zone: str = BUSINESS_ZONE) -> AsOf:
        return cls(datetime.now(fixed_zone.utc), zone)

    @classmethod
    def at(cls, wall_clock: str, zone: str = BUSINESS_ZONE) -> AsOf:
        """``AsOf.at("2024-05-01")`` or ``AsOf.at("2024-05-01 09:30:00")``, read as local time in ``zone``."""
        return cls(datetime.fromisoformat(wall_clock).replace(tzinfo=ZoneInfo(zone)), zone)

    @property
    def _local(self) -> datetime:
        return self.instant.astimezone(ZoneInfo(self.zone))

    @property
    def day(self) -> date:
        return self._local.date()

    @property
    def audit_text(self) -> str:
        return self._local.strftime(AUDIT_PATTERN)

    def date(self) -> Column:
        return F.lit(self.day)

    def timestamp(self) -> Column:
        # Built from the epoch so that neither the driver's nor the session's zone can shift it.
        return F.timestamp_micros(F.lit((self.instant - _EPOCH) // timedelta(microseconds=1)))

    def audit(self) -> Column:
        return F.lit(self.audit_text)


def open_end() -> Column:
    return F.lit(OPEN_END)
