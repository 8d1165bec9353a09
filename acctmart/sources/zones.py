"""Storage zones per environment."""

from __future__ import annotations

from dataclasses import dataclass

PRODUCTION = "PROD"


@dataclass(frozen=True)
class Zones:
    """Base paths of the four zones a job reads from and writes to."""

    landing: str
    lake: str
    processing: str
    curated: str

    @classmethod
    def under(cls, root: str, environment: str = PRODUCTION) -> Zones:
        """Zones below ``root``; every environment but production has its own suffix."""
        suffix = "" if environment == PRODUCTION else "-dev"
        base = root.rstrip("/")
        return cls(
            landing=f"{base}/landing{suffix}",
            lake=f"{base}/lake{suffix}",
            processing=f"{base}/processing{suffix}",
            curated=f"{base}/curated{suffix}",
        )

    @staticmethod
    def dataset(zone: str, *parts: str) -> str:
        """Path of one parquet dataset in a zone."""
        return "/".join([zone.rstrip("/"), *parts]) + ".parquet"
