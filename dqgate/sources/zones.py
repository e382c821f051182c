"""Where the outputs of a feed live below one base folder."""

from __future__ import annotations

import re
from dataclasses import dataclass


@dataclass(frozen=True)
class Zones:
    """Zones of one feed.  Small tables are partitioned by feed and date, so feeds share them."""

    base: str
    feed: str = "transactions"

    def __post_init__(self) -> None:
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", self.feed):
            raise ValueError(f"a feed is named by letters, digits, dots, dashes and underscores: {self.feed!r}")

    def _of_feed(self, name: str) -> str:
        return f"{self.base}/{name}/feed={self.feed}"

    @property
    def landing(self) -> str:
        return f"{self.base}/landing/{self.feed}"

    @property
    def curated(self) -> str:
        return f"{self.base}/curated/{self.feed}"

    @property
    def quarantine(self) -> str:
        return f"{self.base}/quarantine/{self.feed}"

    @property
    def reports(self) -> str:
        return self._of_feed("quality-reports")

    @property
    def evaluated(self) -> str:
        return self._of_feed("evaluated-reports")

    @property
    def alerts(self) -> str:
        return self._of_feed("alerts")

    @property
    def failures(self) -> str:
        return self._of_feed("failures")

    @property
    def reviews(self) -> str:
        return self._of_feed("review-queue")

    @property
    def verdicts(self) -> str:
        return self._of_feed("verdicts")

    @property
    def manifest(self) -> str:
        return self._of_feed("manifest")

    @property
    def outputs(self) -> tuple[str, ...]:
        """The zones that hold the outputs of runs, below ``dt=`` and ``run=`` folders."""
        return (self.curated, self.quarantine, self.reports, self.evaluated, self.alerts, self.failures, self.reviews)
