"""Feeds, thresholds and time windows.

Everything a detector needs is a plain frozen dataclass, so a plan can be rebuilt
for any ``as_of`` instant: the wall clock is never read inside an operator.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

AUDIT = "audit"
TRACK_MDC = "track_mdc"
TRACK_CTX = "track_ctx"
TRACK = frozenset({TRACK_MDC, TRACK_CTX})
ALL_FAMILIES = frozenset({AUDIT, TRACK_MDC, TRACK_CTX})


@dataclass(frozen=True)
class Feed:
    key: str
    table: str
    family: str


# The six log types, their table names and their schema family.
FEEDS = {
    feed.key: feed
    for feed in (
        Feed("bpm_adapter", "bpm_adapter_logs", TRACK_MDC),
        Feed("bpm_audit", "bpm_audit_logs", AUDIT),
        Feed("bpm_perf", "bpm_perf_logs", TRACK_MDC),
        Feed("m2e_audit", "m2e_audit_logs", AUDIT),
        Feed("m2e_perf", "m2e_perf_logs", TRACK_CTX),
        Feed("maf_perf", "maf_perf_logs", TRACK_CTX),
    )
}

# Severities by rank, worst first.
SEVERITY_RANK = {"CRITICAL": 1, "HIGH": 2, "MEDIUM": 3, "LOW": 4, "INFO": 5}


def utc(moment: datetime) -> datetime:
    """Naive datetimes are read as UTC."""
    if moment.tzinfo is None:
        return moment.replace(tzinfo=timezone.utc)
    return moment.astimezone(timezone.utc)


END_OF_TIME = datetime(9999, 12, 30, tzinfo=timezone.utc)


@dataclass(frozen=True)
class Span:
    """A closed time range: both ends are included."""

    start: datetime
    end: datetime


@dataclass(frozen=True)
class TimeWindows:
    as_of: datetime
    medium: Span
    long: Span
    baseline: Span
    heartbeat: Span


@dataclass(frozen=True)
class WindowConfig:
    medium: timedelta = timedelta(minutes=15)
    long: timedelta = timedelta(minutes=30)
    baseline: timedelta = timedelta(days=7)
    baseline_gap: timedelta = timedelta(hours=1)
    #: An instance whose clock is fast is alive. Close the range at ``as_of`` to replay the past.
    closed_heartbeat: bool = False

    def at(self, as_of: datetime, heartbeat: timedelta) -> TimeWindows:
        now = utc(as_of)
        return TimeWindows(
            as_of=now,
            medium=Span(now - self.medium, now),
            long=Span(now - self.long, now),
            baseline=Span(now - self.baseline, now - self.baseline_gap),
            heartbeat=Span(now - heartbeat, now if self.closed_heartbeat else END_OF_TIME),
        )


@dataclass(frozen=True)
class DetectorConfig:
    failure_rate_multiplier: float = 2.0
    failure_rate_critical: float = 5.0
    failure_rate_smoothing: float = 0.01
    failure_min_rows: int = 10

    heartbeat_minutes: int = 5

    p95_limit_ms: int = 30_000
    p99_limit_ms: int = 60_000
    response_min_rows: int = 10

    timeout_min_rows: int = 3

    volume_multiplier: float = 3.0
    volume_smoothing: float = 0.1

    degradation_percent: float = 50.0
    degradation_critical_percent: float = 100.0
    degradation_min_current: int = 5
    degradation_min_baseline: int = 10

    windows: WindowConfig = field(default_factory=WindowConfig)

    @property
    def bucket_seconds(self) -> int:
        """Volume baselines are averaged over buckets as long as the medium window."""
        return int(self.windows.medium.total_seconds())

    def windows_at(self, as_of: datetime) -> TimeWindows:
        return self.windows.at(as_of, timedelta(minutes=self.heartbeat_minutes))
