"""Output path patterns for recurring exports (the caller's scheduler decides when to run)."""

from __future__ import annotations

from datetime import datetime, timezone, tzinfo

# Fixed values, equal to the reference's placeholders: {date} yyyy-MM-dd, {time} HHmmss,
# {datetime} yyyy-MM-dd_HHmmss, {timestamp} and {ts} epoch milliseconds.
_FORMATS = (("{date}", "%Y-%m-%d"), ("{time}", "%H%M%S"), ("{datetime}", "%Y-%m-%d_%H%M%S"))


def render_output(pattern: str | None, when: datetime | None = None, tz: tzinfo | None = None) -> str | None:
    """Resolve the placeholders of an output path pattern for a run at ``when`` (default: now).

    Dates and times are shown in ``tz`` (default: the local zone); the epoch value is zone-free.
    """
    if pattern is None:
        return None
    when = when or datetime.now(timezone.utc)
    if when.tzinfo is None:
        when = when.astimezone()
    local = when.astimezone(tz) if tz is not None else when.astimezone()
    out = pattern
    for token, fmt in _FORMATS:
        out = out.replace(token, local.strftime(fmt))
    millis = str(int(when.timestamp() * 1000))
    return out.replace("{timestamp}", millis).replace("{ts}", millis)
