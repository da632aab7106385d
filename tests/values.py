"""Values that several test modules share."""

from datetime import datetime, timezone

NOW = datetime(2026, 6, 12, 7, 0, tzinfo=timezone.utc)
