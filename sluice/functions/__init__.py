"""Column-level helpers (JVM-side expressions only, no Python UDFs)."""

from sluice.functions.time import (  # noqa: F401
    epoch_ms,
    epoch_us,
    from_epoch_ms,
    from_epoch_seconds,
    shift_seconds,
)
