"""SQL building blocks for the DuckDB oracle texts (same views as ``model``)."""

from sluice.functions.time import duration_us
from sluice.model import ARRIVAL_MULTIPLIER, ARRIVAL_SPREAD_SECONDS

SENSOR = (
    "sensor AS (SELECT event_id AS seq, user_id AS id, ts AS et, "
    "CAST(epoch_us(ts) // 1000000 AS BIGINT) AS ts, "
    "CAST(floor(value) AS INTEGER) AS vc, event_type FROM events)"
)

ARRIVALS = (
    "arrivals AS (SELECT *, et + to_seconds((seq * "
    f"{ARRIVAL_MULTIPLIER}) % {ARRIVAL_SPREAD_SECONDS}) AS arrival FROM sensor)"
)


def ms(col: str) -> str:
    """Epoch milliseconds, floored (matches ``functions.time.epoch_ms``)."""
    return f"(epoch_us({col}) // 1000)"


def with_views(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def us(duration: str) -> int:
    return duration_us(duration)


def tumble_start_ms(col: str, duration: str) -> str:
    u = us(duration)
    return f"((epoch_us({col}) // {u}) * {u // 1000})"


def tumble_end_ms(col: str, duration: str) -> str:
    u = us(duration)
    return f"((epoch_us({col}) // {u} + 1) * {u // 1000})"


def sliding_expand(src: str, col: str, size: str, slide: str) -> str:
    """Rows of ``src`` copied once per sliding window, with window_start /
    window_end (ms) columns."""
    sz, sl = us(size), us(slide)
    k = sz // sl
    return (
        f"(SELECT x.*, (epoch_us(x.{col}) // {sl} - k) * {sl // 1000} AS window_start, "
        f"(epoch_us(x.{col}) // {sl} - k) * {sl // 1000} + {sz // 1000} AS window_end "
        f"FROM {src} x, unnest(range(0, {k})) AS r(k))"
    )
