"""Sinks (K01-K07)."""

from sluice.sinks.files import bucketed_lines, write_bucketed_text, write_bucketed_text_stream  # noqa: F401
from sluice.sinks.kafka import kafka_keyed_frame, kafka_value_frame  # noqa: F401
from sluice.sinks.idempotent import IdempotentBatchWriter  # noqa: F401
