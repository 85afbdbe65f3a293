"""Sources (S01-S11): collections, text, file directories, line replay,
Kafka frames, a rate generator and the text parsers."""

from sluice.sources.collection import from_collection  # noqa: F401
from sluice.sources.generator import datagen_batch, datagen_stream  # noqa: F401
from sluice.sources.kafka import kafka_decode, kafka_source_options  # noqa: F401
from sluice.sources.parse import (  # noqa: F401
    parse_int_line,
    parse_pair_csv,
    parse_sensor_csv,
    parse_triple_csv,
)
from sluice.sources.text import read_text, read_text_stream, text_lines, tokenize  # noqa: F401
