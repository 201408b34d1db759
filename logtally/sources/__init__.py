from logtally.sources.kafka import KafkaSource
from logtally.sources.text import read_lines, starting_point, stream_lines

__all__ = ["KafkaSource", "read_lines", "starting_point", "stream_lines"]
