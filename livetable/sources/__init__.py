"""Source factories: batch and streaming readers with declared schemas."""

from livetable.sources.files import (batch_bytes, read_delimited, read_json_lines,
                                     read_lines, read_table, stream_table, table_path)
from livetable.sources.kafka import kafka_rows, kafka_value, read_kafka, write_kafka
from livetable.sources.generators import read_rate, read_socket

__all__ = ["batch_bytes", "read_delimited", "read_json_lines", "read_lines", "read_table",
           "stream_table", "table_path", "kafka_rows", "kafka_value",
           "read_kafka", "write_kafka", "read_rate", "read_socket"]
