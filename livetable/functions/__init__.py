"""Column-level functions: all built from Spark expressions (JVM-side,
whole-stage code generation), no Python UDFs."""

from livetable.functions.text import (contains_text, is_not_blank, lines_of,
                                      nonblank, split_words, words_array)
from livetable.functions.json import (json_fields, parse_json, split_valid,
                                      to_json_line)
from livetable.functions.ids import id_number, id_text, ids_to_text
from livetable.functions.timefns import (epoch_millis, from_utc_micros,
                                         parse_event_line, to_utc_instant)

__all__ = ["contains_text", "is_not_blank", "lines_of", "nonblank",
           "split_words", "words_array", "json_fields", "parse_json",
           "split_valid", "to_json_line", "id_number", "id_text", "ids_to_text",
           "epoch_millis", "from_utc_micros", "parse_event_line",
           "to_utc_instant"]
