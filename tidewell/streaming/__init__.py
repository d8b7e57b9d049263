from tidewell.streaming.events import (
    append_stream, decode_events, open_files, open_stream, print_stream, read_decoded,
    read_rejects, start_decoding,
)
from tidewell.streaming.word_count import (
    count_words, read_word_counts, start_word_count,
)

__all__ = [
    "append_stream", "count_words", "decode_events", "open_files", "open_stream",
    "print_stream", "read_decoded", "read_rejects", "read_word_counts", "start_decoding",
    "start_word_count",
]
