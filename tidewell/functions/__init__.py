from tidewell.functions.fixed_values import (
    DATE_FORMAT, EVENT_COLUMNS, HISTORY_SHIFT_SECONDS, MISSING_INT, TITLE_MEAN_AGES, TITLE_PATTERN,
    TITLE_REMAP, WORD_SEPARATOR,
)
from tidewell.functions.scalars import (
    day_of_epoch, epoch_date, epoch_seconds, first_title, hash_bucket, parse_token, words,
)

__all__ = [
    "DATE_FORMAT", "EVENT_COLUMNS", "HISTORY_SHIFT_SECONDS", "MISSING_INT", "TITLE_MEAN_AGES",
    "TITLE_PATTERN", "TITLE_REMAP", "WORD_SEPARATOR",
    "day_of_epoch", "epoch_date", "epoch_seconds", "first_title", "hash_bucket",
    "parse_token", "words",
]
