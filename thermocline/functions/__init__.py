from .time import (as_instant, as_naive, epoch_micros, epoch_seconds,
                   format_epoch_seconds, naive_from_seconds)
from .scalar import (format_number, java_double_hash, java_hash, java_hash_pair,
                     java_string_hash, scaled_hash, to_csv_value, trim_col,
                     wrap_int32)
from .text import java_split
