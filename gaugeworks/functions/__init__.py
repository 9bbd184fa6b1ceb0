from gaugeworks.functions.exact_sum import BAND, PIECES, band_pieces, exact_sum_columns, exact_sum_value
from gaugeworks.functions.messages import decode, encode_reading, encode_result
from gaugeworks.functions.rounding import round_half_even_2
from gaugeworks.functions.times import (
    epoch_ms,
    from_epoch_ms,
    iso_text,
    parse_iso,
    window_label,
)

__all__ = [
    "decode",
    "encode_reading",
    "encode_result",
    "epoch_ms",
    "BAND",
    "PIECES",
    "band_pieces",
    "exact_sum_columns",
    "exact_sum_value",
    "from_epoch_ms",
    "iso_text",
    "parse_iso",
    "round_half_even_2",
    "window_label",
]
