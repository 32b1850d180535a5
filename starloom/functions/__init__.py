from starloom.functions.calendar import (
    EPOCH,
    date_parts,
    epoch,
    epoch_millis,
    epoch_seconds,
    iso_text,
    millis_to_timestamp,
    text_to_epoch_seconds,
)

__all__ = [
    "EPOCH",
    "date_parts",
    "epoch",
    "epoch_millis",
    "epoch_seconds",
    "iso_text",
    "millis_to_timestamp",
    "text_to_epoch_seconds",
]
