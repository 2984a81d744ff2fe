"""Table operators that need more than one column expression."""

from sluiceway.operators.joins import fits_broadcast, left_join, sized
from sluiceway.operators.keys import dense_key, row_key
from sluiceway.operators.latest import keep_latest
from sluiceway.operators.staging import Scratch, release_scratch, stage
from sluiceway.operators.versions import next_in_key

__all__ = [
    "Scratch",
    "dense_key",
    "fits_broadcast",
    "keep_latest",
    "left_join",
    "next_in_key",
    "release_scratch",
    "row_key",
    "sized",
    "stage",
]
