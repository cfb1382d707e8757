"""Scalar functions: time conversions, envelopes, bins, flags."""

from pulsehouse.functions.time import (epoch_seconds, epoch_double, epoch_micros_ntz,
                                       epoch_to_timestamp, minutes_between,
                                       to_instant, to_wall, week_part)
from pulsehouse.functions.envelope import (decode_envelope, encode_record, flatten,
                                           to_envelope)
from pulsehouse.functions.bins import age_bin, age_years, bin_labels, validity

__all__ = ["epoch_seconds", "epoch_double", "epoch_micros_ntz", "epoch_to_timestamp",
           "minutes_between", "to_instant", "to_wall", "week_part",
           "decode_envelope", "encode_record", "flatten", "to_envelope",
           "age_bin", "age_years", "bin_labels", "validity"]
