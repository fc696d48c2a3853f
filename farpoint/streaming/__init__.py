"""The counting operators over file streams (Structured Streaming), and samples and
part histograms as keyed state.

The counting operators are plain DataFrame functions, so a streaming DataFrame from
``readStream`` goes through the same code; these helpers only build the
source and pick an output mode that the aggregation supports.
"""

from farpoint.streaming.counts import stream_class_count, stream_word_count
from farpoint.streaming.state import (
    current_sample,
    histogram_so_far,
    largest_part_so_far,
    stream_class_histogram,
    stream_sample,
)

__all__ = ["current_sample", "histogram_so_far", "largest_part_so_far", "stream_class_count",
           "stream_class_histogram", "stream_sample", "stream_word_count"]
