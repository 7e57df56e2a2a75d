"""tidelog: resumable, bounded feeds over partitioned append-only logs, as Spark DataFrames."""

from tidelog.errors import TRANSIENT_CODES, FeedRefused
from tidelog.options import ReadOptions, WriteOptions
from tidelog.plans.feed import FeedRun, feed_run, land

__all__ = [
    "TRANSIENT_CODES",
    "FeedRefused",
    "FeedRun",
    "ReadOptions",
    "WriteOptions",
    "feed_run",
    "land",
]
