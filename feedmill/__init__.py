"""Load and analyse process-plant data with Spark DataFrames."""

from feedmill.feeds import FEEDS, FeedSpec, feed

__all__ = ["FEEDS", "FeedSpec", "feed"]
