"""lakecensus: a DataFrame-native engine that turns captured workspace / catalogue API
responses (a landing table of HTTP attempts) into a flat, queryable metadata inventory."""

from lakecensus.session import configure, ensure_checkpoint_dir, local_session

__all__ = ["configure", "ensure_checkpoint_dir", "local_session"]
