"""The landing folder as a Structured Streaming source."""

from feedmart.streaming.feeds import landing_stream, start_landing_load

__all__ = ["landing_stream", "start_landing_load"]
