from millrace.streaming.counts import running_counts

__all__ = ["running_counts"]
