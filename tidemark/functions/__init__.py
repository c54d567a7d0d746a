from tidemark.functions.event_time import (
    as_instant, as_wall_clock, epoch_seconds, interval, moment, seconds_of, time_bucket)

__all__ = ["as_instant", "as_wall_clock", "epoch_seconds", "interval", "moment", "seconds_of",
           "time_bucket"]
