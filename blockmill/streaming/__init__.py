from blockmill.streaming.pack_stream import pack_stream, plan_lanes
from blockmill.streaming.progress import ProgressLog, observed

__all__ = ["ProgressLog", "observed", "pack_stream", "plan_lanes"]
