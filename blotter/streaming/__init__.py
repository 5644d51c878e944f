from blotter.streaming.monthly import landing_stream, start_month_replace

__all__ = ["landing_stream", "start_month_replace"]
