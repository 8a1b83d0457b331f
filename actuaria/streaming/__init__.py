from actuaria.streaming.ingest import stage_incrementally, start_staging_stream

__all__ = ["stage_incrementally", "start_staging_stream"]
