from snowloom.streaming.ingest import land_new_files, land_stream, landed, landing_number

__all__ = ["land_new_files", "land_stream", "landed", "landing_number"]
