"""Reading and writing tables: delimited text, Parquet, payloads, audio files."""
