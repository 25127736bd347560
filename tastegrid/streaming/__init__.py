"""The resumable extraction as a stream over a folder of files."""
