"""The work itself: each function takes DataFrames and returns one."""
