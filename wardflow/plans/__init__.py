"""Named queries over the tables. Each takes DataFrames and returns one."""
