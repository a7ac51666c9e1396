"""Writers. Output stays a folder of part files written in parallel."""
