"""Fixed parameters the registered queries run with (fixture time range)."""

Q1_FROM, Q1_TO = "1996-01-01", "1998-01-01"       # half-open
DASH_START, DASH_END = "1997-01-01", "1997-12-31"  # inclusive
DASH_BOROUGH = "ASIA"
TOP_N = 10
D9_END = "1997-06-15"
D9_START = "1997-06-01"
S2_FIRST_BATCH = 20_001                             # rows of the dirty feed before this src_seq
DELETE_BEFORE = "1996-01-01"
