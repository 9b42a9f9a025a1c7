"""Default thresholds. Results depend on them, so they are stated here once."""

MIN_RECORDS = 5                # tables with fewer rows are not analysed
COL_TYPE_THRESHOLD = 0.90      # share of values that must match the voted type
AUTOINCREMENT_THRESHOLD = 0.99
AUTOINCREMENT_MIN_RATE = 0.75  # integer share needed before testing for a sequence
MAX_INTEGER_LEN = 12           # longer digit strings are text

JOINT_KEY_LIMIT = 3
MAX_LHS = 3                    # columns of a determinant: as many as a joint key may have
ONE_STEP_FDS = 10_000          # up to so many FDs the worklist proposes the one-step key search

FK_RATIO = 0.99
FK_MIN_AVG_LEN = 2.0
FK_MIN_DISTINCT = 3

# Fragments that mark a technical column.
IGNORED_COLUMN_FRAGMENTS = ("hhdw_etl_date", "chain_md5")
LOAD_DATE = "hhdw_etl_date"
