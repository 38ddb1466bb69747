"""Fixed parameters of the registered queries (FIXTURES.md section 3)."""

import datetime as dt

AS_OF = dt.date(2024, 1, 31)                 # daily, weekly, ETL, alert queries
AS_OF_TS = dt.datetime(2024, 1, 31, 0, 0)
RETENTION_AS_OF = dt.date(2024, 1, 21)       # retention on events
ORDERS_RETENTION_AS_OF = dt.date(1995, 1, 21)
RETENTION_UNTIL = dt.date(2024, 1, 30)       # last day of activity that the heatmap shows
HORIZON = 20
DAILY_MERGES = 4    # days merged one by one into the user state; those before them are one backfill
AA_PERIOD = (dt.date(2024, 1, 1), dt.date(2024, 1, 7))
AA_GROUPS = (2, 3)
AB_PERIOD = (dt.date(2024, 1, 8), dt.date(2024, 1, 14))
AB_GROUPS = (1, 2)
AB_GROUPS_2 = (0, 3)
PRE = (dt.date(2024, 1, 1), dt.date(2024, 1, 22))
POST = (dt.date(2024, 1, 23), dt.date(2024, 1, 30))
TODAY_TS = dt.datetime(2024, 1, 30, 18, 0)  # "today" dashboard: a day with data
CAMPAIGN_DAY = dt.date(2024, 1, 2)
DROP_DAY = dt.date(2024, 1, 22)
ALPHA = 5.0
N_BUCKETS = 50
N_BOOT = 2000
AA_REPS = 10000
AA_K = 100          # users drawn from each group; the test data have a few hundred
IQR_A = 5.0
IQR_N = 5
LONG_HISTORY = 30   # days of 15-minute windows judged at once, in ranges of RANGE
RANGE = "2 days"
HIST_BINS = {       # distribution -> (first bin's start, width)
    "ctr": (0.0, 0.05), "smoothed_ctr": (0.0, 0.05), "linearized_likes": (0.0, 1.0), "bucket_ctr": (0.0, 0.05),
    "bootstrap_ctr": (0.0, 0.005), "bootstrap_diff": (0.0, 0.005), "aa_p_value": (0.0, 0.05),
}
ROUND = 6
PERIODS = [         # periods of days whose distinct users come from stored bitmaps; they overlap
    ("first_week", dt.date(2024, 1, 1), dt.date(2024, 1, 7)), ("second_week", dt.date(2024, 1, 8), dt.date(2024, 1, 14)),
    ("fortnight", dt.date(2024, 1, 1), dt.date(2024, 1, 14)), ("month", dt.date(2024, 1, 1), dt.date(2024, 1, 31)),
]
