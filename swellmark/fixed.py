"""Fixed values.

Results depend on these, so they are stated here as plain constants and nowhere
else.
"""

# --- fixed values: raw export header spellings, first non-empty wins ---
DATE_ALIASES = ("Date", "date", "DATE")
URL_ALIASES = ("URL", "url", "Url")
TONE_ALIASES = ("Tone", "tone", "AvgTone")
SNIFF_MARKS = ("SQLDATE", "Date")

# --- fixed values: ingestion ---
COUNTRY = "YEM"
MAX_ARTICLES_PER_DAY = 250
FIRST_EVENT_ID = 100000
MAX_TONE = -2.0
STUDY_START = "2023-10-19"
STUDY_END = "2024-02-08"
TONE_FALLBACK_MEAN = -5.0
TONE_FALLBACK_SD = 2.0

# --- fixed values: price series ---
ROUTE = "Shanghai-Rotterdam"
NOISE_SD = 5.0

# --- fixed values: dashboard ---
WINDOW_START = "2023-11-15"
WINDOW_END = "2024-01-31"
CUTOFF_YEAR = 2024
PERIOD_LABELS = ("Crisis (2024)", "Baseline (2023)")
HISTOGRAM_BINS = 40
