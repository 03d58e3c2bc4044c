"""Fixed values that must equal the source project's for identical labels and quotas.

FIXED VALUES — do not edit; stated in the order the source lists them.
"""

# Labels compared by the V2 rule and the 2x2 split.
CONFERENCE_PAPER = "Conference Paper"
CONFERENCE_PROCEEDING = "Conference Proceeding"

# V1 rule: source titles that indicate a full conference.
CONFERENCE_INDICATORS = (
    "international conference on",
    "proceedings of the",
    "annual conference",
    "international conference in",
    "international conference of",
)

# V1 rule: source-title terms that exclude a paper.
EXCLUSION_TERMS = (
    "workshop",
    "symposium",
    "seminar",
    "colloquium",
    "tutorial",
    "short paper",
    "poster",
    "abstract only",
    "extended abstract",
    "work in progress",
)

# V1 rule: source type must contain this phrase; minimum reference count.
PROCEEDING_PHRASE = "conference proceeding"
MIN_REFERENCES = 5

# Collection quota per (year, search option); options 0-3 are the 2x2 cells
# (0 = conference paper in proceeding, 1 = conference paper not in proceeding,
#  2 = proceeding but not conference paper, 3 = neither).
YEAR_QUOTAS = {
    2013: (1250, 1250, 1250, 1250),
    2014: (1250, 1250, 1250, 1250),
    2015: (1250, 1250, 1250, 1250),
    2016: (1250, 1250, 1250, 1250),
    2017: (1250, 1250, 1250, 1250),
    2019: (911, 1188, 1147),
    2020: (1032, 1168, 1145),
    2021: (1085, 1224, 1248),
    2022: (1073, 1227, 1239),
    2023: (1143, 1219, 1246),
}

# Years the paper loader walks (inclusive).
FIRST_YEAR, LAST_YEAR = 2013, 2023

# Prediction presentation: label text and gauge band edges (percent).
POSITIVE_TEXT, NEGATIVE_TEXT = "Successful", "Unsuccessful"
GAUGE_EDGES = (0.0, 33.0, 66.0, 100.0)

# Unknown-id marker of the failed-id log; default text of the affiliation profile.
UNKNOWN_ID = "UNKNOWN"
UNKNOWN_TEXT = "Unknown"
