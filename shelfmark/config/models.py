"""Ladders, weights and bands of the scoring models.

All numbers here are fixed values. A ladder is a list of (lower bound, points) pairs, highest bound first.
"""

# Additive ladder model (R1) ---------------------------------------------------------
LADDER_SCORE = {
    "hours": ([(100, 15), (75, 13), (50, 11), (30, 8), (15, 5)], 2),
    "first_rating": ([(4.5, 20), (4.2, 17), (4.0, 14), (3.8, 10), (3.5, 6)], 3),
    "first_count": ([(100000, 15), (50000, 13), (10000, 11), (5000, 9), (1000, 6), (100, 3)], 1),
    "lowest_rating": ([(4.2, 10), (4.0, 8), (3.8, 6), (3.5, 4)], 2),
    "books": ([(10, 10), (7, 9), (5, 7), (3, 5)], 3),
}
STABILITY_STEPS = [(0.2, 10), (0.4, 8), (0.6, 6), (0.8, 4)]
ERA_WORDS = [(["contemporary", "2020"], 10), (["mixed", "2010"], 7), (["historical", "before", "classic"], 5)]
ERA_DEFAULT = 6
LIST_BONUS = [
    ("nyt bestseller|new york times", 3),
    ("usa today", 3),
    ("amazon\\s*top\\s*10\\b", 3),
    ("amazon\\s*top\\s*50\\b", 2),
    ("goodreads choice", 2),
    ("booktok|tiktok viral", 2),
    ("amazon\\s*top\\s*100\\b", 1),
]
LIST_BONUS_CAP = 10
LADDER_RANKS = ([(75, "P0"), (55, "P1"), (35, "P2")], "P3")

# Weighted percentage model (R2) -----------------------------------------------------
WEIGHTED = {"volume": 0.30, "quality_first": 0.15, "quality_avg": 0.10, "retention": 0.25, "appeal": 0.20}
WEIGHTED_RANKS = ([(90, "P0"), (80, "P1"), (70, "P2"), (60, "P3"), (50, "P4")], "P5")
DOUBT_SCORE = 80.0
INDEPENDENT_FACTOR = 1.20

# Weighted model with a short-series penalty (R3) ------------------------------------
PENALTY_WEIGHTS = {"volume": 0.30, "quality": 0.25, "retention": 0.25, "appeal": 0.20}
PENALTY_RANKS = ([(80, "P0"), (65, "P1"), (50, "P2"), (35, "P3"), (20, "P4")], "P5")

# List-bucket model (R4) -------------------------------------------------------------
BUCKET_RANKS = ([(68, "P0"), (58, "P1"), (48, "P2"), (30, "P3"), (15, "P4")], "P5")

# Expansion model (R5) ---------------------------------------------------------------
EXPANSION = {
    "hours": ([(80, 25), (50, 20), (30, 12)], 5),
    "first_rating": ([(4.3, 25), (4.0, 20), (3.8, 15)], 8),
    "first_count": ([(20000, 25), (10000, 22), (5000, 18), (1000, 12)], 5),
    "lowest_rating": ([(4.0, 15), (3.5, 10)], 3),
    "pub_year": ([(2020, 10), (2015, 5)], 0),
}
EXPANSION_RANKS = ([(85, "P0"), (70, "P1"), (50, "P2")], "P3")

# Series type ladders (N5), label by smallest book count -----------------------------
SERIES_TYPES = {
    "crawl": ([(6, "Long Series"), (4, "Series"), (2, "Short Series")], "Standalone"),
    "report": ([(6, "Long Series"), (3, "Series"), (2, "Short Series")], "Standalone"),
    "commissioning": ([(6, "Long Series"), (4, "Series"), (2, "Short Series")], "Standalone"),
    "outreach": ([(7.000001, "Long Series"), (3.000001, "Series"), (1.000001, "Short Series")], "Standalone"),
    "enrichment": ([(7, "Long Series"), (3, "Series")], None),
    "discovery": ([(6, "Long Series")], "Series"),
}

# Pages to hours (N4): (words per page, words per hour), or a plain factor/divisor ----
HOURS_FORMULAS = {
    "report": ("words", 300, 10000, 1),
    "crawl": ("factor", 0.03, None, 2),
    "audit": ("divisor", 33.33, None, 1),
    "outreach": ("words", 250, 9600, 2),
    "combined": ("words", 300, 9600, 2),
}

# Commercial bands (J23) -------------------------------------------------------------
# (order, tier, lowest count, highest count, least hours, fee low, fee high, share low, share high)
COMMERCIAL_BANDS = [
    (1, 1, 20000, None, 80.0, 17500, 25000, 15, 22),
    (2, 2, 20000, None, 40.0, 17500, 20000, 15, 22),
    (3, 5, 5000, 19999, 80.0, 12500, 17500, 15, 20),
    (4, 6, 5000, 19999, 40.0, 5000, 7500, 15, 20),
    (5, 9, 0, 4999, 40.0, 0, 1000, 12, 18),
    (6, 10, 0, 4999, 0.0, 0, 0, 12, 18),
]
FALLBACK_BAND = (10, 0, 0, 12, 18)

# Flag ladders (N6): (bounds, labels), label i while value <= bound i ----------------
UPPER_FLAGS = {
    "hours": ([20, 50, 100], ["Low", "Medium", "High", "Very High"]),
    "first_rating": ([3.5, 3.8, 4.0], ["Low", "Medium", "High", "Very High"]),
    "first_count": ([1000, 10000, 50000], ["Low", "Medium", "High", "Very High"]),
    "lowest_rating": ([3.3, 3.6, 3.9], ["Low", "Medium", "High", "Very High"]),
    "stability": ([0.4, 0.6, 0.8], ["Low", "Medium", "High", "Very High"]),
}
# (bounds with labels, highest first), default
LOWER_FLAGS = {
    "adaptation_length": ([(50, "Long"), (20, "Medium")], "Short"),
    "first_rating": ([(4.3, "Excellent"), (3.8, "Good")], "Average"),
    "lowest_rating": ([(4.0, "Strong"), (3.5, "Acceptable")], "Weak"),
    "hours_expansion": ([(80, "Very High"), (50, "High"), (30, "Medium")], "Low"),
    "first_count_expansion": ([(10000, "Very High"), (5000, "High"), (1000, "Medium")], "Low"),
}

# Rank bucket of a bestseller list (N13) ---------------------------------------------
RANK_BUCKETS = [(10, "Top 10"), (50, "Top 50"), (100, "Top 100")]

# Gap triggers (V12) -----------------------------------------------------------------
GAP_TRIGGERS = {
    "recovery": {"author": 0.05, "store_link": 0.05, "store_rating": 0.10},
    "series_bulk": {"review_link": 0.10, "series": 0.10, "review_rating": 0.10},
    "detailed": {"description": 0.10, "pages": 0.10, "publisher": 0.10},
}
CONVERGENCE = 0.02

# Orders of priority labels (W3) -----------------------------------------------------
PRIORITY_ORDER = {"P0": 0, "P1": 1, "P2": 2, "P3": 3, "P4": 4, "P5": 5}
SEVERITY_ORDER = {"GREEN": 0, "YELLOW": 1, "RED": 2}
