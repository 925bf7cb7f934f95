"""Parameters of the ride-analytics jobs.

Everything that a job needs to know about valid domains, ranges, calendars
and tariffs lives here as plain Python values; jobs take them as optional
arguments so a different market can pass its own.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# These must equal the reference application's constants for
# results to agree (domains, ranges, zones, calendars, tariffs, multipliers).
# ---------------------------------------------------------------------------

VALID_CITIES = ["Delhi NCR", "Mumbai", "Bengaluru", "Chennai", "Hyderabad"]
VALID_VEHICLE_TYPES = ["bike_taxi", "auto", "economy", "premium", "shared"]
VALID_WEATHER = ["clear", "light_rain", "heavy_rain", "fog"]

FARE_MIN, FARE_MAX = 10.0, 5000.0
DISTANCE_MIN, DISTANCE_MAX = 0.5, 80.0
WAIT_MIN, WAIT_MAX = 0.5, 120.0
SURGE_MIN, SURGE_MAX = 1.0, 4.0
RATING_MIN, RATING_MAX = 1.0, 5.0

CITY_ZONES = {
    "Delhi NCR": ["Connaught Place", "Karol Bagh", "Lajpat Nagar", "Saket", "Dwarka",
                  "Rohini", "Noida Sector 18", "Gurgaon Cyber City", "Hauz Khas",
                  "Nehru Place", "Janakpuri", "Vasant Kunj", "Greater Noida",
                  "Faridabad", "Ghaziabad"],
    "Mumbai": ["Bandra", "Andheri West", "Andheri East", "Juhu", "Borivali",
               "Thane", "Kurla", "Dadar", "Lower Parel", "BKC", "Powai",
               "Malad", "Navi Mumbai", "Vashi", "Chembur"],
    "Bengaluru": ["Koramangala", "Indiranagar", "Whitefield", "Electronic City",
                  "HSR Layout", "Jayanagar", "Hebbal", "Marathahalli", "MG Road",
                  "Yelahanka", "Bannerghatta", "Sarjapur", "BTM Layout",
                  "Bellandur", "Rajajinagar"],
    "Chennai": ["T. Nagar", "Anna Nagar", "Adyar", "Velachery", "Tambaram",
                "Porur", "Nungambakkam", "Mylapore", "Perambur", "Chromepet",
                "Sholinganallur", "OMR", "Guindy", "Kodambakkam", "Koyambedu"],
    "Hyderabad": ["Hitech City", "Madhapur", "Gachibowli", "Banjara Hills",
                  "Jubilee Hills", "Secunderabad", "Ameerpet", "Kukatpally",
                  "LB Nagar", "Dilsukhnagar", "Uppal", "Kompally",
                  "Kondapur", "Manikonda", "Miyapur"],
}
UNKNOWN_ZONE = "Unknown"

# Hours counted as peak by the feature stage and the clean-data EDA (7 hours) ...
PEAK_HOURS = [7, 8, 9, 17, 18, 19, 20]
# ... and by the data-quality checks and the raw-data notebook (6 hours).
CHECK_PEAK_HOURS = [7, 8, 9, 17, 18, 19]
NIGHT_HOURS = [22, 23, 0, 1, 2, 3, 4]
LATE_NIGHT_HOURS = [0, 1, 2, 3, 4]
DEAD_HOURS = [1, 2, 3, 4]

SEASON_CODES = {"winter": 0, "summer": 1, "monsoon": 2, "post_monsoon": 3}
# month -> season: 12,1,2 winter; 3-5 summer; 6-9 monsoon; 10,11 post_monsoon
SEASON_MONTHS = {
    "winter": [12, 1, 2],
    "summer": [3, 4, 5],
    "monsoon": [6, 7, 8, 9],
}
SEASON_OTHER = "post_monsoon"

# demand_pressure weights
PRESSURE_PEAK, PRESSURE_RAIN, PRESSURE_FESTIVAL, PRESSURE_IPL = 0.5, 0.4, 0.6, 0.5
HIGH_SURGE_THRESHOLD = 2.0

# right-closed bins (lower edge exclusive)
SURGE_BAND_EDGES = [0.0, 1.0, 1.5, 2.0, 2.5, 5.0]
SURGE_BAND_LABELS = ["no_surge", "low", "medium", "high", "extreme"]
WAIT_BAND_EDGES = [0.0, 3.0, 6.0, 10.0, 15.0, 120.0]
WAIT_BAND_LABELS = ["very_fast", "fast", "normal", "slow", "very_slow"]
# raw-notebook surge bins, left-closed
RAW_SURGE_EDGES = [1.0, 1.01, 1.5, 2.0, 2.5, 4.1]
RAW_SURGE_LABELS = ["No surge (1×)", "Low (1–1.5×)", "Med (1.5–2×)", "High (2–2.5×)", "Extreme (>2.5×)"]

WEATHER_ORDER = ["clear", "fog", "light_rain", "heavy_rain"]
EVENT_ORDER = ["Normal day", "IPL match day", "Festival day"]

FESTIVAL_DATES = [
    "2023-01-26", "2023-03-08", "2023-04-04", "2023-04-14",
    "2023-08-15", "2023-09-19", "2023-10-02", "2023-10-24",
    "2023-11-12", "2023-11-13", "2023-11-27", "2023-12-25",
    "2023-12-31", "2024-01-01", "2024-01-22", "2024-01-26",
    "2024-03-25", "2024-04-11", "2024-05-23", "2024-06-17",
]

IPL_MATCHES = {
    "Delhi NCR": ["2023-04-01", "2023-04-08", "2023-04-15", "2023-04-22", "2023-04-29",
                  "2023-05-06", "2023-05-13", "2024-03-24", "2024-04-06", "2024-04-14",
                  "2024-04-21", "2024-04-28", "2024-05-05", "2024-05-12"],
    "Mumbai": ["2023-04-02", "2023-04-09", "2023-04-16", "2023-04-23", "2023-04-30",
               "2023-05-07", "2023-05-14", "2024-03-23", "2024-03-30", "2024-04-07",
               "2024-04-13", "2024-04-20", "2024-04-27", "2024-05-04"],
    "Bengaluru": ["2023-04-03", "2023-04-10", "2023-04-17", "2023-04-24", "2023-05-01",
                  "2023-05-08", "2024-03-22", "2024-03-29", "2024-04-08", "2024-04-15",
                  "2024-04-22", "2024-04-29", "2024-05-06"],
    "Chennai": ["2023-04-04", "2023-04-11", "2023-04-18", "2023-04-25", "2023-05-02",
                "2023-05-09", "2023-05-16", "2024-03-25", "2024-04-01", "2024-04-09",
                "2024-04-16", "2024-04-23", "2024-04-30", "2024-05-07"],
    "Hyderabad": ["2023-04-05", "2023-04-12", "2023-04-19", "2023-04-26", "2023-05-03",
                  "2023-05-10", "2024-03-26", "2024-04-02", "2024-04-10", "2024-04-17",
                  "2024-04-24", "2024-05-01", "2024-05-08"],
}

# vehicle -> (share, base_fare, per_km, wait_base)
VEHICLE_TARIFFS = {
    "bike_taxi": (0.28, 25.0, 8.0, 3.0),
    "auto": (0.24, 30.0, 11.0, 4.5),
    "economy": (0.30, 50.0, 14.0, 5.5),
    "premium": (0.10, 100.0, 22.0, 7.0),
    "shared": (0.08, 20.0, 6.0, 8.0),
}

HOUR_DEMAND = {
    0: 0.40, 1: 0.20, 2: 0.15, 3: 0.12, 4: 0.18,
    5: 0.45, 6: 0.75, 7: 1.20, 8: 1.50, 9: 1.10,
    10: 0.80, 11: 0.75, 12: 0.90, 13: 1.00, 14: 0.85,
    15: 0.80, 16: 0.90, 17: 1.40, 18: 1.70, 19: 1.60,
    20: 1.30, 21: 1.10, 22: 0.90, 23: 0.60,
}
WEATHER_DEMAND = {"clear": 1.00, "light_rain": 1.35, "heavy_rain": 1.75, "fog": 1.20}
WEEKEND_DEMAND = 0.85
WEEKEND_EVENING_DEMAND = 1.25  # weekend and 18 <= hour <= 23

# quality-check thresholds (validate stage)
CHECK_MIN_ROWS = 490_000
CHECK_MIN_FIRST_DATE = "2023-01-31"
CHECK_MAX_LAST_DATE = "2024-06-01"

# Scenario scoring defaults and fallbacks
DEFAULT_SURGE = 1.5
DEFAULT_VOLUME = 15
DEFAULT_LAG = 15
UNKNOWN_CITY_CODE, UNKNOWN_VEHICLE_CODE, UNKNOWN_WEATHER_CODE, UNKNOWN_SEASON_CODE = 2, 2, 0, 0
FALLBACK_WAIT, FALLBACK_SURGE_PROB, FALLBACK_CANCEL_PROB = 7.5, 0.3, 0.06


def fixture_zones(cities=None):
    """Zone lists of the driver-derived `rides` fixture: '<city> Z0' .. 'Z14'."""
    return {c: [f"{c} Z{i}" for i in range(15)] for c in (cities or VALID_CITIES)}
