"""Parameters of the city report: field positions, bounds, vocab rules.

Fixed values that must equal the reference's behaviour are grouped here as
plain text; every operator takes them as arguments.
"""

from __future__ import annotations

# ---------------------------------------------------------------- fixed values
# Category names that never appear in a top list (totals and catch-alls).
IGNORE_CATEGORIES = [
    "total_vehicles", "total_accidents", "total_per_i", "total_mot_i", "total_ped_i", "total_cyc_i",
    "total_per_k", "total_ped_k", "total_mot_k", "total_cyc_k", "UNKNOWN", "Unspecified",
]
# (minimum number of categories, entries shown)
TIERS_FIVE = [(1, 1), (3, 3), (5, 5)]
TIERS_THREE = [(1, 1), (3, 3)]
DAYS_IN_PERIOD = 731  # 2012-01-01 .. 2013-12-31, 2012 being a leap year
CITY_RANGE = ("2012-01-01 00:00:00", "2013-12-31 23:59:00")
INCIDENT_HEADER_MARKER = "ZIP CODE"
SEGMENT_HEADER_MARKER = "Segment ID"
REQUEST_INCLUDE, REQUEST_EXCLUDE = "Street", "Noise"
TWO_SHIFT_MARKER = "Street Sign"
MALFORMED_KEY_MARKER = "NY"
# Date-time formats that are tried in this order.
INCIDENT_TS_FORMATS = ["M/d/yyyy H:mm", "M/d/yyyy h:mm:ss a", "yyyy-MM-dd H:mm"]
REQUEST_TS_FORMATS = ["M/d/yyyy h:mm:ss a", "M/d/yyyy H:mm", "yyyy-MM-dd'T'HH:mm:ss.SSS", "yyyy-MM-dd HH:mm:ss"]

# Collision record: 29 fields, 30 when the quoted location is cut at its comma;
# from index 10 on every field then moves right by one.
INCIDENT_BASE_ARITY = 29
INCIDENT_ARITIES = (29, 30)
INCIDENT_SHIFT_FROM = 10
INCIDENT_FIELDS = {"date": 0, "time": 1, "area": 3}
INCIDENT_INT_FIELDS = {"per_i": 10, "per_k": 11, "ped_i": 12, "ped_k": 13,
                       "cyc_i": 14, "cyc_k": 15, "mot_i": 16, "mot_k": 17}
INCIDENT_FACTOR_FIELDS = {f"fac_{i}": 17 + i for i in range(1, 6)}
INCIDENT_VEHICLE_FIELDS = {f"veh_{i}": 23 + i for i in range(1, 6)}

# Complaint record: at least 17 fields before any shift.
REQUEST_FIELDS = {"date": 1, "kind": 5, "descriptor": 6, "area": 8, "city": 16}

# Hourly segment counts: id, three names, then 24 hourly counts.
SEGMENT_LINE_FIELD = 0
SEGMENT_FIELDS = {"segment": 1, "roadway": 2, "from_name": 3, "to_name": 4}
SEGMENT_HOUR_FIELDS = list(range(7, 31))

MEASURES = list(INCIDENT_INT_FIELDS)
FACTOR_SLOTS = list(INCIDENT_FACTOR_FIELDS)
VEHICLE_SLOTS = list(INCIDENT_VEHICLE_FIELDS)
RATE_COLUMNS = ["accidents_per_1000_vehicles", "injuries_per_1000_accidents",
                "deaths_per_1000_accidents", "vehicles_per_accident"]

# Date bounds used with the driver's test tables.
TEST_INCIDENT_RANGE = ("1996-01-01 00:00:00", "1997-12-31 23:59:00")
TEST_REQUEST_RANGE = ("2024-01-01 00:00:00", "2024-01-31 23:59:00")
