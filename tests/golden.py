"""Hand-made inputs with their expected rows."""

from datetime import date

A = ("40.6980", "-73.9790")  # cell dr5rs8
B = ("40.7500", "-73.9900")  # cell dr5ru6


def _trip(trip_id, start, end, pickup, dropoff, distance):
    return (trip_id, start, end, pickup[1], pickup[0], dropoff[1], dropoff[0], distance)


TRIPS = [
    _trip("1", "2015-09-01 00:02:34", "2015-09-01 00:12:40", A, B, "2.0"),
    _trip("2", "2015-09-01 00:05:00", "2015-09-01 00:05:30", A, A, "1.0"),
    _trip("3", "2015-09-01 23:55:00", "2015-09-02 00:15:00", B, A, "10.0"),
    _trip("4", "2015-09-01 00:05:00", "2015-09-01 00:15:00", ("abc", A[1]), A, "1.0"),
    _trip("5", "2015-09-01 00:05:00", "2015-09-01 00:15:00", A, A, None),
    _trip("6", "2015-09-01 05:05:00", "2015-09-01 05:15:00", A, A, "n/a"),
    _trip("7", "2015-09-01 00:07:00", "2015-09-01 00:02:00", A, B, "1.0"),
    _trip("8", "2015-09-01 00:07:00", "oops", A, B, "1.0"),
]

# trip_id -> trip_time, speed
SPEEDS = {
    "1": ("10", 12.0),
    "2": ("0", None),
    "3": ("20", 30.0),
    "6": ("10", None),
    "7": ("-5", -12.0),
}

_D1, _D2 = date(2015, 9, 1), date(2015, 9, 2)

CONGESTION = [
    ("dr5rs8", _D1, "0-1", "0-10", 10.0, 0.0, "Red"),
    ("dr5rs8", _D1, "5-6", "0-10", 10.0, None, "Yellow"),
    ("dr5rs8", _D1, "5-6", "10-20", 10.0, None, "Yellow"),
    ("dr5rs8", _D2, "0-1", "10-20", 10.0, 30.0, "Green"),
    ("dr5ru6", _D1, "0-1", "0-10", 10.0, -12.0, "Red"),
    ("dr5ru6", _D1, "0-1", "10-20", 10.0, 12.0, "Yellow"),
    ("dr5ru6", _D1, "23-24", "50-60", 10.0, 30.0, "Green"),
]

DEMAND = [
    ("c1", "1.30", "103.85", "2024-01-01 07:25:00"),
    ("c2", "1.30", "103.85", "2024-01-01 07:29:59"),
    ("c3", "1.30", "103.85", "2024-01-01 07:20:00"),
    ("c4", "1.35", "103.99", "2024-01-01 07:25:00"),
    ("c5", "abc", "103.85", "2024-01-01 23:59:59"),
    ("c6", None, "103.85", "2024-01-01 23:50:00"),
    ("c7", "1.30", "103.85", "2024-13-01 07:25:00"),
]

SUPPLY = [
    ("d1", "1.30", "103.85", "2024-01-01 07:21:00"),
    ("d2", "1.30", "103.85", "2024-01-01 07:28:00"),
    ("d3", "1.29", "103.70", "2024-01-01 07:25:00"),
    ("d4", "", "103.85", "2024-01-01 23:55:00"),
    ("d5", "1.30", "103.85", "2024-01-01 07:30:00"),
    ("d6", "1.30", "103.85", "2024-13-01 07:25:00"),
]

_J1 = date(2024, 1, 1)

RATIO_KEYED = [
    ("w21z7h", _J1, "7-8", "20-30", 3, 2, 1.5),
    ("w21z7h", None, "7-8", "20-30", 1, 1, 1.0),
    ("w21zwm", _J1, "7-8", "20-30", 1, None, None),
    (None, _J1, "23-24", "50-60", 2, 1, 2.0),
    ("w21xrf", _J1, "7-8", "20-30", None, 1, None),
    ("w21z7h", _J1, "7-8", "30-40", None, 1, None),
]

RATIO = [row if row[4] is not None else (None,) * 4 + row[4:] for row in RATIO_KEYED]


def rows(df):
    """Rows in a stable order, for comparisons that ignore order."""
    return ordered(tuple(r) for r in df.collect())


def ordered(tuples):
    return sorted(tuples, key=lambda row: [(v is not None, str(v)) for v in row])
