"""Raw collision and complaint lines -> cleaned facts (edge rows)."""

import pytest

from arearisk.plans import city as C
from conftest import rows


def incident_line(date, time, zip_, ints, factors, vehicles, location=""):
    f = [date, time, "BROOKLYN", zip_, "40.6", "-73.9", location, "ON", "CROSS", "OFF"]
    f += [str(x) for x in ints] + list(factors) + ["KEY"] + list(vehicles)
    return ",".join(f)


INTS = [1, 0, 1, 0, 0, 0, 0, 0]
FAC = ["Glare", "", "", "", ""]
VEH = ["TAXI", "VAN", "", "", ""]


def lines(spark, data):
    return spark.createDataFrame([(x,) for x in data], "value string")


def test_collision_lines(spark):
    good29 = incident_line("3/5/2012", "14:30", "10001", INTS, FAC, VEH)
    good30 = incident_line("12/31/2013", "23:59", "10002", INTS, FAC, VEH, location='"(40.6, -73.9)"')
    late = incident_line("12/31/2013", "23:59", "10003", INTS, FAC, VEH).replace("23:59", "23:59", 1)
    too_early = incident_line("12/31/2011", "23:59", "10004", INTS, FAC, VEH)
    no_key = incident_line("3/5/2012", "14:30", "", INTS, FAC, VEH)
    short = ",".join(good29.split(",")[:28])
    header = "DATE,TIME,BOROUGH,ZIP CODE," + ",".join(["x"] * 25)
    df = C.incidents_from_lines(lines(spark, [header, good29, good30, late, too_early, no_key, short]))
    got = rows(df, "area", "per_i", "ped_i", "fac_1", "veh_1", "veh_2")
    assert got == [("10001", 1, 1, "Glare", "TAXI", "VAN"), ("10002", 1, 1, "Glare", "TAXI", "VAN"),
                   ("10003", 1, 1, "Glare", "TAXI", "VAN")]


def test_collision_bad_measure_fails_the_job(spark):
    bad = incident_line("3/5/2012", "14:30", "10001", ["x", 0, 0, 0, 0, 0, 0, 0], FAC, VEH)
    with pytest.raises(Exception):
        C.incidents_from_lines(lines(spark, [bad])).collect()


def request_line(created, kind, desc, zip_, city):
    return ",".join(["1", created, "", "DOT", "Dept", kind, desc, "Street", zip_, "addr", "street",
                     "c1", "c2", "i1", "i2", "type", city, "lm", "fac"])


def test_complaint_lines_realign(spark):
    data = [
        request_line("01/02/2012 03:05:00 PM", "Street Condition", "Pothole", "00083", "BRONX"),
        request_line("01/02/2012 03:05:00 PM", "Street Condition", "Rough, Pitted", "10001", "BRONX"),
        request_line("01/02/2012 03:05:00 AM", "Street Sign - Missing", "No Parking, Standing, Stopping",
                     "10002", "QUEENS"),
        request_line("n/a", "Street Condition", "Pothole", "10003", "BRONX"),          # bad date
        request_line("01/02/2012 03:05:00 PM", "Street Condition", "Pothole", "", "BRONX"),  # empty zip
        request_line("01/02/2012 03:05:00 PM", "Noise - Street", "Loud", "10004", "BRONX"),  # noise
        request_line("01/02/2014 03:05:00 PM", "Street Condition", "Pothole", "10005", "BRONX"),  # late
        request_line("01/02/2012 03:05:00 PM", "Street Condition", "Pothole", "10006", ""),  # no city
    ]
    header = request_line("Created Date", "Complaint Type", "Descriptor", "Incident Zip", "City")
    got = rows(C.requests_from_lines(lines(spark, [header] + data), header), "area", "kind", "descriptor", "city")
    assert got == [("10001", "Street Condition", "Rough  Pitted", "BRONX"),
                   ("10002", "Street Sign - Missing", "No Parking  Standing  Stopping", "QUEENS"),
                   ("83", "Street Condition", "Pothole", "BRONX")]


def test_segment_lines(spark):
    head = "ID,Segment ID,Roadway Name,From,To,Direction,Date," + ",".join(f"h{i}" for i in range(24))
    day1 = "1,7,WEST 14 ST,3 AVE,2 AVE,NB,01/01/2012," + ",".join(["10"] * 23 + ["x"])
    day2 = "2,7,W 14 STREET,3 AVE,2 AVE,NB,01/02/2012," + ",".join(["1"] * 24)
    got = C.segments_from_lines(lines(spark, [head, day1, day2])).collect()
    assert [(r.segment, r.roadway, r.vehicles, r.samples) for r in got] == [("7", "WEST 14 ST", 254, 2)]


def test_segment_lines_to_area_volume(spark):
    head = "ID,Segment ID,Roadway Name,From,To,Direction,Date," + ",".join(f"h{i}" for i in range(24))
    rows_ = [
        "1,7,WEST 14 ST,3 AVE,2 AVE,NB,01/01/2012," + ",".join(["10"] * 24),    # 240
        "2,7,WEST 14 ST,3 AVE,2 AVE,NB,01/02/2012," + ",".join(["5"] * 24),     # 120
        "3,8,AVE OF THE AMER,22 ST,23 ST,NB,01/01/2012," + ",".join(["1"] * 24),  # 24, unresolved '23rd ST'
    ]
    lookup = spark.createDataFrame([("WEST 14th ST", "10011"), ("3rd AVE", "10003"), ("2nd AVE", "10003"),
                                    ("AVE OF THE AMERICAS", "10001"), ("22nd ST", "10001")],
                                   "name string, postcode string")
    got = rows(C.segment_volume_from_lines(lines(spark, [head] + rows_), lookup))
    # road 10011, from = to = 10003: from gets two thirds, road one third (360 vehicles, 2 samples)
    assert got == [("10003", 240, 0), ("10011", 120, 0)]
