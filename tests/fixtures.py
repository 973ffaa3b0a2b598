"""Hand-made reference-shaped tables with the edge rows of FIXTURES.md part A."""

from __future__ import annotations

import csv
import os

INCIDENT_HEADER = ["DR_NO", "Date Rptd", "DATE OCC", "TIME OCC", "AREA ", "Premis Desc",
                   "Vict Age", "Vict Descent", "Weapon Used Cd", "LAT", "LON"]
LAST_HEADER = ["DR_NO", "Date Rptd", "Date OCC", "TIME OCC", "AREA ", "Premis Desc",
               "Vict Age", "Vict Descent", "Weapon Used Cd", "LAT", "LON"]


def d(m, day, y, h=12, ampm="AM"):
    return f"{m:02d}/{day:02d}/{y} {h:02d}:00:00 {ampm}"


def row(no, date, time="1200", area="1", prem="STREET", age="30", desc="W",
        weapon="100", lat="34.1", lon="-118.3"):
    return [str(no), date, date, time, area, prem, age, desc, weapon, lat, lon]


def incident_parts():
    """Four parts; part 4 repeats a row of part 1 and spells a header differently."""
    p1 = [
        row(1, d(1, 5, 2010), "0000"), row(2, d(1, 6, 2010), "0459"),
        row(3, d(2, 1, 2010), "0500"), row(4, d(2, 2, 2010), "1159"),
        row(5, "bad date", "1200"), row(6, d(3, 3, 2010), None),
        row(7, d(3, 4, 2010), "1659", desc=None), row(8, d(4, 1, 2010), "1700", desc="Q"),
    ]
    p2 = [
        row(9, d(4, 2, 2010), "2059", lat="0", lon="0"), row(10, d(5, 1, 2010), "2100", lat="0.0", lon="0.0"),
        row(11, d(5, 2, 2010), "2359", lat=None, lon=None), row(12, d(6, 1, 2011), "5", weapon=None),
        row(13, d(6, 2, 2011), "930", weapon="x"), row(14, d(7, 1, 2011), "1200", weapon="99"),
    ]
    p3 = [
        row(15, d(7, 2, 2011), "1300", weapon="199"), row(16, d(8, 1, 2011), "1400", weapon="200"),
        row(17, d(1, 1, 2012), "1500", age="x", prem="PARKING LOT"),
        # same (date, lat, lon) as 18 but a different row: both count
        row(18, d(2, 1, 2012, 1, "PM"), "1600", area="01"),
        row(19, d(2, 1, 2012, 1, "PM"), "1600", area="2"),
    ]
    p4 = [
        p1[0],                                    # duplicate across parts
        row(20, d(3, 1, 2020), "0800", lat="34.10", lon="-118.30"),
        row(21, d(3, 2, 2020), "0900", lat="34.2", lon="-118.4", desc="B"),
    ]
    return p1, p2, p3, p4


def write_csv(path, header, rows):
    with open(path, "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(header)
        for r in rows:
            w.writerow(["" if v is None else v for v in r])
    return path


def write_incident_csvs(folder):
    paths = []
    for i, rows in enumerate(incident_parts(), 1):
        header = LAST_HEADER if i == 4 else INCIDENT_HEADER
        paths.append(write_csv(os.path.join(folder, f"part{i}.csv"), header, rows))
    return paths


def parts_df(spark, folder):
    from citypulse.sources.csv import read_header_csv
    return [read_header_csv(spark, p, trim=False) for p in write_incident_csvs(folder)]
