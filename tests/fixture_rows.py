"""Hand-made raw rows for the edge cases listed in FIXTURES.md."""

STATIONS = [
    ("0012", "Clark & Lake", "41.886", "-87.631"),
    ("S1", "Dup Name", "41.0", "-87.0"),
    ("S2", "Dup Name", "41.1", "-87.1"),
    ("S3", "Zeta", "1", "2"),
    ("S3", "Alpha", "3", "4"),
    (None, "no id", "0", "0"),
]

RIDERS = [
    ("1", "Ann", "Lee", "a", "1990-02-28", "2015-01-01", None, "true"),
    ("2", "Bo", "Ray", "b", "1992-02-29", "2016-05-05", "2017-01-01", "false"),
    ("3", "Cy", "Day", "c", "1980-06-15", "2014-01-01", None, None),
    ("x", "Bad", "Id", "d", "1990-01-01", "2015-01-01", None, "true"),
    ("", "Empty", "Id", "e", "1990-01-01", "2015-01-01", None, "true"),
    ("4", "Zed", "Two", "f", "1985-01-01", "2015-01-01", None, "false"),
    ("4", "Abe", "One", "g", "1986-01-01", "2015-01-01", None, "true"),
]

PAYMENTS = [
    ("10", "2021-03-05", "12.50", "1"),
    ("11", "2021-03-06", "n/a", "1"),
    ("12", "not-a-date", "3.00", "2"),
    ("13", None, "4.00", "2"),
    ("x", "2021-03-07", "1.00", "1"),
    ("14", "2021-03-07", "1.00", "y"),
    ("15", "2021-04-01", "0.01", "3"),
    ("16", "2021-04-02", "0.02", "3"),
]

TRIPS = [
    ("T1", "classic", "2021-03-05 10:00:00", "2021-03-05 10:30:00", "0012", "S1", "1"),
    ("T2", "classic", "2021-03-05 10:00:00", "2021-03-05 09:59:00", "S1", "S2", "1"),
    ("T3", "classic", "2021-03-05 10:00:00", "2021-03-05 10:00:00", "S1", None, "2"),
    ("T3", "classic", "2021-03-05 11:00:00", "2021-03-05 11:01:00", "S2", "S1", "2"),
    ("T4", "electric", "2021-12-31 23:50:00", "2022-01-01 00:10:00", "S3", "S3", "99"),
    ("T5", "electric", "not-a-time", "2021-03-05 10:00:00", "S1", "S1", "1"),
    ("T6", "electric", "2021-03-05 10:00:00", "2021-03-05 10:00:00", "S1", "S1", "x"),
    (None, "electric", "2021-03-05 10:00:00", "2021-03-05 10:00:00", "S1", "S1", "1"),
    ("T7", "electric", "2021-02-28 12:00:00", "2021-02-28 12:00:30", "S1", "S1", "2"),
    ("T8", "electric", "2020-02-27 12:00:00", "2020-02-27 12:01:00", "S1", "S1", "1"),
    ("T9", "electric", "2020-02-28 00:00:00", "2020-02-28 00:01:00", "S1", "S1", "1"),
    ("T10", "electric", "2021-03-31 23:59:00", "2021-04-01 00:01:00", "S1", "ZZ", "3"),
]
