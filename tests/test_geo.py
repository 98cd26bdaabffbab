import random

import pytest

from riskloom.operators import geo

RANGES = "lower_bound_ip_address string, upper_bound_ip_address string, country string"


def dotted(n):
    return ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))


def located(spark, ips, ranges, **options):
    df = spark.createDataFrame(list(enumerate(ips)), "id int, ip_address string")
    out = geo.locate_addresses(df, spark.createDataFrame(ranges, RANGES), **options)
    return [r["country"] for r in sorted(out.collect())]


KNOWN = [
    ("192.168.1.0", "192.168.1.255", "Localhost"), ("10.0.0.0", "10.0.0.255", "PrivateNet"),
    ("172.16.0.0", "172.16.0.255", "VPN"), ("2.0.0.0", "2.0.0.255", "Cloud"),
]


@pytest.mark.parametrize("limit", [10, 0])
def test_known_answers(spark, limit):
    ips = ["192.168.1.10", "10.0.0.5", "172.16.0.1", "1.1.1.1", "invalid.ip", None]
    want = ["Localhost", "PrivateNet", "VPN", "Unknown", "Unknown", "Unknown"]
    assert located(spark, ips, KNOWN, broadcast_ranges=limit) == want


def brute_force(ip, ranges):
    """The range with the greatest lower bound, accepted only up to its upper bound."""
    below = [(lo, hi, c or "") for lo, hi, c in ranges if lo <= ip]
    lo, hi, country = max(below, default=(0, -1, ""))
    return country if ip <= hi and country else "Unknown"


@pytest.mark.parametrize("limit,dense", [(10**6, 32), (0, 32), (10**6, 0), (0, 1)])
def test_overlapping_nested_and_crowded_ranges(spark, monkeypatch, limit, dense):
    monkeypatch.setattr(geo, "DENSE_BLOCK", dense)
    rng = random.Random(7)
    ranges = []
    for i in range(300):
        lo = rng.choice([rng.randrange(1 << 32), (5 << 24) + rng.randrange(1 << 17)])
        hi = min(lo + rng.choice([0, 5, 300, 70_000, 40_000_000]), (1 << 32) - 1)
        ranges.append((lo, hi, f"C{i}" if i % 50 else None))
    ranges += [(0, (1 << 32) - 1, "All"), (ranges[0][0], ranges[0][1] + 9, "Tie")]
    edges = [lo + d for lo, _, _ in ranges for d in (-1, 0, 1)] + [hi + d for _, hi, _ in ranges for d in (-1, 0, 1)]
    ips = [ip for ip in edges if 0 <= ip < 1 << 32] + [rng.randrange(1 << 32) for _ in range(500)]
    got = located(spark, [dotted(ip) for ip in ips], [(dotted(a), dotted(b), c) for a, b, c in ranges], broadcast_ranges=limit)
    assert got == [brute_force(ip, ranges) for ip in ips]


def test_ranges_beyond_four_octets(spark):
    ranges = [("999.0.0.0", "1000.0.0.0", "Far"), ("1.0.0.0", "1.0.0.9", "Near")]
    assert located(spark, ["999.5.0.0", "1001.0.0.0", "1.0.0.9", "1.0.0.10"], ranges) == ["Far", "Unknown", "Near", "Unknown"]


def test_unusable_bounds_and_existing_country(spark):
    df = spark.createDataFrame([("1.0.0.5", "old"), ("9.0.0.1", "old")], "ip_address string, country string")
    ranges = spark.createDataFrame([("1.0.0.0", "1.0.0.9", "New"), ("9.0.0.0", None, "Broken")], RANGES)
    out = geo.locate_addresses(df, ranges)
    assert sorted(r["country"] for r in out.collect()) == ["New", "Unknown"]
    assert out.columns == ["ip_address", "country"]


def test_nothing_to_match_against(spark):
    df = spark.createDataFrame([("1.0.0.5",)], "ip_address string")
    assert geo.locate_addresses(df, spark.createDataFrame([], RANGES)) is df
    assert geo.locate_addresses(df, spark.createDataFrame([("a",)], "x string")) is df
    assert geo.locate_addresses(df.withColumnRenamed("ip_address", "x"), spark.createDataFrame(KNOWN, RANGES)).columns == ["x"]
