"""Small files written by their format descriptions, read back."""

import struct

import numpy as np
import pytest

from blockfuse.operators import joins
from blockfuse.sources import points


def bin_file(kind, rows):
    """A BIN file of rows (first, country, region, city, lat, lon, zip), with the columns that the type has."""
    columns = 7 if kind in (9, 11) else 6 if kind == 5 else 2
    names, strings = {}, b""
    start = 64
    pool = start + len(rows) * columns * 4

    def put(s, key):
        nonlocal strings
        if key not in names:
            names[key] = pool + len(strings)
            strings += bytes([len(s.encode())]) + s.encode()
        return names[key]

    body = b""
    for first, country, region, city, lat, lon, code in rows:
        row = struct.pack("<II", first, put(country, ("c", country)))
        if columns > 2:
            row += struct.pack("<II", put(region, region), put(city, city)) + struct.pack("<ff", lat, lon)
        if columns > 6:
            row += struct.pack("<I", put(code, code))
        body += row
    head = bytes([kind, columns, 24, 1, 1]) + struct.pack("<IIIIII", len(rows), start + 1, 0, 1, 1, 1)
    return head.ljust(start, b"\0") + body + strings


ROWS = [(0, "-", "-", "-", 0.0, 0.0, "-"), (16777216, "AU", "Queensland", "Brisbane", -27.5, 153.0, "4000"), (16777472, "CN", "Fujian", "Füzhou", 26.0, 119.25, "")]


@pytest.mark.parametrize("kind", [1, 5, 11])
def test_ip2location(spark, tmp_path, kind):
    path = tmp_path / "x.bin"
    path.write_bytes(bin_file(kind, ROWS))
    got = [tuple(r) for r in points.ip2location(spark, str(path)).orderBy("ip_start").collect()]
    ends = [r[0] - 1 for r in ROWS[1:]] + [points.LAST]
    want = [
        (first, end, c, r if kind > 1 else "", t if kind > 1 else "", z if kind == 11 else "", lat if kind > 1 else 0.0, lon if kind > 1 else 0.0)
        for (first, c, r, t, lat, lon, z), end in zip(ROWS, ends)
    ]
    assert got == want
    hit = joins.point_in_range(spark.createDataFrame([(16777300,)], "addr long"), points.ip2location(spark, str(path)), ["country_short"])
    assert hit.first().country_short == "AU"


def sx_file():
    """Two countries, one region, two cities; octets 1 (two items), 2 (one), 10 (reserved) and 11 (an item that begins late)."""
    country, region, city = "T:id/c2:iso/n2:lat/n2:lon/b:name_ru/b:name_en", "S:country_seek/M:id/b:name_ru/b:name_en/b:iso", "M:region_seek/T:country_id/M:id/N5:lat/N5:lon/b:name_ru/b:name_en"
    z = lambda s: s.encode() + b"\0"
    ru = bytes([1]) + b"RU" + struct.pack("<hh", 6000, 10000) + z("Россия") + z("Russia")
    kz = bytes([2]) + b"KZ" + struct.pack("<hh", 4800, 6800) + z("Казахстан") + z("Kazakhstan")
    countries = b"\0" + ru + kz
    regions = b"\0" + struct.pack("<H", 1) + (7).to_bytes(3, "little") + z("Область") + z("Oblast") + z("RU-X")
    one = (1).to_bytes(3, "little") + bytes([1]) + (9).to_bytes(3, "little") + struct.pack("<ii", 5575000, 3762000) + z("Москва") + z("Moscow")
    two = (0).to_bytes(3, "little") + bytes([2]) + (8).to_bytes(3, "little") + struct.pack("<ii", 4325000, -7690000) + z("Алматы") + z("Almaty")
    cities = countries + one + two
    at_one, at_two, at_kz = len(countries), len(countries) + len(one), 1 + len(ru)
    item = lambda low, seek: low.to_bytes(3, "big") + seek.to_bytes(3, "big")
    items = [item(0, at_one), item(65536, at_kz), item(500, at_two), item(256, at_one), item(512, 0)]
    index = [0, 2, 3, 3, 3, 3, 3, 3, 3, 3, 3, 5]
    pack = "\0".join((country, region, city)).encode()
    head = struct.pack(">3sBIBBBHHIBHHIIHIH", b"SxG", 22, 0, 2, 0, len(index), 1, 1, len(items), 3, 200, 200, len(regions), len(cities), 100, len(countries), len(pack))
    return head + pack + struct.pack(f">{len(index)}I", *index) + struct.pack(">I", 0) + b"".join(items) + regions + cities


def test_sypex(spark, tmp_path):
    path = tmp_path / "x.dat"
    path.write_bytes(sx_file())
    got = {r.ip_start: tuple(r)[1:] for r in points.sypex(spark, str(path)).collect()}
    moscow, almaty, kz = ("RU", "Oblast", "Moscow", "Москва", 55.75, 37.62), ("", "", "Almaty", "Алматы", 43.25, -76.9), ("KZ", "", "", "", 48.0, 68.0)
    assert got == {
        1 << 24: ((1 << 24) + 65535, *moscow),
        (1 << 24) + 65536: ((2 << 24) - 1, *kz),
        2 << 24: ((3 << 24) - 1, *almaty),
        11 << 24: ((11 << 24) + 255, *almaty),  # before the first start of the octet: the item before
        (11 << 24) + 256: ((11 << 24) + 511, *moscow),
    }
    with pytest.raises(ValueError):
        list(points.sypex_entries(b"xyz" + bytes(60)))
    assert np.all(np.diff(sorted(got)) > 0)
