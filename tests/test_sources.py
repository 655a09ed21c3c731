"""Readers: wide date matrices, header/detail text, nested JSON, typed long."""
import json

import pytest
from pyspark.sql import functions as F

from tidepanel.sources.long import ContractError, read_typed_long, schema_contract
from tidepanel.sources.nested import read_nested_json
from tidepanel.sources.text import parse_header_detail, read_lines
from tidepanel.sources.wide import read_wide_dates


def _write(path, text):
    path.write_text(text)
    return str(path)


def test_wide_dates_edge_rows(spark, tmp_path):
    csv = ("RegionID,SizeRank,RegionName,RegionType,StateName,2020-01-31,2020-02-29\n"
           "1,1,Alpha,msa,FL,100,\n"          # empty cell dropped
           "2,2,Beta,msa,FL,abc,200\n"        # non-numeric dropped
           "3,3,,msa,FL,5,6\n"                # empty entity dropped
           "4,4,Gamma,msa,GA,7,8\n"           # other state dropped
           "5,5,Delta,county,FL,9,10\n"       # other region type dropped
           "6,6,Alpha,msa,FL,150,160\n")      # same entity again: last row wins
    f = _write(tmp_path / "price_index.csv", csv)
    long = read_wide_dates(spark, {"price_index": f, "missing_metric": str(tmp_path / "nope.csv")},
                           filters={"StateName": "FL", "RegionType": "msa"})
    got = sorted((r.entity, str(r.date), r.metric, r.value) for r in long.collect())
    assert got == [("Alpha", "2020-01-31", "price_index", 150.0), ("Alpha", "2020-02-29", "price_index", 160.0),
                   ("Beta", "2020-02-29", "price_index", 200.0)]


def test_header_detail_parse(spark, tmp_path):
    a = ("AL092004, FRANCES, 34,\n"
         "20040825, 1800, , TD, 13.7N, 42.2W, 30, 1009\n"
         "20040826, 0000, L, TS, 10.0S, 20.0E, -99, -999\n"
         "20040826, 0600, , TS, 1x.0N, 20.0W, 40, 1000\n"      # bad latitude: dropped
         "20040826, 1200, , TS, 14.0N, 21.0W\n"                # fewer than 8 fields: skipped
         "2004082, 1800, , TS, 14.0N, 21.0W, 40, 1000\n"       # 7-digit date: skipped
         "EP012005, ADRIAN, 5,\n"
         "20050517, 1800, , TD, 28.0N, 80.1W, , x\n")
    b = ("20990101, 0000, , TD, 1.0N, 1.0W, 10, 1000\n"        # before any header: skipped
         "CP012006, KEONI, 2,\n"
         "20060101, 0000, , TD, 5.0N, 170.0W, 25, 1005\n")
    paths = [_write(tmp_path / "a.txt", a), _write(tmp_path / "b.txt", b)]
    pts = parse_header_detail(read_lines(spark, paths))
    got = sorted((r.storm_id, r.storm_name, r.date, r.lat, r.lon, r.max_wind, r.min_pressure) for r in pts.collect())
    assert got == [
        ("AL092004", "FRANCES", "20040825", 13.7, -42.2, 30, 1009),
        ("AL092004", "FRANCES", "20040826", -10.0, 20.0, None, None),
        ("CP012006", "KEONI", "20060101", 5.0, -170.0, 25, 1005),
        ("EP012005", "ADRIAN", "20050517", 28.0, -80.1, None, None),
    ]


def test_header_carry_across_blocks(spark):
    """A header in an earlier block covers lines of later blocks."""
    lines = [("f", 0, 0, "AL012000, ONE, 1,")]
    lines += [("f", b, b * 10 + i, f"20000101, 0000, , TD, {b}.0N, 1.0W, 10, 1000")
              for b in range(0, 3) for i in range(1, 3)]
    lines += [("f", 3, 31, "AL022000, TWO, 1,"), ("f", 3, 32, "20000102, 0000, , TD, 9.0N, 1.0W, 10, 1000")]
    df = spark.createDataFrame(lines, "file string, block long, pos long, line string")
    pts = parse_header_detail(df)
    got = sorted((r.storm_id, r.lat) for r in pts.collect())
    assert got == [("AL012000", 0.0)] * 2 + [("AL012000", 1.0)] * 2 + [("AL012000", 2.0)] * 2 + [("AL022000", 9.0)]


def test_header_carry_in_scan_order(spark, tmp_path):
    """Lines of a scan keep their tasks: no line is shuffled or sorted, and the points are those of the windowed way, in
    files of one block and of many, with headers blocks away, at block ends, twice in a row or missing."""
    detail = "200001{:02d}, 0000, , TD, {}.0N, 1.0W, 10, 1000\n"
    for f in range(3):
        text = detail.format(1, 59) if f == 1 else ""  # before any header
        for h in range(40):
            text += f"AL{f}{h:02d}2000, N{h}, 1,\n" + "".join(detail.format(d % 28 + 1, (h + d) % 60) for d in range([0, 1, 3, 40, 7][h % 5]))
        _write(tmp_path / f"t{f}.txt", text)
    _write(tmp_path / "no_header.txt", detail.format(2, 5) * 30)
    _write(tmp_path / "empty.txt", "")

    def points(in_order):
        got = parse_header_detail(read_lines(spark, str(tmp_path)), in_order=in_order)
        return got, sorted(map(str, got.collect()))

    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for split in ("128m", "700b", "90b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000" if split == "700b" else "7")
            plain, want = points(False)
            got, have = points(True)
            assert have == want and len(have) == 3 * 8 * 51
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert "Exchange hashpartitioning" not in plan and "Window" not in plan and "Sort " not in plan
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old[1])


def test_nested_json_defaults(spark, tmp_path):
    doc = {"data": [
        {"name": "Hurricane X (May 2001)", "begDate": 20010501, "endDate": 20010503, "adjCost": 1500.0, "deaths": 3},
        {"name": "Tropical Storm Y", "begDate": 20020601, "endDate": 20020602},
        {"name": "Severe Heat", "begDate": 200307, "endDate": 20030702, "adjCost": 10.0, "deaths": 0},
    ]}
    f = _write(tmp_path / "events.json", json.dumps(doc, indent=2))
    ev = read_nested_json(spark, f)
    got = sorted((r.name, r.year, r.cost, r.deaths) for r in ev.collect())
    assert got == [("Hurricane X (May 2001)", 2001, 1500.0, 3), ("Severe Heat", 2003, 10.0, 0),
                   ("Tropical Storm Y", 2002, 0.0, 0)]


def test_typed_long_and_contract(spark, tmp_path):
    f = _write(tmp_path / "long.csv", "entity,date,metric,value\nA,2020-01-31,m,1.5\nB,bad,m,2\nC,2020-02-29,m,x\n")
    df = read_typed_long(spark, f)
    got = sorted((r.entity, str(r.date), r.value) for r in df.collect())
    assert got == [("A", "2020-01-31", 1.5), ("B", "None", 2.0), ("C", "2020-02-29", None)]
    with pytest.raises(ContractError):
        schema_contract(df, ["entity", "date", "absent"])
    with pytest.warns(UserWarning):
        kept = schema_contract(df, ["entity", "date"], ["value", "other"])
    assert kept.columns == ["entity", "date", "value"]
