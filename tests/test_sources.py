"""Delimited text fixtures (FIXTURES.md 3.3, 3.4)."""

import pytest

from skein.operators.recommend import clean_interactions
from skein.sources import ROUTES_SCHEMA, VIEWS_SCHEMA, parse_lines, read_delimited

ROUTE_LINES = [
    "2B,410,AER,2965,KZN,2990,,0,CR2",
    "2B,\\N,AER,\\N,KZN,2990,Y,0,CR2",
    "XX,1,AA",
    '"a,b",1,AA,1,BB,2,,0,CR2',
    "2B,410,AER,2965,KZN,2990,,0,",
]


def _write(tmp_path, name, lines):
    p = tmp_path / name
    p.write_text("\n".join(lines) + "\n")
    return str(p)


def test_reader_null_token_and_padding(spark, tmp_path):
    path = _write(tmp_path, "routes.dat", ROUTE_LINES)
    rows = read_delimited(spark, path, ROUTES_SCHEMA, null_token="\\N").collect()
    assert len(rows) == 5
    assert rows[0].codeshare is None and rows[0].source_airport_id == 2965
    assert rows[1].airline_id is None and rows[1].source_airport_id is None
    assert rows[2].airline == "XX" and rows[2].source_airport_id is None
    assert rows[3].airline == "a,b"
    assert rows[4].equipment is None


def test_parse_lines_unquoted_like_reference(spark):
    df = spark.createDataFrame([(x,) for x in ROUTE_LINES], "value string")
    good, rejects = parse_lines(df, "route", quoted=False)
    g = good.collect()
    assert len(g) == 2
    assert g[0].codeshare is None and g[0].equipment == "CR2"
    assert g[1].equipment is None
    assert sorted(r.line for r in rejects.collect()) == sorted(ROUTE_LINES[1:4])


def test_parse_lines_quoted(spark):
    df = spark.createDataFrame([(x,) for x in ROUTE_LINES], "value string")
    good, rejects = parse_lines(df, "route", quoted=True)
    airlines = sorted(r.airline for r in good.collect())
    assert airlines == ["2B", "2B", "a,b"]
    assert rejects.count() == 2


def test_parse_lines_fail_mode(spark):
    df = spark.createDataFrame([(x,) for x in ROUTE_LINES], "value string")
    good, _ = parse_lines(df, "route", quoted=True, on_bad="fail")
    with pytest.raises(Exception):
        good.count()


def test_airport_layout(spark):
    line = '1,"Goroka Airport","Goroka","Papua New Guinea","GKA","AYGA",-6.08,145.39,5282,10,"U"'
    df = spark.createDataFrame([(line,), ("2,x,y,z,\\N,\\N,1.0,2.0,3.0,5.5,E",)], "value string")
    good, rejects = parse_lines(df, "airport_extended", quoted=False)
    g = good.first()
    assert g.name == "Goroka Airport" and g.timezone == 10 and g.dst == '"U"'
    assert rejects.count() == 1  # fractional time zone does not parse as an int
    basic, _ = parse_lines(df, "airport", quoted=False)
    assert sorted(r.iata for r in basic.collect() if r.iata) == ["GKA"]


def test_views_drop_malformed(spark, tmp_path):
    path = _write(tmp_path, "views.csv", ["1,33842865744,mith,154,156", "bad,1,x,2,3", "2,5,y,7",
                                          "3,6,z,9,8", "4,7,,1,5"])
    raw = read_delimited(spark, path, VIEWS_SCHEMA, on_bad="drop")
    assert raw.count() == 3
    assert len(raw.collect()) == 3
    clean = clean_interactions(raw).collect()
    assert [(r.User_ID, r.Duration) for r in clean] == [(1, 2)]


def test_reader_fail_mode(spark, tmp_path):
    path = _write(tmp_path, "views_bad.csv", ["1,a,b,1,2", "bad,1,x,2,3"])
    with pytest.raises(Exception):
        read_delimited(spark, path, VIEWS_SCHEMA, on_bad="fail").collect()
    kept = read_delimited(spark, path, VIEWS_SCHEMA, on_bad="keep").collect()
    assert len(kept) == 2 and kept[1].User_ID is None


def test_airport_layout_quoted_keeps_commas(spark):
    line = '7,"Sao Paulo, Congonhas","Sao Paulo","Brazil","CGH","SBSP",-23.6,-46.6,2631'
    df = spark.createDataFrame([(line,)], "value string")
    good, rejects = parse_lines(df, "airport", quoted=True)
    g = good.first()
    assert g.name == "Sao Paulo, Congonhas" and g.iata == "CGH" and g.altitude == 2631.0
    assert rejects.count() == 0
    _, unquoted_rejects = parse_lines(df, "airport", quoted=False)
    assert unquoted_rejects.count() == 1  # the quoted comma shifts every later field


@pytest.mark.parametrize("quoted, parser", [(False, "split("), (True, "from_csv(")])
def test_parse_lines_parses_a_line_once(spark, quoted, parser):
    """Neither the good records nor the rejects write the parsing out again for each field that they test."""
    df = spark.range(3).selectExpr("concat(id, ',a,b,c') AS value")
    for part in parse_lines(df, "route", quoted=quoted):
        assert part._jdf.queryExecution().optimizedPlan().toString().count(parser) == 1
