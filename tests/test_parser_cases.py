"""Every branch and trap of the parse/enrich rules, as data rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from logsift.functions import enrich as E
from logsift.sources.logs import parse_all, parse_events

ARRIVAL = dt.datetime(2030, 1, 1, 0, 0, 0)


def parse(spark, lines):
    df = spark.createDataFrame([(i, l, ARRIVAL) for i, l in enumerate(lines)], "line_id long, line string, ingested_at timestamp")
    return {r["line_id"]: r.asDict() for r in parse_all(df).collect()}


def test_combined_line(spark):
    r = parse(spark, ['192.168.44.7 - kim [17/Mar/2021:23:59:08 +0530] "PUT /shelf/9?x=1 HTTP/2" 206 88017 "http://shop.example/a" "Lynx/2.9 test"'])[0]
    assert (r["kind"], r["ip"], r["method"], r["url"], r["status"], r["bytes"], r["user_agent"]) == (
        "A", "192.168.44.7", "PUT", "/shelf/9?x=1", 206, 88017, "Lynx/2.9 test")
    assert r["referer"] == "http://shop.example/a"
    assert r["timestamp"] == dt.datetime(2021, 3, 17, 23, 59, 8)  # offset ignored


def test_invalid_and_blank(spark):
    out = parse(spark, ["kernel: eth0 up", "   ", "\t"])
    assert out[0]["kind"] == "X"
    assert set(out) == {0}  # blank lines dropped before parsing, not rejects


def test_dash_bytes_and_common_format(spark):
    out = parse(spark, [
        'fe80::9 - - [05/Nov/2019:06:07:08 +0000] "DELETE /cart/3 HTTP/1.1" 410 - "-" "robot one"',
        'host.example - - [05/Nov/2019:06:07:08 +0000] "HEAD /pics/ HTTP/1.0" 200 731',
        '203.0.113.5 - - [05/Nov/2019:06:07:08 +0000] "GET / HTTP/1.0" 200 12.5',
        '203.0.113.5 - - [05/Nov/2019:06:07:08 +0000] "GET / HTTP/1.0" 200 99999999999999999999',
        '203.0.113.5 - - [05/Nov/2019:06:07:08 +0000] "GET / HTTP/1.0" 200 7 trailing text is accepted',
    ])
    assert out[0]["bytes"] == 0 and out[0]["status"] == 410
    assert (out[1]["referer"], out[1]["user_agent"], out[1]["bytes"]) == ("", "", 731)
    assert out[2]["bytes"] == 0 and out[3]["bytes"] == 0
    assert out[4]["kind"] == "A" and out[4]["bytes"] == 7


def test_request_must_have_three_tokens(spark):
    out = parse(spark, ['203.0.113.5 - - [05/Nov/2019:06:07:08 +0000] "GET /" 200 1',
                        '203.0.113.5 - - [05/Nov/2019:06:07:08 +0000] "GET /a b HTTP/1.0" 200 1'])
    assert out[0]["kind"] == "X" and out[1]["kind"] == "X"


def test_error_format(spark):
    out = parse(spark, [
        "[Tue Aug 18 21:03:05 2015] [error] [client 198.51.100.20] script timed out",
        "[Tue Aug 18 21:03:05 2015] [notice] caught SIGTERM, shutting down",
        "[Tue Aug 18 21:03:05 2015] [error] [client 198.51.100.20]",
        "[Fri Aug 18 21:03:05 2015] [notice] wrong weekday parses",
        "[Xyz Aug 18 21:03:05 2015] [notice] bad weekday falls back",
        "[Sun Feb 30 21:03:05 2015] [notice] bad date falls back",
        "[Tue Aug 18 21:03:05 2015] [core:error] not a level",
        "[Tue Aug 18 21:03:05 2015] [notice] " + "m" * 150,
    ])
    e = out[0]
    assert (e["ip"], e["method"], e["status"], e["bytes"], e["referer"], e["user_agent"]) == (
        "198.51.100.20", "LOG", 400, 0, "client 198.51.100.20", "error")
    assert e["timestamp"] == dt.datetime(2015, 8, 18, 21, 3, 5)
    assert (out[1]["ip"], out[1]["status"]) == ("", 200)
    assert (out[2]["url"], out[2]["ip"], out[2]["referer"]) == ("[client 198.51.100.20]", "", "")
    assert out[3]["timestamp"] == dt.datetime(2015, 8, 18, 21, 3, 5)
    assert out[4]["timestamp"] == ARRIVAL and out[5]["timestamp"] == ARRIVAL
    assert out[6]["kind"] == "X"
    assert len(out[7]["url"]) == 100


def enrich_row(spark, ip="", ua="", status=200, url="/"):
    df = spark.createDataFrame([(ip, ua, status, url)], "ip string, user_agent string, status int, url string")
    return df.select(E.ip_class(F.col("ip")).alias("c"), E.browser(F.col("user_agent")).alias("b"),
                     E.operating_system(F.col("user_agent")).alias("o"),
                     E.suspicious(F.col("status"), F.col("url")).alias("s")).collect()[0]


@pytest.mark.parametrize("ip,cls", [("192.168.200.3", "private"), ("203.0.113.9", "public"), ("11.0.0.1", "public"),
                                    ("172.200.0.1", "private"), ("127.0.0.1", "localhost"), ("", "public"),
                                    ("10.9.9.9", "private")])
def test_ip_class(spark, ip, cls):
    assert enrich_row(spark, ip=ip)["c"] == cls


@pytest.mark.parametrize("ua,browser,os_", [
    ("Firefox/128.0 on Windows 11", "Firefox", "Windows"),
    ("Safari/605.1 Chrome/126.0 (Mac OS X 14)", "Chrome", "macOS"),
    ("Mozilla/5.0 (Linux; Android 13) Chrome/110.0", "Chrome", "Linux"),
    ("Mozilla/5.0 (iPhone; CPU iPhone OS 16_0 like Mac OS X) Safari/604.1", "Safari", "macOS"),
    ("Mozilla/4.0 (compatible; MSIE 8.0; Windows NT 6.1; Trident/4.0)", "Internet Explorer", "Windows"),
    ("robot one", "Other", "Other"),
    ("Dalvik, Android 14", "Other", "Android"),
    ("reader on an iPad", "Other", "iOS"),
])
def test_user_agent(spark, ua, browser, os_):
    r = enrich_row(spark, ua=ua)
    assert (r["b"], r["o"]) == (browser, os_)


@pytest.mark.parametrize("status,url,flag", [(451, "/shelf/9", True), (200, "/get?f=../../secret", True),
                                             (200, "/shelf/9", False), (200, "/x?CMD=ls", True),
                                             (200, "/q?<SCRIPT>", True), (399, "/", False), (500, "/", True)])
def test_suspicious(spark, status, url, flag):
    assert enrich_row(spark, status=status, url=url)["s"] is flag


def test_raw_line_rule(spark):
    df = spark.createDataFrame([('x "GET / HTTP/1.0" 404 1',), ("[t] [error] x",), ("x wget y",), ("plain",)], "line string")
    got = [r[0] for r in df.select(E.suspicious_line(F.col("line"))).collect()]
    assert got == [True, False, True, False]


def test_separator_inside_a_field_falls_back_exactly(spark):
    line = '203.0.113.5 - - [05/Nov/2019:06:07:08 +0000] "GET /a\u0001b HTTP/1.0" 200 5 "r\u0001x" "ua"'
    r = parse(spark, [line])[0]
    assert (r["url"], r["referer"], r["user_agent"], r["bytes"]) == ("/a\u0001b", "r\u0001x", "ua", 5)


def test_events_drop_rejects(spark):
    df = spark.createDataFrame([(0, "junk", ARRIVAL), (1, "[Tue Aug 18 21:03:05 2015] [error] x", ARRIVAL)],
                               "line_id long, line string, ingested_at timestamp")
    rows = parse_events(df).collect()
    assert [r["line_id"] for r in rows] == [1] and rows[0]["suspicious"] is True
