"""Generated log lines: each is put together from known fields, and the parse
must give those fields back.  Near misses are written out one by one."""

import datetime as dt
import random

from logsift.sources.logs import parse_all

ARRIVAL = dt.datetime(2030, 1, 1)
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
#: text of the size field -> its value
SIZES = {"-": 0, "0": 0, "123": 123, "12.5": 0, "99999999999999999999": 0, "-5": -5, "\u0001": 0, "9223372036854775807": 2**63 - 1, "x": 0}
WORDS = ["a", "/x", "::1", "10.0.0.7", "é", "a\u0001b", "\u0085", "{}", "--", "%20", "ü1"]


def moment(rnd):
    return dt.datetime(rnd.randrange(1970, 2038), rnd.randrange(1, 13), rnd.randrange(1, 29), rnd.randrange(24), rnd.randrange(60), rnd.randrange(60))


def access_line(rnd):
    t = moment(rnd)
    month = MONTHS[t.month - 1]
    stamp, when = rnd.choice([
        (f"{t.day:02d}/{month}/{t.year}:{t:%H:%M:%S}", t), (f"{t.day}/{month}/{t.year}:{t.hour}:{t.minute}:{t.second}", t),
        (f"31/Feb/{t.year}:{t:%H:%M:%S}", ARRIVAL), (f"{t.day}/Foo/{t.year}:{t:%H:%M:%S}", ARRIVAL), (f"{t.day:02d}/{month}/{t.year}", ARRIVAL)])
    ip, user, method, url, proto = (rnd.choice(WORDS) for _ in range(5))
    status, size = rnd.randrange(100, 1000), rnd.choice(list(SIZES))
    line = f'{ip} {user} - [{stamp} {rnd.choice(["+0000", "-0400"])}] "{method} {url} {proto}" {status} {size}'
    referer, agent = rnd.choice(["", "-", "http://r/", "x\u0001y", "two words"]), rnd.choice(["", "curl/7.0", "Mozilla/5.0 (Windows)", "z\u0001"])
    if rnd.random() < 0.5:
        line += f' "{referer}" "{agent}"' + rnd.choice(["", " 17", ' "x"'])
    else:
        referer = agent = ""
        line += rnd.choice(["", " trailing", ' "alone"'])
    return line, {"kind": "A", "ip": ip, "timestamp": when, "method": method, "url": url, "status": status, "bytes": SIZES[size],
                  "referer": referer, "user_agent": agent}


def error_line(rnd):
    t = moment(rnd)
    day, month = rnd.choice(["Mon", "Sun", "sat"]), MONTHS[t.month - 1]
    stamp, when = rnd.choice([
        (f"{day} {month} {t.day:02d} {t:%H:%M:%S} {t.year}", t), (f"{day}  {month} {t.day} {t.hour}:{t.minute}:{t.second} {t.year}", t),
        (f"Xyz {month} {t.day} {t:%H:%M:%S} {t.year}", ARRIVAL), (f"{month} {t.day} {t:%H:%M:%S} {t.year}", ARRIVAL), (f"{t.year}", ARRIVAL)])
    level, status = rnd.choice([("error", 400), ("notice", 200), ("Error", 200), ("warn", 200), ("_1", 200)])
    context, ip = rnd.choice([("", ""), ("client 1.2.3.4", "1.2.3.4"), ("client 5.6.7.8:80", "5.6.7.8"), ("pid 12", ""), ("client \u0001 9.9.9.9", ""),
                              ("x client\t7.7 y", "7.7"), ("client ...", "...")])
    message = rnd.choice(["File does not exist: /x", "a" * 150, "m\u0001n", "é" * 100 + "z", "\u2028x", "] [x]"])
    line = f"[{stamp}] [{level}] " + (f"[{context}] " if context else "") + message
    return line, {"kind": "E", "ip": ip, "timestamp": when, "method": "LOG", "url": message[:100], "status": status, "bytes": 0, "referer": context,
                  "user_agent": level}


#: line -> the format it is in, X for none
NEAR = {
    '1.2.3.4 - - [01/Jul/1995:00:00:01 -0400] "GET /a HTTP/1.0" 200 5': "A",
    '1.2.3.4 - - [01/Jul/1995:00:00:01 -0400] "GET /a b HTTP/1.0" 200 5': "X",
    '1.2.3.4 - - [01/Jul/1995:00:00:01 -0400] "GET /a" 200 5': "X",
    '1.2.3.4 - - [01/Jul/1995:00:00:01 0400] "GET /a HTTP/1.0" 200 5': "X",
    '1.2.3.4 - - [01/Jul/1995:00:00:01 +05] "GET /a HTTP/1.0" 200 5': "X",
    '1.2.3.4 - - [01/Jul/1995:00:00:01 -0400] "GET /a HTTP/1.0" 20 5': "X",
    '1.2.3.4 - - [01/Jul/1995:00:00:01 -0400] "GET /a HTTP/1.0" 2000 5': "X",
    '1.2.3.4 - - [01/Jul/1995:00:00:01 -0400] "GET /a HTTP/1.0" 200': "X",
    '1.2.3.4 - [01/Jul/1995:00:00:01 -0400] "GET /a HTTP/1.0" 200 5': "X",
    '1.2.3.4 - - [01/Jul/1995:00:00:01.5 -0400] "GET /a HTTP/1.0" 200 5': "X",
    "[Sun Mar 07 16:02:00 2004] [error] x": "E",
    "[Sun Mar 07 16:02:00 2004] [error]": "X",
    "[Sun Mar 07 16:02:00 2004] [core:error] x": "X",
    "[Sun Mar 07 16:02:00.123 2004] [error] x": "X",
    "[Sun Mar 07 16:02:00 2004] [] x": "X",
    "Sun Mar 07 16:02:00 2004 [error] x": "X",
    "[] [error] x": "X",
    "garbage": "X",
}


def test_generated_lines_give_their_fields_back(spark):
    rnd = random.Random(2024)
    made = [rnd.choice([access_line, error_line])(rnd) for _ in range(3000)] + [(line, {"kind": kind}) for line, kind in NEAR.items()]
    padded = [rnd.choice(["", "", " ", "\t", "  \t"]) + line + rnd.choice(["", "", " ", "\r", "\t "]) for line, _ in made]
    rows = [(i, line, ARRIVAL) for i, line in enumerate(padded)] + [(10_000 + i, line, ARRIVAL) for i, line in enumerate(["", " ", "\t\r", None])]
    got = {r["line_id"]: r.asDict() for r in parse_all(spark.createDataFrame(rows, "line_id long, line string, ingested_at timestamp")).collect()}
    assert sorted(got) == list(range(len(made)))
    for i, (line, want) in enumerate(made):
        for name, value in want.items():
            assert got[i][name] == value, (line, name, got[i][name])
    assert {w["kind"] for _, w in made} == {"A", "E", "X"}
