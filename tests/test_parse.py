"""Line grammar: the reference's own test line, hand rows, and one-pass == nine-extract."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from helpers import SF_SMALL, lines_df
from logsmith.functions import logline as L
from logsmith.operators import parsing
from logsmith.sources.fixtures import event_log_lines

# Fixed value: the documented sample line and the fields it must give.
REF_LINE = '199.72.81.55 - - [01/Jul/1995:00:00:01 -0400] "GET /history/apollo/ HTTP/1.0" 200 6245'
PREFIX = 'h.com - - [01/Jul/1995:00:00:01 -0400] '


def test_reference_line(spark):
    row = parsing.parse_logs(lines_df(spark, [REF_LINE])).collect()[0]
    assert row.ip == "199.72.81.55"
    assert row.url == "/history/apollo/"
    assert row.status == 200 and row.bytes == 6245
    assert row.method == "GET" and row.protocol == "HTTP/1.0"
    # 00:00:01 at -0400 is 04:00:01 UTC, a Saturday
    assert row.timestamp.replace(tzinfo=None) == dt.datetime(1995, 7, 1, 4, 0, 1)
    assert (row.hour, row.day_of_week, row.date) == (4, 7, "1995-07-01")
    assert row.is_error == 0 and row.status_category == "2xx_success"


def test_empty_frame_keeps_schema(spark):
    out = parsing.parse_logs(spark.createDataFrame([], "value string"))
    assert out.columns == parsing.LOG_COLUMNS
    assert out.count() == 0


HAND_ROWS = [
    # rest of line, kept, url, protocol, status, bytes
    ('"GET /a" 304 0', True, "/a", "", 304, 0),
    ('"GET" 400 -', True, "", "", 400, 0),
    ('"GET /a b c HTTP/1.0" 404 -', False, None, None, None, None),
    ('"" 400 -', False, None, None, None, None),
    ('"GET /q"x HTTP/1.0" - 12', True, '/q"x', "HTTP/1.0", None, 12),
    ('"GET /a HTTP/1.0" 200 1 "ref" "ua"', True, "/a", "HTTP/1.0", 200, 1),
    ('"GET /a HTTP/1.0" 200 99999999999999999999', True, "/a", "HTTP/1.0", 200, None),
]


def test_hand_rows(spark):
    lines = [PREFIX + r[0] for r in HAND_ROWS]
    out = {(r.url, r.status, r.bytes): r for r in parsing.parse_logs(lines_df(spark, lines)).collect()}
    kept = [r for r in HAND_ROWS if r[1]]
    assert len(out) == len(kept)
    for _, _, url, proto, status, size in kept:
        assert out[(url, status, size)].protocol == proto
    unknown = [r for r in out.values() if r.status is None][0]
    assert unknown.status_category == "unknown" and unknown.is_error == 0


def test_impossible_dates_and_junk(spark):
    lines = ['h - - [32/Jul/1995:00:00:01 -0400] "GET /a HTTP/1.0" 200 1',
             'h - - [01/07/1995:00:00:01 -0400] "GET /a HTTP/1.0" 200 1',
             "junk", ""]
    rows = parsing.parse_logs(lines_df(spark, lines)).collect()
    assert len(rows) == 2
    assert all(r.timestamp is None and r.hour is None and r.date is None for r in rows)
    rej = {r.accepted: r.line_count for r in parsing.parse_rejects(lines_df(spark, lines)).collect()}
    assert rej == {True: 2, False: 2}


def test_status_bands(spark):
    codes = [100, 199, 200, 299, 300, 399, 400, 404, 499, 500, 599, 600]
    lines = [f'h - - [01/Jul/1995:00:00:01 -0400] "GET /a HTTP/1.0" {c} 1' for c in codes]
    got = {r.status: (r.status_category, r.is_error) for r in parsing.parse_logs(lines_df(spark, lines)).collect()}
    assert got[100] == ("unknown", 0) and got[199] == ("unknown", 0)
    assert got[200] == ("2xx_success", 0) and got[399] == ("3xx_redirect", 0)
    assert got[404] == ("4xx_client_error", 1) and got[599] == ("5xx_server_error", 1)
    assert got[600] == ("unknown", 1)


def _both_ways(spark, lines):
    df = lines_df(spark, lines)
    fast = parsing.parse_fields(df)
    slow = df.select(*L.extract_fields_slow(F.col("value")))
    return fast, slow


def test_one_pass_equals_nine_extracts_on_fixture(spark):
    lines = [r.value for r in event_log_lines(spark, SF_SMALL).collect()]
    odd = [PREFIX + r[0] for r in HAND_ROWS] + ["junk", "", "a\u0001b - - [01/Jul/1995:00:00:01 -0400] \"GET /\u0001x HTTP/1.0\" 200 1",
                                               "x\u0001\u0001 - - [01/Jul/1995:00:00:01 +0000] \"GET /a\u0001\u0003b\" 200 -"]
    fast, slow = _both_ways(spark, lines + odd)
    assert fast.exceptAll(slow).count() == 0 and slow.exceptAll(fast).count() == 0


_token = st.text(alphabet=st.sampled_from(list('ab/. -"[]:+\u0001\u0002\u00030123456789')), max_size=12)


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(_token, _token, _token, _token, _token), min_size=1, max_size=20))
def test_one_pass_property(spark, parts):
    lines = [f'{a} - - [01/Jul/1995:00:00:01 -0400] "{b} {c}{d}" 200 {e}' for a, b, c, d, e in parts]
    lines += [f'{a} {b} {c} [{d}] "{e}" 200 -' for a, b, c, d, e in parts]
    fast, slow = _both_ways(spark, lines)
    assert fast.exceptAll(slow).count() == 0 and slow.exceptAll(fast).count() == 0


def test_profile_and_filter(spark):
    logs = parsing.parse_logs(event_log_lines(spark, SF_SMALL)).cache()
    prof = {r.column_name: r for r in parsing.log_profile(logs).collect()}
    n = logs.count()
    assert all(r.row_count == n for r in prof.values())
    assert prof["ip"].distinct_count == logs.select("ip").distinct().count()
    assert prof["status"].null_count == logs.filter(F.col("status").isNull()).count()
    f = parsing.filter_logs(logs, start="2024-01-05 00:00:00", end="2024-01-06 00:00:00", status=200)
    assert f.filter((F.col("status") != 200) | (F.col("date") != "2024-01-05")).count() == 0


_host = st.one_of(
    st.tuples(*[st.integers(0, 255)] * 4).map(lambda t: ".".join(map(str, t))),
    st.from_regex(r"[a-z][a-z0-9\-]{0,10}\.(com|org|net)", fullmatch=True))
_path = st.from_regex(r"/[A-Za-z0-9_./~%\-]{0,20}", fullmatch=True)


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(
    _host,
    st.datetimes(min_value=dt.datetime(1990, 1, 1), max_value=dt.datetime(2030, 12, 31)),
    st.integers(-12, 14),
    st.sampled_from(["GET", "POST", "HEAD", "PUT"]),
    _path,
    st.sampled_from(["HTTP/1.0", "HTTP/1.1", ""]),
    st.one_of(st.none(), st.integers(100, 599)),
    st.one_of(st.none(), st.integers(0, 10**12))), min_size=1, max_size=15))
def test_format_then_parse_round_trip(spark, rows):
    lines, expected = [], []
    for host, when, off_h, method, path, proto, status, size in rows:
        when = when.replace(microsecond=0)
        zone = f"{'+' if off_h >= 0 else '-'}{abs(off_h):02d}00"
        request = f"{method} {path}" + (f" {proto}" if proto else "")
        lines.append(f'{host} - - [{when.strftime("%d/%b/%Y:%H:%M:%S")} {zone}] "{request}" '
                     f'{"-" if status is None else status} {"-" if size is None else size}')
        utc = when - dt.timedelta(hours=off_h)
        expected.append((host, utc, method, path, proto, status, 0 if size is None else size))
    got = [(r.ip, r.timestamp.replace(tzinfo=None), r.method, r.url, r.protocol, r.status, r.bytes)
           for r in parsing.parse_logs(lines_df(spark, lines)).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_latin1_bytes_in_a_log_file(spark, tmpdir_fresh):
    import os
    from logsmith.sources.text import read_log_text
    path = os.path.join(tmpdir_fresh, "latin1.log")
    with open(path, "wb") as f:
        f.write(b'h\xe9.com - - [01/Jul/1995:00:00:01 -0400] "GET /caf\xe9 HTTP/1.0" 200 12\n')
        f.write(b'ok.com - - [01/Jul/1995:00:00:02 -0400] "GET /a HTTP/1.0" 200 1\n')
    rows = parsing.parse_logs(read_log_text(spark, path)).collect()
    # invalid UTF-8 bytes decode as U+FFFD; the line is kept and parsed
    assert len(rows) == 2
    odd = [r for r in rows if r.ip != "ok.com"][0]
    assert odd.url == "/caf�" and odd.bytes == 12
