import io
import re
import urllib.error

import pytest

from sluiceway.functions.text import new_run_id
from sluiceway.sources.control import request_specs, specs_from_rows
from sluiceway.sources.fetch import (
    FetchFailed,
    HttpTransport,
    RetryPolicy,
    _Caller,
    _utc_now,
    fetch_responses,
    land_run,
    summarize_run,
)
from sluiceway.sources.landing import LANDING_SCHEMA, read_landing


def answers(method, path, body, headers):
    if path == "down":
        return 502, "bad gateway"
    if path == "gone":
        raise ConnectionResetError("reset")
    if path == "missing":
        return 404, "x" * 900
    if path == "busy":
        return 429, "later"
    if path == "moved":
        return 301, ""
    return 200, f"{method}|{path}|{body}|{sorted(headers.items())}"


def never_works(method, path, body, headers):
    raise TimeoutError("slow")


REQUEST = {"endpoint": "e", "url": "x", "method": "GET", "body": None, "headers": None}


def quiet(seconds):
    return None


def landed(spark, transport=answers, endpoints="/ok,/down,/gone,/missing,/busy,/moved", **kind):
    specs = request_specs(spark, endpoints=endpoints)
    return fetch_responses(specs, transport, "run-1", sleep=quiet, **kind)


@pytest.mark.parametrize("concurrency,threads", [(1, 1), (3, 1), (8, 4)])
def test_each_spec_gives_one_row(spark, concurrency, threads):
    df = landed(spark, concurrency=concurrency, threads=threads)
    assert [f.dataType for f in df.schema] == [f.dataType for f in LANDING_SCHEMA]
    assert df.rdd.getNumPartitions() == concurrency // threads
    rows = {r["endpoint"]: r for r in df.collect()}
    assert len(rows) == 6
    assert rows["/ok"]["response_body"] == "GET|ok|None|[]" and rows["/ok"]["error_message"] is None
    assert rows["/ok"]["url"] == "ok" and rows["/ok"]["run_id"] == "run-1"
    assert rows["/down"]["status_code"] is None and rows["/down"]["attempts"] == 4
    assert rows["/down"]["error_message"] == "TransientHttpError('HTTP 502 on down')"
    assert rows["/gone"]["error_message"] == "ConnectionResetError('reset')" and rows["/gone"]["attempts"] == 4
    assert rows["/missing"]["error_message"] == "HTTP 404: " + "x" * 500
    assert rows["/missing"]["response_body"] is None and rows["/missing"]["attempts"] == 1
    assert rows["/busy"]["status_code"] == 429 and rows["/busy"]["attempts"] == 1
    assert rows["/moved"]["error_message"] == "HTTP 301: "


def test_names_bodies_and_headers(spark):
    specs = specs_from_rows(spark, [{"path": "/p", "method": "put", "body": {"a": 1}, "headers": {"H": "v"}, "name": "n"}])
    row = fetch_responses(specs, answers, "r", sleep=quiet).first()
    assert (row["endpoint"], row["url"]) == ("n", "p")
    assert row["response_body"] == "PUT|p|{\"a\":1}|[('H', 'v')]"


def test_waits_double_between_one_and_ten_seconds():
    policy = RetryPolicy()
    assert [policy.wait(n) for n in range(1, 7)] == [1, 2, 4, 8, 10, 10]
    slept = []
    caller = _Caller(never_works, policy, 1, slept.append, _utc_now)
    assert caller.answer(REQUEST)[-1] == 4 and slept == [1, 2, 4]


def test_a_retry_can_succeed():
    calls = []

    def second_time(method, path, body, headers):
        calls.append(path)
        return (500, "") if len(calls) == 1 else (200, "fine")

    row = _Caller(second_time, RetryPolicy(), 1, quiet, _utc_now).answer(REQUEST)
    assert row[:5] == ("e", "x", 200, "fine", None) and row[-1] == 2


def test_a_good_run_lands_once(spark, tmp_path):
    staging, landing = str(tmp_path / "s"), str(tmp_path / "l")
    assert land_run(landed(spark), "run-1", staging, landing) == {"run_id": "run-1", "records": 6, "success": 1}
    rows = read_landing(spark, landing)
    assert rows.count() == 6 and summarize_run(rows).first()["success"] == 1


def test_a_run_without_success_lands_nothing(spark, tmp_path):
    landing = tmp_path / "l"
    with pytest.raises(FetchFailed, match="all 2 requests of run run-1 failed.*TimeoutError"):
        land_run(landed(spark, never_works, "/a,/b"), "run-1", str(tmp_path / "s"), str(landing))
    assert not landing.exists()


def test_a_run_without_specs_fails(spark, tmp_path):
    with pytest.raises(FetchFailed, match="all 0 requests"):
        land_run(landed(spark, answers, ","), "run-1", str(tmp_path / "s"), str(tmp_path / "l"))


def test_http_requests_are_built_whole():
    transport = HttpTransport("https://host/base/", {"Authorization": "Bearer t"})
    request = transport.request("POST", "p?x=1", '{"a":1}', {"X-Y": "z"})
    assert request.full_url == "https://host/base/p?x=1" and request.get_method() == "POST"
    assert request.data == b'{"a":1}' and request.get_header("Content-type") == "application/json"
    assert request.get_header("Authorization") == "Bearer t" and request.get_header("X-y") == "z"
    assert transport.request("GET", "p", None, {}).get_header("Content-type") is None


def test_http_error_answers_are_answers(monkeypatch):
    def refuse(request, timeout):
        raise urllib.error.HTTPError(request.full_url, 418, "no", {}, io.BytesIO(b"teapot"))

    monkeypatch.setattr("urllib.request.urlopen", refuse)
    assert HttpTransport("http://host")("GET", "p", None, {}) == (418, "teapot")


def test_run_ids():
    assert re.fullmatch(r"\d{8}T\d{6}Z-[0-9a-f]{8}", new_run_id())
