"""Run request specs on the executors and land one row per spec."""

from __future__ import annotations

import time
import urllib.error
import urllib.request
import warnings
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone
from http.client import HTTPException
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.text import ERROR_TEXT_CHARS, none_if_empty
from sluiceway.sources.landing import LANDING_SCHEMA, append_landing

# (method, path, JSON body or None, headers) -> (status, text); raises on transport errors.
Transport = Callable[[str, str, str | None, dict], tuple[int, str]]


# This name and the messages built here stand in ``error_message`` of landed rows.
class TransientHttpError(Exception):
    """The target answered with 5xx."""


#: What a request may be sent again for: a 5xx answer, and a connection that failed, broke off or took
#: too long. A transport can name further exceptions of its library in an attribute ``retryable``.
RETRYABLE = (TransientHttpError, OSError, HTTPException)


class FetchFailed(RuntimeError):
    """No request of the run succeeded, or nothing landed."""


@dataclass(frozen=True)
class RetryPolicy:
    # Four attempts, waits that double from one second up to ten.
    attempts: int = 4
    shortest_wait: float = 1.0
    longest_wait: float = 10.0

    def wait(self, attempt: int) -> float:
        """Seconds to wait after an attempt, counted from 1."""
        return max(self.shortest_wait, min(self.longest_wait, 2.0 ** (attempt - 1)))


@dataclass
class HttpTransport:
    """Requests over HTTP with the standard library; headers carry the credential, if any."""

    base_url: str
    headers: dict = field(default_factory=dict)
    timeout: float = 60.0

    def request(self, method: str, path: str, body: str | None, headers: dict) -> urllib.request.Request:
        merged = {**self.headers, **headers}
        if body is not None and "content-type" not in {k.lower() for k in merged}:
            merged["Content-Type"] = "application/json"
        return urllib.request.Request(
            self.base_url.rstrip("/") + "/" + path,
            data=None if body is None else body.encode(),
            headers=merged,
            method=method,
        )

    def __call__(self, method: str, path: str, body: str | None, headers: dict) -> tuple[int, str]:
        try:
            with urllib.request.urlopen(self.request(method, path, body, headers), timeout=self.timeout) as r:
                return r.status, r.read().decode("utf-8", "replace")
        except urllib.error.HTTPError as answer:
            return answer.code, answer.read().decode("utf-8", "replace")


def _utc_now() -> datetime:
    return datetime.now(timezone.utc)


# A task hands its rows on at this many, or at this much body text.
HELD_ROWS, HELD_CHARS = 2000, 16_000_000


@dataclass(frozen=True)
class _Caller:
    """Sends the requests of one task, with retries; travels to the executors."""

    transport: Transport
    policy: RetryPolicy
    threads: int
    sleep: Callable[[float], None]
    now: Callable[[], datetime]

    def once(self, request: dict) -> tuple[int, str]:
        headers = dict(request["headers"] or {})
        status, text = self.transport(request["method"], request["url"], request["body"], headers)
        if status >= 500:
            raise TransientHttpError(f"HTTP {status} on {request['url']}")
        return status, text

    def answer(self, request: dict) -> tuple:
        """(endpoint, url, status, text, problem, fetched_at, attempts) of one request."""
        who = (request["endpoint"], request["url"])
        for attempt in range(1, self.policy.attempts + 1):
            if attempt > 1:
                self.sleep(self.policy.wait(attempt - 1))
            try:
                return (*who, *self.once(request), None, self.now(), attempt)
            except (*getattr(self.transport, "retryable", ()), *RETRYABLE) as raised:
                problem = repr(raised)
            except Exception as raised:  # a request that cannot work is not sent again, but its row lands
                return (*who, None, None, repr(raised), self.now(), attempt)
        return (*who, None, None, problem, self.now(), self.policy.attempts)

    def answers(self, requests: Iterator[dict]) -> Iterator[tuple]:
        """Answers in the order of the requests, with at most ``threads`` under way."""
        if self.threads == 1:
            yield from map(self.answer, requests)
            return
        with ThreadPoolExecutor(max_workers=self.threads) as pool:
            while window := list(islice(requests, self.threads * 8)):
                yield from pool.map(self.answer, window)

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in self.answers(request for batch in batches for request in batch.to_pylist()):
            held.append(row)
            size += len(row[3] or "")
            # Requests are small but answers can be large, so what is held is bounded by both.
            if len(held) >= HELD_ROWS or size >= HELD_CHARS:
                yield _arrow(held)
                held, size = [], 0
        if held:
            yield _arrow(held)


_ANSWER = (
    "endpoint string, url string, status_code int, text string, problem string, "
    "fetched_at timestamp, attempts int"
)
_ANSWER_ARROW = pa.schema(
    [
        ("endpoint", pa.string()), ("url", pa.string()), ("status_code", pa.int32()), ("text", pa.string()),
        ("problem", pa.string()), ("fetched_at", pa.timestamp("us", tz="UTC")), ("attempts", pa.int32()),
    ]
)


def _arrow(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), _ANSWER_ARROW.types)]
    return pa.RecordBatch.from_arrays(columns, schema=_ANSWER_ARROW)


def _requests(specs: DataFrame) -> DataFrame:
    """What is sent and under which name it lands."""
    given = {c: F.col(c) if c in specs.columns else F.lit(None).cast("string") for c in ("method", "body", "name")}
    headers = F.col("headers") if "headers" in specs.columns else F.lit(None).cast("map<string,string>")
    return specs.select(
        F.coalesce(none_if_empty(given["name"]), "path").alias("endpoint"),
        F.ltrim("path", F.lit("/")).alias("url"),
        F.upper(F.coalesce(none_if_empty(given["method"]), F.lit("GET"))).alias("method"),
        given["body"].alias("body"),
        headers.alias("headers"),
    )


def fetch_responses(
    specs: DataFrame,
    transport: Transport,
    run_id: str,
    concurrency: int = 8,
    threads: int = 1,
    policy: RetryPolicy = RetryPolicy(),
    sleep: Callable[[float], None] = time.sleep,
    now: Callable[[], datetime] = _utc_now,
) -> DataFrame:
    """One landing row per spec, never failing on a single request.

    At most ``concurrency`` requests run at once: that many tasks, or fewer tasks with ``threads``
    each. Only the sending is Python; what lands is derived from the answers by Spark. The result
    is lazy; each action sends the requests again, and so does a lost task. Land it once with
    ``land_run``.
    """
    caller = _Caller(transport, policy, threads, sleep, now)
    tasks = max(1, concurrency // threads)
    answers = _requests(specs).repartition(tasks).mapInArrow(caller, _ANSWER)
    good = F.col("status_code").between(200, 299)
    refused = F.concat(
        F.lit("HTTP "), F.col("status_code"), F.lit(": "), F.left("text", F.lit(ERROR_TEXT_CHARS))
    )
    return answers.select(
        "endpoint",
        "url",
        "status_code",
        F.when(good, F.col("text")).alias("response_body"),
        F.when(F.col("problem").isNotNull(), F.col("problem")).when(~good, refused).alias("error_message"),
        "fetched_at",
        F.lit(run_id).alias("run_id"),
        "attempts",
    )


def summarize_run(landed: DataFrame) -> DataFrame:
    """Responses and successes per run."""
    return landed.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("responses"),
        F.count_if(F.col("status_code").between(200, 299)).alias("success"),
        F.min("error_message").alias("an_error"),
    )


def refused_runs(staged: DataFrame) -> DataFrame:
    """The runs that ``land_run`` does not let land: not one of their requests succeeded."""
    return summarize_run(staged).filter(F.col("success") == 0)


def land_run(responses: DataFrame, run_id: str, staging: str, landing: str) -> dict:
    """Fetch once into staging, check the run there, then append it to the landing table.

    Raises before anything lands when no request succeeded, and after landing when no row of the
    run can be read back.
    """
    spark = responses.sparkSession
    if spark.sparkContext.getConf().get("spark.speculation", "false") == "true":
        warnings.warn("spark.speculation is on: copies of slow tasks send their requests again", stacklevel=2)
    responses.write.mode("overwrite").parquet(staging)
    staged = spark.read.schema(LANDING_SCHEMA).parquet(staging)
    totals = summarize_run(staged).first()
    if totals is None or totals["success"] == 0:
        count, error = (0, None) if totals is None else (totals["responses"], totals["an_error"])
        raise FetchFailed(f"all {count} requests of run {run_id} failed, for example: {error}")
    append_landing(staged, landing)
    landed = spark.read.schema(LANDING_SCHEMA).parquet(landing).filter(F.col("run_id") == run_id).count()
    if landed == 0:
        raise FetchFailed(f"no row of run {run_id} is in {landing}")
    return {"run_id": run_id, "records": landed, "success": totals["success"]}
