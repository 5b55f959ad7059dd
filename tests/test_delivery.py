"""Responses, retries, histories, results and delivery passes."""

import pytest

from logfreight.model import ATTEMPTS, OUTBOX, DeliveryOptions, PackOptions
from logfreight.operators import delivery as d
from logfreight.operators.send import deliver, due_packages, read_attempts, retry_pass

RESPONSES = {
    200: ("success", "", ""),
    204: ("retry", "UnknownError", "unknown error"),
    302: ("retry", "UnknownError", "unknown error"),
    400: ("retry", "Code", "text"),
    401: ("terminal", "Code", "text"),
    403: ("retry", "Code", "text"),
    404: ("terminal", "Code", "text"),
    408: ("retry", "UnknownError", "unknown error"),
    413: ("terminal", "Code", "text"),
    429: ("retry", "WriteQuotaExceed", "write quota exceed"),
    500: ("retry", "InternalError", "server internal error"),
    503: ("retry", "InternalError", "server internal error"),
    -1: ("retry", "BadRequest", '{"errorcode": "Code", "errormessage": "text"}'),
}


def attempts(spark, *codes_by_package, body='{"errorcode": "Code", "errormessage": "text"}'):
    rows = [
        (str(p), "t", k, code, f"r{p}.{k}", body, 1000 * k)
        for p, codes in enumerate(codes_by_package)
        for k, code in enumerate(codes, 1)
    ]
    return spark.createDataFrame(rows, ATTEMPTS)


def test_every_response(spark):
    rows = d.classify_response(attempts(spark, *[[c] for c in RESPONSES])).collect()
    assert len(rows) == len(RESPONSES)
    for row in rows:
        assert (row.outcome, row.error_code, row.error_message) == RESPONSES[row.http_code]
        assert row.success == (row.http_code == 200)
        assert (row.request_id == "") == row.success


@pytest.mark.parametrize(
    "body, expected",
    [
        ('{"errorcode": "A", "errormessage": "b"}', ("A", "b")),
        ('{"errorCode": "A", "ErrorMessage": "b", "more": 1}', ("A", "b")),
        ('{"errormessage": "b"}', ("", "b")),
        ('{"errorcode": null}', ("", "")),
        ("{}", ("", "")),
        ("oops", ("BadRequest", "bad request")),
        ('{"errorcode": "A"', ("BadRequest", "bad request")),
        ("[1]", ("BadRequest", "bad request")),
        ("", ("BadRequest", "bad request")),
        (None, ("BadRequest", "bad request")),
    ],
)
def test_error_bodies(spark, body, expected):
    row = d.parse_error_body(attempts(spark, [400], body=body)).first()
    assert (row.body_code, row.body_message) == expected


@pytest.mark.parametrize("failures, wait", [(1, 100), (2, 200), (9, 25_600), (10, 50_000), (70, 50_000)])
def test_backoff(spark, failures, wait):
    frame = attempts(spark, [500] * failures)
    row = d.retry_schedule(frame, DeliveryOptions(retries=100)).first()
    assert (row.failures, row.wait_ms) == (failures, wait)
    assert row.next_retry_ms == 1000 * failures + wait


@pytest.mark.parametrize("retries", [-1, 0, 1, 10])
def test_retries_run_out(spark, retries):
    sent = max(retries, 0)
    frame = attempts(spark, [500] * sent, [500] * (sent + 1), [500] * sent + [200])
    opts = DeliveryOptions(retries=retries)
    states = {r.package_id: r.state for r in d.delivery_result(frame, opts).collect()}
    if sent:
        assert states["0"] == "retrying"
    assert states["1"] == "failed" and states["2"] == "success"
    dead = d.dead_letters(frame, opts).collect()
    assert [(r.package_id, r.reason) for r in dead] == [("1", "retries_exhausted")]


@pytest.mark.parametrize("code", [401, 404, 413])
def test_terminal_answers(spark, code):
    dead = d.dead_letters(attempts(spark, [500, code], [400], [403])).collect()
    assert [(r.package_id, r.reason, r.failures) for r in dead] == [("0", "terminal", 2)]


def test_history_keeps_first_or_last(spark):
    frame = attempts(spark, [500] * 11 + [200], [500] * 3)

    def kept(**how):
        rows = d.attempt_history(frame, **how).collect()
        return {r.package_id: [a.attempt_no for a in r.attempts] for r in rows}

    assert kept()["0"] == list(range(2, 13)) and kept()["1"] == [1, 2, 3]
    assert kept(keep="first")["0"] == list(range(1, 12))
    assert kept(n=1, keep="first") == {"0": [1], "1": [1]}
    with pytest.raises(ValueError):
        d.attempt_history(frame, keep="some")


def test_history_rank_is_cut_before_the_shuffle(spark):
    plan = d.attempt_history(attempts(spark, [500]))._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_package_without_attempts(spark):
    packages = spark.createDataFrame([("0",), ("9",)], "package_id string")
    rows = d.delivery_result(attempts(spark, [200]), packages=packages).collect()
    row = next(r for r in rows if r.package_id == "9")
    assert (row.successful, row.error_code, row.request_id, row.ts_ms) == (False, "", "", 0)
    assert row.state == "pending" and len(rows) == 2


def test_due_is_strict_and_ordered(spark):
    schedule = spark.createDataFrame(
        [("a", 101), ("b", 100), ("c", 99), ("d", 5)], "package_id string, next_retry_ms long"
    )
    assert [r.package_id for r in d.retry_due(schedule, 100).collect()] == ["d", "c"]
    every = [r.package_id for r in d.retry_due(schedule, 0, closing=True).collect()]
    assert every == ["d", "c", "b", "a"]


def test_log_status_and_unsent(spark):
    results = d.delivery_result(attempts(spark, [200], [404], [500]))
    packed = spark.createDataFrame([(str(p % 4), p) for p in range(8)], "package_id string, seq long")
    status = {r.seq: r.status for r in d.log_status(packed, results).collect()}
    assert [status[s] for s in range(4)] == ["delivered", "failed", "pending", "pending"]
    assert len(status) == 8
    left = d.unsent(packed, results).select("package_id").distinct().collect()
    assert sorted(r.package_id for r in left) == ["2", "3"]


def test_in_flight(spark):
    packages = spark.createDataFrame(
        [("0", "t", 0, 60), ("1", "t", 10, 50), ("2", "t", 20, 5)],
        "package_id string, topic_id string, close_ms long, size_bytes long",
    )
    frame = attempts(spark, [500, 200], [413], [500])
    rows = d.in_flight_bytes(
        packages, frame, opts=DeliveryOptions(total_bytes=110), partitions=3
    ).orderBy("ts_ms", "package_id")
    got = [(r.ts_ms, r.in_flight, r.over) for r in rows.collect()]
    assert got == [(0, 60, False), (10, 110, False), (20, 115, True), (1000, 65, False), (2000, 5, False)]


def outbox(spark, n=6):
    rows = [(str(p), "none", 1, 1, bytearray(bytes([p])), "t") for p in range(n)]
    return spark.createDataFrame(rows, OUTBOX)


def by_first_byte(topic_id, payload, compress_type):
    if payload[0] == 5:
        raise ConnectionError("unreachable")
    return [200, 500, 404, 429, 400][payload[0]], "id", "{}"


def test_passes_until_nothing_is_due(spark, tmp_path):
    opts = DeliveryOptions(retries=2, workers=2)
    box = outbox(spark)
    known = spark.createDataFrame([], ATTEMPTS)
    clock = 0
    counts = []
    for number in range(5):
        now = clock
        known = retry_pass(
            box, known, by_first_byte, str(tmp_path), number, now, opts=opts, clock=lambda: now
        )
        counts.append(known.count())
        clock += 100_000
    assert counts == [6, 10, 14, 14, 14]  # 1, 3, 4 and 5 are sent three times
    assert read_attempts(spark, str(tmp_path)).count() == 14
    states = {r.package_id: r.state for r in d.delivery_result(known, opts).collect()}
    assert states == {"0": "success", **{p: "failed" for p in "12345"}}
    last = d.delivery_result(known, opts).filter("package_id = '5'").first()
    assert (last.error_code, last.error_message) == ("BadRequest", "unreachable")
    assert last.request_id == "--No RequestId--"


def test_closing_drains_what_is_not_due(spark, tmp_path):
    box = outbox(spark, 2)
    first = deliver(box, by_first_byte, str(tmp_path), 0, DeliveryOptions(workers=1), lambda: 1000)
    assert due_packages(box, first, 1050).count() == 0
    again = due_packages(box, first, 1050, closing=True).collect()
    assert [(r.package_id, r.attempt_no) for r in again] == [("1", 2)]


def test_reading_the_answers_does_not_send_again(spark, tmp_path):
    marks = tmp_path / "marks"
    marks.mkdir()

    def send(topic_id, payload, compress_type):
        (marks / f"{payload[0]}-{len(list(marks.iterdir()))}").touch()
        return 200, "id", ""

    sent = deliver(outbox(spark), send, str(tmp_path / "out"), 0, DeliveryOptions(workers=1))
    sent.count(), sent.count()
    assert len(list(marks.iterdir())) == 6


def test_options_fall_back():
    assert DeliveryOptions(backoff_ms=0, max_backoff_ms=-1, kept_attempts=0) == DeliveryOptions()
    assert DeliveryOptions(total_bytes=0, workers=0) == DeliveryOptions()
    assert PackOptions() == PackOptions(524288, 4096, 2000)
    assert PackOptions(max_bytes=0, max_logs=0, linger_ms=99) == PackOptions(5242880, 40960, 2000)
    assert PackOptions(max_bytes=5242881, max_logs=40961) == PackOptions(5242880, 40960)
    assert PackOptions(linger_ms=100).linger_ms == 100


def test_sender_is_opened_per_task_and_mistakes_end_the_job(spark, tmp_path):
    from contextlib import contextmanager

    from logfreight.operators.send import PerTask

    rows = [(str(i), "t", "none", b"x" * i) for i in range(6)]
    due = spark.createDataFrame(rows, "package_id string, topic_id string, compress_type string, payload binary")

    @contextmanager
    def client():
        seen = []

        def send(topic_id, payload, compress_type):
            seen.append(payload)
            if len(payload) == 3:
                raise ConnectionError("gone")
            return 200, f"{len(seen)}", ""

        yield send

    sent = deliver(due, PerTask(client), f"{tmp_path}/a", 0, DeliveryOptions(workers=1))
    codes = {r.package_id: r.http_code for r in sent.collect()}
    assert codes == {str(i): -1 if i == 3 else 200 for i in range(6)}
    assert len({r.request_id for r in sent.collect()}) == 6

    def mistaken(topic_id, payload, compress_type):
        return topic_id + payload

    with pytest.raises(Exception, match="TypeError"):
        deliver(due, mistaken, f"{tmp_path}/b", 0)


def test_due_packages_read_payloads_once(spark, tmp_path):
    from logfreight.model import ATTEMPTS, OUTBOX

    spark.createDataFrame([], OUTBOX).write.parquet(f"{tmp_path}/outbox")
    outbox = spark.read.parquet(f"{tmp_path}/outbox")
    due = due_packages(outbox, spark.createDataFrame([], ATTEMPTS), 0)
    scans = due._jdf.queryExecution().executedPlan().toString().split("FileScan")[1:]
    assert sum("payload#" in scan.split("]")[0] for scan in scans) == 1


@pytest.mark.parametrize(
    ("body", "code", "message"),
    [
        ('{"errorcode": 5}', "BadRequest", "bad request"),
        ('{"errorcode": {"a": 1}, "errormessage": "m"}', "BadRequest", "bad request"),
        ('{"errorcode": null, "errormessage": "m"}', "", "m"),
        (' null ', "", ""),
        ("[1]", "BadRequest", "bad request"),
        ('{"other": 7, "ErrorCode": "x"}', "x", ""),
        (None, "BadRequest", "bad request"),
    ],
)
def test_error_bodies(spark, body, code, message):
    frame = spark.createDataFrame([(body,)], "body string")
    row = d.parse_error_body(frame).first()
    assert (row.body_code, row.body_message) == (code, message)


def test_passes_by_tallies_read_their_own_attempts(spark, tmp_path):
    from logfreight.operators.send import tallied_pass

    opts = DeliveryOptions(retries=2, workers=2)
    box, clock, counts = outbox(spark), 0, []
    for number in range(5):
        now = clock
        found = tallied_pass(
            box, by_first_byte, f"{tmp_path}/a", f"{tmp_path}/t", number, now, opts=opts, clock=lambda: now
        )
        attempts = read_attempts(spark, f"{tmp_path}/a")
        counts.append(attempts.count())
        wanted = d.delivery_result(attempts, opts)
        assert sorted(found.collect()) == sorted(wanted.collect())
        clock += 100_000
    assert counts == [6, 10, 14, 14, 14]
    # What a pass starts from is one row per package, not one per attempt.
    assert spark.read.parquet(f"{tmp_path}/t/pass_id=4").count() == 6
