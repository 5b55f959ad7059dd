"""What became of packages: classification, history, results, retries, in-flight bytes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logfreight.model import DeliveryOptions
from logfreight.plans.ordered import range_ordered, read_once, running_sums

# Answers of the service and what they mean.
OK = 200
BODY_CODES = (400, 401, 403, 404, 413)
TERMINAL_CODES = (401, 404, 413)
THROTTLED = 429
SERVER_ERRORS_FROM = 500
NO_RESPONSE = -1
NO_REQUEST_ID = "--No RequestId--"
BAD_REQUEST = "BadRequest"
WRITE_QUOTA_EXCEED = "WriteQuotaExceed"
INTERNAL_ERROR = "InternalError"
UNKNOWN_ERROR = "UnknownError"
BAD_REQUEST_TEXT = "bad request"
WRITE_QUOTA_TEXT = "write quota exceed"
INTERNAL_ERROR_TEXT = "server internal error"
UNKNOWN_ERROR_TEXT = "unknown error"
# What is kept of the last attempt of a package.
LAST = ["success", "error_code", "error_message", "request_id", "ts_ms"]
# An object of an error code and, maybe, a message, both texts without escapes.
_TEXT = r'"([^"\\\x00-\x1f]*)"'
_PLAIN_BODY = rf'^ *\{{ *"errorcode" *: *{_TEXT} *(?:, *"errormessage" *: *{_TEXT} *)?\}} *$'


def _codes(codes: Sequence[int]) -> str:
    return ", ".join(map(str, codes))


def parse_error_body(attempts: DataFrame, only: str = "true") -> DataFrame:
    """Code and message stated in the body; a body that is no such object is a bad request.

    Field names match in any case. A field that is missing or null reads as empty text, and
    so does every field of the body ``null``; a number, list or object where text belongs
    makes the whole body a bad request.
    Bodies of rows for which the condition ``only`` does not hold are not looked at.
    """

    known = "lower(k) IN ('errorcode', 'errormessage')"
    is_text = "schema_of_variant(v) IN ('STRING', 'VOID')"

    def field(name: str, otherwise: str) -> str:
        matches = f"map_values(map_filter(_fields, (k, v) -> lower(k) = '{name}'))"
        texts = f"filter(transform({matches}, v -> try_cast(v AS string)), v -> v IS NOT NULL)"
        found = f"coalesce(try_element_at({texts}, -1), '')"
        return f"CASE WHEN _null THEN '' WHEN _fields IS NULL THEN '{otherwise}' ELSE {found} END"

    # A plain object of these two texts is taken apart by its pattern; other objects are parsed,
    # in a projection of their own, or every use below would parse them again.
    simple = f"coalesce(({only}) AND body RLIKE r'{_PLAIN_BODY}', false) AS _simple"
    fields = f"from_json(CASE WHEN ({only}) AND NOT _simple AND ltrim(body) LIKE '{{%' THEN body END, 'map<string,variant>') AS _all"
    texts_only = f"forall(map_entries(map_filter(_all, (k, v) -> {known})), e -> {is_text.replace('(v)', '(e.value)')})"
    return (
        attempts.selectExpr("*", simple)
        .selectExpr("*", fields, f"coalesce(({only}) AND trim(body) = 'null', false) AS _null")
        .selectExpr("*", f"CASE WHEN {texts_only} THEN _all END AS _fields")
        .selectExpr(
            "*",
            f"CASE WHEN _simple THEN regexp_extract(body, r'{_PLAIN_BODY}', 1) ELSE {field('errorcode', BAD_REQUEST)} END AS body_code",
            f"CASE WHEN _simple THEN regexp_extract(body, r'{_PLAIN_BODY}', 2) ELSE {field('errormessage', BAD_REQUEST_TEXT)} END AS body_message",
        )
        .drop("_fields", "_all", "_null", "_simple")
    )


def classify_response(attempts: DataFrame) -> DataFrame:
    """Add outcome (success, terminal, retry), error code and message of each attempt.

    Successful attempts carry no request id, code or message.
    """
    body_codes = f"http_code IN ({_codes(BODY_CODES)})"

    def by_code(body: str, no_response: str, throttled: str, internal: str, unknown: str) -> str:
        return (
            f"CASE WHEN http_code = {OK} THEN '' WHEN {body_codes} THEN {body} "
            f"WHEN http_code = {NO_RESPONSE} THEN {no_response} "
            f"WHEN http_code = {THROTTLED} THEN '{throttled}' "
            f"WHEN http_code >= {SERVER_ERRORS_FROM} THEN '{internal}' ELSE '{unknown}' END"
        )

    code = by_code(
        "body_code", f"'{BAD_REQUEST}'", WRITE_QUOTA_EXCEED, INTERNAL_ERROR, UNKNOWN_ERROR
    )
    message = by_code(
        "body_message",
        "coalesce(body, '')",
        WRITE_QUOTA_TEXT,
        INTERNAL_ERROR_TEXT,
        UNKNOWN_ERROR_TEXT,
    )
    others = [name for name in attempts.columns if name != "request_id"]
    return parse_error_body(attempts, body_codes).selectExpr(
        *others,
        f"CASE WHEN http_code = {OK} THEN '' ELSE request_id END AS request_id",
        f"CASE WHEN http_code = {OK} THEN 'success' "
        f"WHEN http_code IN ({_codes(TERMINAL_CODES)}) THEN 'terminal' ELSE 'retry' END AS outcome",
        f"http_code = {OK} AS success",
        f"{code} AS error_code",
        f"{message} AS error_message",
    )


def attempt_history(attempts: DataFrame, n: int | None = None, keep: str = "last") -> DataFrame:
    """The kept attempts of each package in order, the last ``n`` or the first.

    The rank is cut below the shuffle by Spark, so a package with very many attempts
    sends no more than ``n`` of them per task.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep is 'first' or 'last', not {keep!r}")
    n = DeliveryOptions().kept_attempts if n is None else n
    order = F.col("attempt_no").asc() if keep == "first" else F.col("attempt_no").desc()
    rank = F.row_number().over(Window.partitionBy("package_id").orderBy(order))
    kept = classify_response(attempts).withColumn("_rank", rank).filter(F.col("_rank") <= n)
    fields = ["attempt_no", "success", "request_id", "error_code", "error_message", "ts_ms"]
    return kept.groupBy("package_id").agg(
        F.array_sort(F.collect_list(F.struct(*fields))).alias("attempts")
    )


def delivery_result(
    attempts: DataFrame, opts: DeliveryOptions = DeliveryOptions(), packages: DataFrame | None = None
) -> DataFrame:
    """Per package: what its last attempt said and what that makes of the package.

    ``state`` is success, failed (a terminal answer, or more failures than ``retries``)
    or retrying. With ``packages``, those without attempts are there as pending.
    """
    return results_of(tallies(attempts), opts, packages)


def tallies(attempts: DataFrame) -> DataFrame:
    """Per package: its last attempt (``attempt_no`` and what it said), failures, terminal."""
    classified = classify_response(attempts)
    return classified.groupBy("package_id").agg(
        F.max("attempt_no").alias("attempt_no"),
        F.max_by(F.struct(*LAST), "attempt_no").alias("last"),
        F.count_if(~F.col("success")).alias("failures"),
        F.max(F.col("outcome") == "terminal").alias("terminal"),
    )


def merge_tallies(known: DataFrame, new: DataFrame) -> DataFrame:
    """Tallies of all attempts from those of the passes before and those of a new one.

    So a pass classifies and reads its own attempts only, however many there were before.
    """
    return known.unionByName(new).groupBy("package_id").agg(
        F.max("attempt_no").alias("attempt_no"),
        F.max_by("last", "attempt_no").alias("last"),
        F.sum("failures").alias("failures"),
        F.max("terminal").alias("terminal"),
    )


def results_of(
    tallied: DataFrame, opts: DeliveryOptions = DeliveryOptions(), packages: DataFrame | None = None
) -> DataFrame:
    """``delivery_result`` from tallies."""
    success = F.col("last.success")
    state = (
        F.when(success, "success")
        .when(F.col("terminal") | (F.col("failures") > opts.retries), "failed")
        .otherwise("retrying")
    )
    results = tallied.select(
        "package_id",
        success.alias("successful"),
        *[F.col(f"last.{n}").alias(n) for n in LAST[1:]],
        "failures",
        "terminal",
        state.alias("state"),
    )
    if packages is None:
        return results
    none = {
        "successful": False,
        "error_code": "",
        "error_message": "",
        "request_id": "",
        "ts_ms": 0,
        "failures": 0,
        "terminal": False,
        "state": "pending",
    }
    return packages.select("package_id").join(results, "package_id", "left").fillna(none)


def log_status(packed: DataFrame, results: DataFrame) -> DataFrame:
    """The outcome of its package for every log: delivered, failed or pending."""
    told = results.select("package_id", "state", "error_code", "error_message", "request_id", "ts_ms")
    status = (
        F.when(F.col("state") == "success", "delivered")
        .when(F.col("state") == "failed", "failed")
        .otherwise("pending")
    )
    joined = packed.join(told, "package_id", "left").withColumn("status", status)
    blanks = {"error_code": "", "error_message": "", "request_id": "", "ts_ms": 0}
    return joined.drop("state").fillna(blanks, subset=list(blanks))


def unsent(outbox: DataFrame, results: DataFrame) -> DataFrame:
    """Packages without a final outcome: what closing has to drain."""
    final = results.filter(F.col("state").isin("success", "failed")).select("package_id")
    return outbox.join(final, "package_id", "left_anti")


def retry_wait(opts: DeliveryOptions = DeliveryOptions()) -> Column:
    """Wait after so many ``failures``: it doubles with each up to its maximum."""
    return F.least(
        F.pow(F.lit(2.0), F.col("failures") - 1) * F.lit(float(opts.backoff_ms)),
        F.lit(float(opts.max_backoff_ms)),
    ).cast("long")


def retry_schedule(attempts: DataFrame, opts: DeliveryOptions = DeliveryOptions()) -> DataFrame:
    """When each package that failed, but not for good, is tried again."""
    wait = retry_wait(opts)
    waiting = delivery_result(attempts, opts).filter(F.col("state") == "retrying")
    return waiting.select(
        "package_id",
        "failures",
        "ts_ms",
        wait.alias("wait_ms"),
        (F.col("ts_ms") + wait).alias("next_retry_ms"),
    )


def retry_due(schedule: DataFrame, now_ms: int, closing: bool = False) -> DataFrame:
    """Packages whose retry time has passed, earliest first; all of them when closing."""
    due = schedule if closing else schedule.filter(F.col("next_retry_ms") < now_ms)
    return due.orderBy("next_retry_ms", "package_id")


def dead_letters(attempts: DataFrame, opts: DeliveryOptions = DeliveryOptions()) -> DataFrame:
    """Packages that failed for good, and whether by an answer or by using up retries."""
    failed = delivery_result(attempts, opts).filter(F.col("state") == "failed")
    reason = F.when(F.col("terminal"), "terminal").otherwise("retries_exhausted")
    return failed.select(
        "package_id", "failures", "error_code", "error_message", "ts_ms", reason.alias("reason")
    )


def in_flight_bytes(
    packages: DataFrame,
    attempts: DataFrame,
    by: Sequence[str] = ("topic_id",),
    opts: DeliveryOptions = DeliveryOptions(),
    partitions: int | None = None,
) -> DataFrame:
    """Bytes closed but not settled, over time, and where they exceed ``total_bytes``.

    A package counts from its closing until it succeeds or fails for good.
    """
    # Both branches below use it: sized once.
    packages, _ = read_once(packages.select(*by, "package_id", "close_ms", "size_bytes"), partitions)
    results = delivery_result(attempts, opts).filter(F.col("state").isin("success", "failed"))
    settled = packages.join(results.select("package_id", "ts_ms"), "package_id")
    rises = packages.select(
        *by, F.col("close_ms").alias("ts_ms"), "package_id", F.col("size_bytes").alias("delta")
    )
    falls = settled.select(*by, "ts_ms", "package_id", (-F.col("size_bytes")).alias("delta"))
    order = ["ts_ms", "package_id", "delta"]
    moves, parts = read_once(rises.unionByName(falls), partitions)
    ordered = range_ordered(moves, list(by), order, parts)
    running = running_sums(ordered, list(by), order, {"in_flight": F.col("delta")})
    return running.select(
        *by, *order, "in_flight", (F.col("in_flight") > opts.total_bytes).alias("over")
    )
