"""Log events and request records."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.resolve import Expr, resolve

# Log levels from lowest to highest.
LEVELS = ("ALL", "TRACE", "DEBUG", "INFO", "WARN", "ERROR", "OFF")
DEFAULT_THRESHOLD = "WARN"
DEFAULT_HISTORY = 50
ROOT_LOGGER = "root"
# Response codes that are known, and the allowance in the queue.
KNOWN_CODES = (400, 401, 403, 404, 408, 409, 415, 429, 500, 503, 510)
UNKNOWN_CODE = 0
TIMEOUT_CODE = 408
OK_CODE = 200
DEFAULT_TIME_ALLOWED_MS = 2000
UPDATE_PATH = "/update"
# Names in front of the fields of a request log line.
REQUEST_FIELDS = {
    "rid": ("rid", "bigint"),
    "path": ("path", "string"),
    "core": ("core", "string"),
    "request_size": ("RS", "bigint"),
    "wait_time": ("WT", "bigint"),
    "execute_time": ("ET", "bigint"),
    "remote_address": ("r", "string"),
}
RESULT_FIELDS = {"hits": ("hits", "bigint"), "status": ("status", "int"), "qtime": ("QTime", "bigint")}


def at_or_above(level: Expr, threshold: str = DEFAULT_THRESHOLD):
    """Predicate: the event's level reaches the threshold (any letter case)."""
    name = threshold.upper()
    if name not in LEVELS:
        raise ValueError(f"unknown level {threshold!r}")
    loud = LEVELS[LEVELS.index(name):]
    return lambda df: resolve(df, level).isin(*loud)


def log_history(
    df: DataFrame, ts: str, level: str, threshold: str = DEFAULT_THRESHOLD,
    size: int = DEFAULT_HISTORY, since: datetime | Column | None = None, id_col: str | None = None,
) -> DataFrame:
    """The last ``size`` events at or above the threshold, of those the ones
    strictly later than ``since``. ``id_col`` orders events of equal time.

    A top-k: every task keeps ``size`` rows, no full sort.
    """
    latest = [F.col(ts).desc()] + ([F.col(id_col).desc()] if id_col else [])
    kept = df.filter(at_or_above(level, threshold)(df)).orderBy(*latest).limit(size)
    if since is None:
        return kept
    since = since if isinstance(since, Column) else F.lit(since).cast(df.schema[ts].dataType)
    return kept.filter(F.col(ts) > since)


def name_tree(df: DataFrame, col: Expr, include_root: bool = True) -> DataFrame:
    """``name, is_own``: every dotted name and all its ancestors, once each.

    ``is_own`` tells names that occur themselves from implied ancestors. Names
    are made distinct before their ancestors are listed, so a name on very many
    rows is expanded once.
    """
    name = resolve(df, col)
    names = df.select(name.alias("own")).filter("own is not null and own <> ''").distinct()
    parts = F.split("own", r"\.", -1)
    chain = F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, F.lit(1), i), "."),
    )
    rows = names.select("own", F.explode(chain).alias("name")).filter("name <> ''")
    tree = rows.groupBy("name").agg(F.max(F.col("name") == F.col("own")).alias("is_own"))
    if not include_root:
        return tree
    root = df.sparkSession.range(1).select(
        F.lit(ROOT_LOGGER).alias("name"), F.lit(True).alias("is_own")
    )
    return tree.filter(F.col("name") != ROOT_LOGGER).unionByName(root)


def request_params(
    df: DataFrame, col: Expr, as_rows: bool = False, name: str = "params", strict: bool = False
) -> DataFrame:
    """Split ``a=1&b=2&a=3`` into a map of key to values, or into one row
    ``k, v`` per pair.

    A pair needs a key and a value; the first ``=`` parts them; the value is
    URL-decoded. A value that cannot be decoded is NULL, or an error with
    ``strict=True``. No shuffle: each row is worked on by itself.
    """
    decode = F.url_decode if strict else F.try_url_decode
    pairs = F.filter(
        F.split(resolve(df, col), "&", -1),
        lambda kv: (F.instr(kv, "=") > 1) & (F.instr(kv, "=") < F.length(kv)),
    )
    pairs = F.transform(
        pairs,
        lambda kv: F.struct(
            F.substring_index(kv, "=", 1).alias("k"),
            decode(F.substr(kv, F.instr(kv, "=") + 1, F.length(kv))).alias("v"),
        ),
    )
    if as_rows:
        return df.withColumn("__pair", F.explode(pairs)).select(*df.columns, "__pair.k", "__pair.v")
    keys = F.array_distinct(F.transform(F.col("__pairs"), lambda p: p["k"]))
    values = F.transform(
        keys,
        lambda k: F.transform(
            F.filter(F.col("__pairs"), lambda p: p["k"] == k), lambda p: p["v"]
        ),
    )
    return (
        df.withColumn("__pairs", F.coalesce(pairs, F.array().cast("array<struct<k:string,v:string>>")))
        .withColumn(name, F.map_from_arrays(keys, values))
        .drop("__pairs")
    )


def normalize_code(code: Column | str) -> Column:
    """A response code if it is a known one, else 0."""
    code = F.col(code) if isinstance(code, str) else code
    return F.when(code.isin(*KNOWN_CODES), code).otherwise(F.lit(UNKNOWN_CODE)).cast("int")


def unknown_code(code: Column | str) -> Column:
    """The code itself where it is not a known one, else NULL."""
    code = F.col(code) if isinstance(code, str) else code
    return F.when(~code.isin(*KNOWN_CODES, UNKNOWN_CODE), code)


def classify_requests(
    df: DataFrame, wait_ms: Expr, time_allowed: Expr | int | None = None, name: str = "code"
) -> DataFrame:
    """Requests that waited longer than their allowance (2000 ms where none is
    given) time out with 408, the others are 200."""
    if time_allowed is None or isinstance(time_allowed, int):
        allowed = F.lit(DEFAULT_TIME_ALLOWED_MS if time_allowed is None else time_allowed)
    else:
        allowed = F.coalesce(resolve(df, time_allowed), F.lit(DEFAULT_TIME_ALLOWED_MS))
    late = resolve(df, wait_ms) > allowed
    return df.withColumn(name, F.when(late, F.lit(TIMEOUT_CODE)).otherwise(F.lit(OK_CODE)))


def is_update_request(path: Column | str) -> Column:
    """Whether a request path is an update: ``/update`` or below it."""
    path = F.col(path) if isinstance(path, str) else path
    return F.coalesce((path == UPDATE_PATH) | path.startswith(UPDATE_PATH + "/"), F.lit(False))


def parse_request_log(df: DataFrame, col: str) -> DataFrame:
    """Fields of request log lines:

        12:00:00.000 [thread] rid=7 path=/select core=c RS=10 WT=1 ET=2 r=host params={q=a} hits=3 status=0 QTime=2

    Fields a line lacks are NULL. ``tip`` is the note on lines for requests
    that timed out or were rejected.
    """
    # parameter values may hold braces and blanks, so the fields are looked for
    # in front of the first brace and behind the last one only
    brace = F.instr(F.col(col), "{")
    text = df.withColumns({
        "__head": F.when(brace > 0, F.substring_index(F.col(col), "{", 1)).otherwise(F.col(col)),
        "__tail": F.when(brace > 0, F.substring_index(F.col(col), "}", -1)).otherwise(F.col(col)),
    })

    def pick(source: str, pattern: str, kind: str = "string") -> Column:
        return F.nullif(F.regexp_extract(F.col(source), pattern, 1), F.lit("")).try_cast(kind)

    def labelled(source: str, label: str, kind: str) -> Column:
        return pick(source, rf"(?:^| ){re.escape(label)}=(\S+)", kind)

    out = {
        "time": pick("__head", r"^([0-9]{2}:[0-9]{2}:[0-9]{2}\.[0-9]{3}) "),
        "thread": pick("__head", r"^\S+ \[([^\]]*)\]"),
        **{name: labelled("__head", *field) for name, field in REQUEST_FIELDS.items()},
        "tip": labelled("__head", "tip", "string"),
        "params": pick(col, r"params=\{(.*)\}"),
        **{name: labelled("__tail", *field) for name, field in RESULT_FIELDS.items()},
    }
    return text.withColumns(out).drop("__head", "__tail")
