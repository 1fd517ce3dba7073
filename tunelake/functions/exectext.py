"""Reading what a run of generated code left behind: exit code and stderr."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tunelake.functions.codetext import has_code
from tunelake.functions.pytext import splitlines, strip, text_or_empty

# The marker before a run's JSON result, and errors of unknown names.
RESULT_MARKER = "__EVAL_RESULT__"
API_ERRORS = ("NameError", "ImportError", "ModuleNotFoundError", "AttributeError")
TAIL_CHARS = 3_000

RESULT_SCHEMA = (
    "root_part_ok boolean, volume double, bbox array<array<double>>, face_count bigint, "
    "step_export_ok boolean, step_size_bytes bigint"
)


def _tail(stderr: Column, n: int = TAIL_CHARS) -> Column:
    return F.right(text_or_empty(stderr), F.lit(n))


def result_line(stderr: Column) -> Column:
    """JSON text after the marker on the first line that starts with it, or null."""
    lines = splitlines(text_or_empty(stderr))
    marked = F.try_element_at(F.filter(lines, lambda s: s.startswith(RESULT_MARKER)), F.lit(1))
    return F.substring(marked, len(RESULT_MARKER) + 1, 2**31 - 1)


def parse_result(stderr: Column) -> Column:
    return F.from_json(result_line(stderr), RESULT_SCHEMA)


def categorize(code: Column, timed_out: Column, returncode: Column, stderr: Column) -> Column:
    """no_code, timeout, ok, no_result, api_error, syntax_error or runtime.

    Only the end of stderr counts, and a name error anywhere in it wins.
    """
    tail = _tail(stderr)
    api = F.lit(False)
    for name in API_ERRORS:
        api = api | tail.contains(name)
    return (
        F.when(~has_code(code), "no_code")
        .when(timed_out, "timeout")
        .when((returncode == 0) & result_line(stderr).isNotNull(), "ok")
        .when(returncode == 0, "no_result")
        .when(api, "api_error")
        .when(tail.contains("SyntaxError") & tail.contains("<string>"), "syntax_error")
        .otherwise("runtime")
    )


def error_line(stderr: Column) -> Column:
    """Last line of a traceback that is no frame line, up to 300 characters; or ''."""
    lines = F.transform(splitlines(_tail(stderr)), strip)
    said = F.filter(
        lines, lambda s: (s != "") & ~s.startswith("File ") & ~s.startswith("Traceback"))
    return F.left(text_or_empty(F.try_element_at(said, F.lit(-1))), F.lit(300))


def stderr_tail(stderr: Column, returncode: Column) -> Column:
    """What a record keeps of stderr: 500 characters of a clean exit, else 600."""
    return F.when(returncode == 0, F.right(text_or_empty(stderr), F.lit(500))).otherwise(
        F.right(_tail(stderr), F.lit(600)))
