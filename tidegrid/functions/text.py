"""Date and text rules, as fragments of Spark SQL text."""

from __future__ import annotations

# Date layouts tried in turn when a text column may hold dates.
DATE_LAYOUTS = (
    (r"^\\d{4}-\\d{2}-\\d{2}$", "yyyy-MM-dd"),
    (r"^\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2}$", "yyyy-MM-dd HH:mm:ss"),
    (r"^\\d{4}-\\d{2}-\\d{2} \\d{2}:\\d{2}:\\d{2}\\.\\d{1,6}$", "yyyy-MM-dd HH:mm:ss.[SSSSSS][SSSSS][SSSS][SSS][SS][S]"),
    (r"^\\d{4}/\\d{2}/\\d{2}$", "yyyy/MM/dd"),
    (r"^\\d{2}/\\d{2}/\\d{4}$", "MM/dd/yyyy"),
)


def parse_date(value: str) -> str:
    """Strict: text that is no timestamp raises."""
    return f"to_timestamp(trim({value}))"


def try_parse_date(value: str) -> str:
    """Lenient: a timestamp for text in a known date layout, else null.

    Bare numbers stay text, though a plain cast would read ``2024`` as a year.
    """
    text = f"replace(trim({value}), 'T', ' ')"
    tries = [
        f"CASE WHEN {text} RLIKE '{pattern}' THEN try_to_timestamp({text}, '{layout}') END"
        for pattern, layout in DATE_LAYOUTS
    ]
    return f"coalesce({', '.join(tries)})"


def iso_date(value: str) -> str:
    return f"date_format({value}, 'yyyy-MM-dd')"


def iso_timestamp(value: str) -> str:
    return f"date_format({value}, \"yyyy-MM-dd'T'HH:mm:ss\")"


def tidy(value: str) -> str:
    """Both ends stripped of blanks, tabs and line breaks."""
    return f"regexp_replace({value}, '^\\\\s+|\\\\s+$', '')"


def zero_padded(value: str, width: int) -> str:
    """At least ``width`` digits; longer numbers are kept whole."""
    return f"format_string('%0{width}d', {value})"


def days_from(start: str, offset: str) -> str:
    return f"date_add(DATE '{start}', CAST({offset} AS INT))"


def hash_int(key: str, stream: str) -> str:
    """An integer in [0, 2^32) fixed by ``key`` and ``stream``, as a double."""
    return f"CAST(conv(substr(md5(CAST({key} AS STRING) || '/{stream}'), 1, 8), 16, 10) AS DOUBLE)"


def normal_draw(key: str, stream: str, mean: str, sigma: float) -> str:
    """A normal draw fixed by ``key`` and ``stream`` (Box–Muller on two hashes).

    Unlike a seeded generator it does not depend on how rows are partitioned, so a
    recomputed partition yields the same rows.
    """
    u1 = f"({hash_int(key, stream + '/u1')} + 1D) / 4294967297D"
    u2 = f"{hash_int(key, stream + '/u2')} / 4294967296D"
    return f"({mean} + {sigma!r}D * sqrt(-2D * ln({u1})) * cos(6.283185307179586D * {u2}))"
