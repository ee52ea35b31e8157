"""Scalar text and time expressions on posts and leads."""

from pyspark.sql import Column, functions as F

# Link formats and time formats.
BASE_URL = "https://reddit.com"
MESSAGE_PREFIX = "https://reddit.com/message/compose/?to="
SECONDS_FORMAT = "yyyy-MM-dd HH:mm:ss"
MINUTES_FORMAT = "yyyy-MM-dd HH:mm"

# White space as Unicode has it, plus the four separator controls.
_BLANK = r"[\s\x1c-\x1f]"


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def full_text(title="title", body="selftext") -> Column:
    return F.concat(F.col(title), F.lit(" "), F.col(body))


def direct_url(permalink="permalink", base=BASE_URL) -> Column:
    return F.concat(F.lit(base), F.col(permalink))


def message_url(author="author", prefix=MESSAGE_PREFIX) -> Column:
    return F.concat(F.lit(prefix), F.col(author))


def created_at(created_utc="created_utc") -> Column:
    return F.timestamp_seconds(F.col(created_utc))


def iso_text(ts: Column) -> Column:
    """ISO text of a timestamp; microseconds appear only when there are any."""
    micros = F.date_format(ts, "SSSSSS")
    return F.concat(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros)),
    )


def clip(text: Column, length: int) -> Column:
    return F.left(text, F.lit(length))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"(?U)^{_BLANK}+|{_BLANK}+$", "")


def has_ink(text: Column) -> Column:
    """True when the text holds anything but white space."""
    return F.coalesce(text.rlike(r"(?U)[^\s\x1c-\x1f]"), F.lit(False))


def one_line(text: Column) -> Column:
    return F.replace(text, F.lit("\n"), F.lit(" "))


def text_or(text: Column, default: str) -> Column:
    """The text, or ``default`` where it is NULL or empty."""
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(default))


def number_or(number: Column, default: str) -> Column:
    """The number as text, or ``default`` where it is NULL or 0."""
    return F.coalesce(F.nullif(number, F.lit(0)).cast("string"), F.lit(default))


def flag_text(flag: Column) -> Column:
    """``yes``, ``no`` or, for NULL, the empty text."""
    return F.when(flag.isNull(), "").when(flag, "yes").otherwise("no")


def is_yes(text: Column) -> Column:
    return F.coalesce(F.lower(text) == "yes", F.lit(False))


def is_sent(text: Column) -> Column:
    return F.coalesce(F.lower(text).isin("yes", "true", "1"), F.lit(False))


def post_id_from_url(url: Column) -> Column:
    """The piece after the first ``/comments/``, up to the next slash; NULL if there is none."""
    tail = F.get(F.split(url, "/comments/"), F.lit(1))
    return F.nullif(F.get(F.split(tail, "/"), F.lit(0)), F.lit(""))


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent, NULL when there is nothing to divide."""
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100.0


def percent_text(part: Column, whole: Column) -> Column:
    """One decimal, halves to even, ``N/A`` when there is nothing to divide."""
    rate = percent(part, whole)
    return F.when(rate.isNull(), "N/A").otherwise(F.format_string("%.1f%%", F.bround(rate, 1)))
