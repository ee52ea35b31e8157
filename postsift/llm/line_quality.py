"""Line-first quality rules in Spark expressions: clean line by line, then judge what is left."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Word and line rules.
SPACE = "[\\x20\\x09-\\x0D]+"
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
# A line fails when its runs of symbols, or its words in capitals, are more than this share of its words.
NOISE = "[#*$%&|<>]+|!!+"
MAX_NOISE_SHARE = 0.3
CAPITALS = "(?<![\\p{L}])[A-Z\\u00c0-\\u00d6\\u00d8-\\u00de]{2,}(?![\\p{L}])"
MAX_CAPITAL_SHARE = 0.6
MIN_CAPITAL_WORDS = 4
# Navigation: three or more short entries, each between a bar, an arrow or a bullet (or the start) and the next,
# that cover more than this share of the line. What a guillemet opens before it closes is a quotation.
NAVIGATION = "(?<![^|>\\u00bb\\u2022\\u00b7])[^|>\\u00ab\\u00bb\\u2022\\u00b7]{1,30}[|>\\u00bb\\u2022\\u00b7]"
MIN_NAVIGATION = 3
MAX_NAVIGATION_SHARE = 0.5
# Boilerplate, when there is a phrase of it in every so many words; and runs of one word, six times or more in a row,
# that cover more than this share of the line.
BOILERPLATE = (
    "[Cc]ookies? |[Jj]ava[Ss]cript|[Aa]ll [Rr]ights [Rr]eserved|[Tt]erms of (?:[Uu]se|[Ss]ervice)|"
    "[Pp]rivacy [Pp]olicy|[Rr]eleased under the .{1,20} [Ll]icen[cs]e|[Cc]lick here|[Ss]ign up|[Ll]og in|[Ll]orem ipsum"
)
WORDS_TO_A_PHRASE = 20
REPETITION = "(?<![^ ])([^ ]+)(?: \\1){5,}(?![^ ])"
MAX_REPETITION_SHARE = 0.3
# A document is rejected when its failing lines hold more than this share of its non-blank characters.
MAX_LOST_SHARE = 0.5


def word_array(text: Column) -> Column:
    """The words of a text without nulls."""
    body = F.btrim(text, F.lit(SPACES))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, SPACE))


def with_columns(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that later filters and projections read and never compute again.

    The one-element explode keeps the optimizer from copying their expressions upwards.
    """
    made = F.struct(*[c.alias(n) for n, c in columns.items()])
    rest = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*rest, F.explode(F.array(made)).alias("__made")).select(
        *rest, *[F.col(f"__made.{n}").alias(n) for n in columns])


def covered(line: Column, pattern: str) -> Column:
    """The share of a line's characters that matches of ``pattern`` take."""
    return 1 - F.length(F.regexp_replace(line, pattern, "")) / F.length(line)


def line_fails(line: Column) -> Column:
    """Whether the rules drop a line that has words: symbols, capitals, navigation, boilerplate, repetition."""
    words = F.length(line) - F.length(F.replace(line, F.lit(" "))) + 1
    capital = F.regexp_count(line, F.lit(CAPITALS))
    return (
        (F.regexp_count(line, F.lit(NOISE)) > words * MAX_NOISE_SHARE)
        | ((capital >= MIN_CAPITAL_WORDS) & (capital > words * MAX_CAPITAL_SHARE))
        | (line.rlike("[|>\\u00bb\\u2022\\u00b7]") & (F.regexp_count(line, F.lit(NAVIGATION)) >= MIN_NAVIGATION)
           & (covered(line, NAVIGATION) > MAX_NAVIGATION_SHARE))
        | (line.rlike(BOILERPLATE) & (F.regexp_count(line, F.lit(BOILERPLATE)) * WORDS_TO_A_PHRASE >= words))
        | (line.rlike(REPETITION) & (covered(line, REPETITION) > MAX_REPETITION_SHARE)))


def solid(text: Column) -> Column:
    """Characters other than blanks."""
    return F.length(F.replace(text, F.lit(" ")))


def quality(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base counts, the line verdicts, ``kept`` and the cleaned text.

    Added columns (replacing ones of these names): n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, n_lines, n_failed_lines, kept, cleaned. Null and empty texts have
    no words, so they fail the base rules and are not kept. ``cleaned`` is the text without its
    failing lines (null stays null). All in one pass, without a shuffle.

    Repeated words lie in a three-word window found twice or more. The windows' 64-bit hashes are
    sorted with their places in the low bits, so equal ones stand side by side; side by side is
    then confirmed by the whole hash. A text whose hashes all differ is done before that.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    frame = with_columns(docs, __words=word_array(body), __lines=F.split(body, "\n"))
    lines = F.transform("__lines", lambda x: F.struct(x.alias("line"), (x.rlike("[^\\x20\\x09-\\x0D]") & line_fails(x)).alias("fails")))
    size = F.size("__words")
    windows = F.transform(
        F.arrays_zip("__words", F.slice("__words", 2, F.greatest(size, F.lit(1))), F.slice("__words", 3, F.greatest(size, F.lit(1)))),
        lambda w: F.xxhash64(w))
    full = F.filter("__lines", lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    frame = with_columns(
        frame, __judged=lines, __full=full, __joined=F.array_join("__words", ""),
        __hashes=F.when(size >= WINDOW, F.slice(windows, 1, F.greatest(size - WINDOW + 1, F.lit(1)))).otherwise(F.array().cast("array<long>")))

    # The bits that the places take.
    mask = F.expr("shiftleft(1L, cast(ceil(log2(size(__hashes) + 1)) as int)) - 1")
    frame = with_columns(
        frame, __mask=F.when(F.size(F.array_distinct("__hashes")) < F.size("__hashes"), mask))
    packed = F.transform("__hashes", lambda h, i: h.bitwiseAND(F.bitwise_not(F.col("__mask"))).bitwiseOR(i))
    frame = with_columns(frame, __sorted=F.when(F.col("__mask").isNotNull(), F.sort_array(packed)))

    def equal(a, b):
        place = lambda x: x.bitwiseAND(F.col("__mask")).cast("int")
        return (a.bitwiseXOR(b) <= F.col("__mask")) & (a.bitwiseXOR(b) >= 0) & (
            F.get("__hashes", place(a)) == F.get("__hashes", place(b)))

    twice = F.filter("__sorted", lambda x, k: F.coalesce(equal(x, F.get("__sorted", k - 1)), F.lit(False))
                     | F.coalesce(equal(x, F.get("__sorted", k + 1)), F.lit(False)))
    frame = with_columns(frame, __at=F.sort_array(F.transform(twice, lambda x: x.bitwiseAND(F.col("__mask")).cast("int"))))
    covered = F.aggregate(
        F.transform("__at", lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get("__at", k + 1) - x, F.lit(WINDOW)))),
        F.lit(0), lambda a, x: a + x)
    failed = F.filter("__judged", lambda x: x["fails"])
    count = lambda c: c.cast("long")
    frame = with_columns(
        frame,
        n_words=count(F.size("__words")), word_chars=count(F.length("__joined")),
        n_symbols=count(F.regexp_count("__joined", F.lit(SYMBOLS))),
        n_dup_lines=count(F.size("__full") - F.size(F.array_distinct("__full"))),
        n_repeat_words=count(F.coalesce(covered, F.lit(0))),
        n_lines=count(F.size("__judged")), n_failed_lines=count(F.size(failed)),
        cleaned=F.when(F.col(f"`{text}`").isNotNull(), F.array_join(F.transform(
            F.filter("__judged", lambda x: ~x["fails"]), lambda x: x["line"]), "\n")))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    left = F.when(F.col("n_failed_lines") == 0, F.lit(True)).otherwise(
        solid(F.coalesce("cleaned", F.lit(""))) >= (1 - MAX_LOST_SHARE) * F.col("word_chars"))
    frame = with_columns(frame, base_failed=base, kept=~base & left)
    return frame.drop(*[c for c in frame.columns if c.startswith("__") and c not in docs.columns])


REPORT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
          "n_lines", "n_failed_lines")


def report(docs: DataFrame) -> DataFrame:
    """doc_id with the counts and verdicts of ``quality``; other columns are left out."""
    return quality(docs.select("doc_id", "text")).select("doc_id", *REPORT)


def filtered(docs: DataFrame) -> DataFrame:
    """The kept documents with their cleaned text (and n_chars, if there is one, set anew).

    The other columns stay as they are, whatever their names.
    """
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    done = quality(inner).where("kept")
    fresh = {"text": F.col("cleaned"), "n_chars": F.length("cleaned").cast("long")}
    return done.select(*[fresh.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
