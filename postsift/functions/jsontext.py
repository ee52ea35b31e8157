"""Model answers as text: find the JSON in them, read it, and build request text."""

from string import Formatter

from pyspark.sql import Column, functions as F

from postsift.functions.text import bind, strip

# How JSON is looked for in an answer, first a fenced block, then the widest span.
FENCED = r"(?sU)```(?:json)?\s*([\[{].*?[\]}])\s*```"
WIDEST = r"(?s)([\[{].*[\]}])"

ENVELOPE_PATH = "$.candidates[0].content.parts[0].text"


def envelope_text(raw: Column) -> Column:
    """Answer text of a response envelope; NULL where any step of the path is missing."""
    return F.get_json_object(raw, ENVELOPE_PATH)


def extract_json(raw: Column) -> Column:
    """The JSON part of an answer: as is, fenced, widest span, or else the stripped answer."""
    def search(text):
        blank = F.lit("")
        return F.coalesce(
            F.when(text.startswith("{") | text.startswith("["), text),
            F.nullif(F.regexp_extract(text, FENCED, 1), blank),
            F.nullif(F.regexp_extract(text, WIDEST, 1), blank),
            text,
        )

    return bind(strip(raw), search)


def parse_json(text: Column) -> Column:
    """The text as a variant, NULL unless all of it is one JSON value.

    The parser stops at the end of the first value. Wrapped once as an array item and once as an
    object field, text after the value makes at least one of the two unreadable.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    named = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    whole = bind(listed, lambda v: v.isNotNull() & F.try_variant_get(v, "$[1]", "variant").isNull())
    return F.when(whole, F.try_variant_get(named, "$.v", "variant"))


def is_object(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))


def is_array(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("ARRAY"), F.lit(False))


def items(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def field_or(value: Column, name: str, kind: str, default) -> Column:
    """A field of an object: ``default`` where it is absent, NULL where it is an explicit null."""
    path = f"$.{name}"
    absent = F.try_variant_get(value, path, "variant").isNull()
    return F.when(absent, F.lit(default)).otherwise(F.try_variant_get(value, path, kind))


def text_field(value: Column, name: str) -> Column:
    """A field that is a JSON string, NULL for any other kind of value."""
    kind = F.schema_of_variant(F.try_variant_get(value, f"$.{name}", "variant"))
    return F.when(kind == "STRING", F.try_variant_get(value, f"$.{name}", "string"))


def fill(template: str, **values: Column) -> Column:
    """The template with each ``{name}`` replaced by a column.

    The template is cut up while the query is built, so braces in the data are only data.
    """
    parts = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            parts.append(values[name].cast("string"))
    return F.concat(*parts) if parts else F.lit("")
