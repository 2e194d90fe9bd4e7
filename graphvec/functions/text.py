"""Column functions over identifiers, names, times and payloads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UUID = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def canonical_id(c: Column) -> Column:
    """UUIDs in lower case, anything else as it is."""
    return F.when(c.rlike(UUID), F.lower(c)).otherwise(c)


def collection_name(c: Column) -> Column:
    """A name that search services accept: lower case, runs of other characters than letters,
    digits and dashes as one dash, no dash at the ends, 128 characters at most."""
    x = F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9-]", "-"), "-+", "-")
    x = F.regexp_replace(x, "^-+|-+$", "")
    x = F.when(x.rlike("^[0-9]"), F.concat(F.lit("idx-"), x)).otherwise(x)
    x = F.when(F.length(x) > 128, F.regexp_replace(F.substring(x, 1, 128), "-+$", "")).otherwise(x)
    return F.when(x == "", "default-index").otherwise(x)


def prefixed_name(prefix: str, c: Column) -> Column:
    return F.lower(F.concat(F.lit(prefix + "_"), c))


def parse_time(c: Column) -> Column:
    """Epoch milliseconds or ISO 8601 with or without a fraction; null if neither."""
    millis = F.timestamp_millis(F.when(c.rlike(r"^-?\d+$"), c.cast("bigint")))
    iso = [F.try_to_timestamp(c, F.lit(f"yyyy-MM-dd'T'HH:mm:ss{f}XXX")) for f in (".SSSSSSSSS", ".SSSSSS", ".SSS", "")]
    return F.coalesce(millis, *iso)


# one token of a literal: a quoted text, a word, white space, a closing bracket with a comma before it, or any other character
_TOKEN = r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|[A-Za-z0-9_.+-]+|\s+|,\s*[\])}]|."""
# one part of a quoted text: an escape, or what needs none
_PART = r"""\\x[0-9a-fA-F]{2}|\\u[0-9a-fA-F]{4}|(?s:\\.)|[^\\"]+|\""""


def literal_json(c: Column) -> Column:
    """A Python literal of dicts, lists, tuples, texts, numbers, True, False and None as JSON text.  Its
    tokens are taken left to right, each once, so brackets, quotes and names within quotes stay as they are."""
    def part(p: Column) -> Column:
        control = F.when(p == r"\a", r"\u0007").when(p == r"\v", r"\u000b").when(p == r"\0", r"\u0000")
        same = p.isin(r"\\", r"\"", r"\n", r"\t", r"\r", r"\b", r"\f") | p.rlike(r"^\\u....$")
        unknown = F.concat(F.lit("\\"), p)  # Python keeps the backslash of an escape that it does not know
        escape = F.when(same, p).when(p == r"\'", "'").when(p == "\\\n", "").when(p.rlike(r"^\\x"), F.concat(F.lit(r"\u00"), p.substr(3, 2))).otherwise(F.coalesce(control, unknown))
        return F.when(p == '"', r"\"").when(p.startswith("\\"), escape).otherwise(p)

    def token(t: Column) -> Column:
        inner = F.regexp_extract_all(F.substring(t, F.lit(2), F.length(t) - 2), F.lit(_PART), F.lit(0))
        plain = F.when(~t.rlike(r'[\\"]'), F.substring(t, F.lit(2), F.length(t) - 2))  # quoted by ', without escapes
        text = F.concat(F.lit('"'), F.coalesce(plain, F.array_join(F.transform(inner, part), "")), F.lit('"'))
        word = F.when(t == "None", "null").when(t == "True", "true").when(t == "False", "false").when(t == "(", "[").when(t.rlike(r"(?s)^(,.*)?\)$"), "]").when(t.rlike("(?s)^,."), F.substring(t, -1, 1)).otherwise(t)
        return F.when(t.rlike("^['\"]."), text).when(t.rlike(r"^\s"), "").otherwise(word)

    return F.array_join(F.transform(F.regexp_extract_all(c, F.lit(_TOKEN), F.lit(0)), token), "")


def payload(c: Column) -> Column:
    """The payload as VARIANT: JSON, else what it says as a literal, else an empty object.  What
    follows a whole value is not looked at."""
    return F.coalesce(F.try_parse_json(c), F.try_parse_json(literal_json(c)), F.parse_json(F.lit("{}")))


def payload_with_id(payload_text: Column, row_id: Column) -> Column:
    """The payload as JSON text with this id, whatever id it had."""
    members = F.from_json(F.to_json(payload(payload_text)), "map<string, variant>")
    own = F.create_map(F.lit("id"), F.parse_json(F.to_json(F.array(row_id.cast("string"))).substr(F.lit(2), F.length(F.to_json(F.array(row_id.cast("string")))) - 2)))
    return F.to_json(F.map_concat(F.map_filter(F.coalesce(members, F.create_map().cast("map<string, variant>")), lambda k, _: k != "id"), own))


NAMED_CHARACTERS = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": "\u00a0", "amp": "&"}


def unescape(c: Column) -> Column:
    """HTML character references, named (the ones above) and numbered, as the characters they stand for; one reading,
    so `&amp;lt;` is `&lt;`."""
    parts = F.regexp_extract_all(c, F.lit(r"&(?:[a-z]+|#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6});|[^&]+|&"), F.lit(0))
    number = lambda x: F.when(x.rlike("^&#[xX]"), F.conv(F.regexp_extract(x, "[0-9a-fA-F]+(?=;)", 0), 16, 10)).otherwise(F.regexp_extract(x, "[0-9]+", 0)).cast("bigint")

    def read(x: Column) -> Column:
        named = x
        for name, char in NAMED_CHARACTERS.items():
            named = F.when(x == f"&{name};", char).otherwise(named)
        n = number(x)
        known = ((n > 0) & (n < 0xD800)) | ((n > 0xDFFF) & (n <= 0x10FFFF))
        char = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
        return F.when(x.rlike("^&#.+;") & known, char).otherwise(named)

    return F.when(F.contains(c, F.lit("&")), F.array_join(F.transform(parts, read), "")).otherwise(c)
