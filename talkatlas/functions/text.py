"""Text expressions: decoding, JSON turns, XML, tags, tokens.

All of them are built-in expressions, so they stay inside the JVM, apply to
whole texts and add no shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Words left out of the token counts.
STOP_WORDS = (
    "the a an and or of to for in on with from by as about "
    "this that those these is are was were be been being "
    "i you he she it we they my your his her their our me us them "
    "do did done does doing have has had having"
).split()

# Fixed value: a token is a letter followed by two or more letters, hyphens or
# apostrophes, in lower-cased text.
TOKEN_PATTERN = r"[A-Za-z][A-Za-z\-']{2,}"

# XML entities; the ampersand has to come first.
XML_ENTITIES = (
    ("&", "&amp;"),
    ("<", "&lt;"),
    (">", "&gt;"),
    ('"', "&quot;"),
    ("'", "&apos;"),
)

TURNS_TYPE = "ARRAY<STRUCT<role: STRING, text: STRING>>"


def strip(col: Column) -> Column:
    """Trim the whitespace set of Python's ``strip`` from both ends."""
    return F.btrim(col, F.lit(WHITESPACE))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used.

    A plain expression is copied to each place that mentions it; a lambda
    variable is not.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _kept_base64_length(symbols: Column) -> Column:
    """Length of base64 data in front of the padding that ends it.

    Padding ends the data only where it completes a group of four (``xx==`` or
    ``xxx=``); any other ``=`` is skipped.  Null when the data are incomplete.
    """
    runs = F.regexp_extract_all(symbols, F.lit("[^=]+=*"), F.lit(0))
    start = F.struct(F.lit(0).alias("n"), F.lit(False).alias("ended"))

    def step(state: Column, run: Column) -> Column:
        data = F.length(F.rtrim(run, F.lit("=")))
        pads = F.length(run) - data
        n = state["n"] + data
        fill = n % 4
        ended = ((fill == 2) & (pads >= 2)) | ((fill == 3) & (pads >= 1))
        return F.when(state["ended"], state).otherwise(
            F.struct(n.alias("n"), ended.alias("ended"))
        )

    def finish(state: Column) -> Column:
        return F.when(state["ended"] | (state["n"] % 4 == 0), state["n"])

    return F.aggregate(runs, start, step, finish)


def _padded_base64(symbols: Column) -> Column:
    """Base64 symbols with exact padding; null when they are incomplete."""

    def plain(body: Column) -> Column:
        pads = F.length(symbols) - F.length(body)
        fill = F.length(body) % 4
        whole = (fill == 0) | ((fill == 2) & (pads >= 2)) | ((fill == 3) & (pads >= 1))
        # The walk over runs is needed only for the rare text with an inner "=".
        return F.when(F.contains(body, F.lit("=")), _kept_base64_length(symbols)).otherwise(
            F.when(whole, F.length(body))
        )

    def pad(kept: Column) -> Column:
        data = F.substring(F.replace(symbols, F.lit("="), F.lit("")), F.lit(1), kept)
        return F.rpad(data, (kept + 3) - (kept + 3) % 4, F.lit("="))

    return let(let(F.rtrim(symbols, F.lit("=")), plain), pad)


def decode_base64(encoded: Column) -> Column:
    """Base64 text to UTF-8 text; the empty string on null or on any failure.

    Characters outside the base64 alphabet are ignored, but text that is not
    ASCII is rejected.  Spark's own decoder accepts unpadded input, so the
    padding is checked here first.
    """
    # In ASCII text a character is one byte.
    ascii_only = let(strip(encoded), lambda s: F.when(F.length(s) == F.octet_length(s), s))
    symbols = F.regexp_replace(ascii_only, "[^A-Za-z0-9+/=]+", "")
    raw = F.try_to_binary(let(symbols, _padded_base64), F.lit("base64"))
    return F.coalesce(F.try_validate_utf8(raw.cast("string")), F.lit(""))


def parse_turns(json_text: Column) -> Column:
    """The ``turns`` array of a JSON object; an empty array on any failure.

    The parser stops at the end of the first complete value and ignores what
    follows.  So the object is parsed as the first of two elements, and the
    second, which names a hash of the text, has to be found behind it.  A text
    that closes the array early hides that element, and none can contain its
    own hash.
    """

    def checked(text: Column) -> Column:
        ends = F.concat(F.lit("["), text, F.lit(',{"end":"'), F.md5(text.cast("binary")), F.lit('"}]'))
        schema = f"ARRAY<STRUCT<turns: {TURNS_TYPE}, end: STRING>>"
        read = F.from_json(ends, schema, {"allowSingleQuotes": "false"})
        whole = lambda w: (F.size(w) == 2) & (F.get(w, F.lit(1))["end"] == F.md5(text.cast("binary")))
        return let(read, lambda w: F.when(whole(w), F.get(w, F.lit(0))["turns"]))

    return F.coalesce(let(json_text, checked), F.array().cast(TURNS_TYPE))


def decode_turns(encoded: Column) -> Column:
    """Base64 of a JSON object to its turns."""
    return parse_turns(decode_base64(encoded))


def xml_escape(col: Column) -> Column:
    for plain, entity in XML_ENTITIES:
        col = F.replace(col, F.lit(plain), F.lit(entity))
    return col


def _text_or_empty(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def conversation_xml(
    conv_id: Column, timestamp: Column, title: Column | None, turns: Column
) -> Column:
    """One role-tagged document per conversation, one line per turn."""
    conv_id, timestamp = (xml_escape(_text_or_empty(c)) for c in (conv_id, timestamp))
    head = [
        F.concat(F.lit('<conversation id="'), conv_id, F.lit('">')),
        F.lit("  <meta>"),
        F.concat(F.lit("    <timestamp>"), timestamp, F.lit("</timestamp>")),
    ]
    if title is not None:
        line = F.concat(F.lit("    <title>"), xml_escape(title), F.lit("</title>"))
        head.append(F.when(title != "", line))
    head.append(F.lit("  </meta>"))
    lines = F.transform(
        turns,
        lambda t: F.concat(
            F.lit('  <turn role="'),
            xml_escape(_text_or_empty(t["role"])),
            F.lit('">'),
            xml_escape(_text_or_empty(t["text"])),
            F.lit("</turn>"),
        ),
    )
    lines = F.coalesce(lines, F.array().cast("array<string>"))
    return F.concat_ws("\n", F.array_compact(F.array(*head)), lines, F.lit("</conversation>"))


def tag_text(col: Column, tag: str) -> Column:
    """Trimmed content of the first ``<tag>...</tag>``, or the empty string."""
    return strip(F.regexp_extract(F.coalesce(col, F.lit("")), f"(?isu)<{tag}>(.*?)</{tag}>", 1))


def statement_block(lines: Column) -> Column:
    """Trimmed non-blank statements, one per line."""
    return F.array_join(F.filter(F.transform(lines, strip), lambda s: s != ""), "\n")


def words(col: Column) -> Column:
    """Lower-case words in reading order."""
    return F.regexp_extract_all(F.lower(col), F.lit(TOKEN_PATTERN), F.lit(0))


def concern_score(col: Column) -> Column:
    """The concern text as an integer from 1 to 5, else null."""
    score = strip(col).try_cast("int")
    return F.when(score.between(1, 5), score)
