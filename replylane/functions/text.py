"""Text, time and n-gram expressions.

Word and space classes are spelled out so that they agree with Unicode-aware matching
elsewhere: a word character is a letter, a number or an underscore, and white space
includes the four separator controls U+001C..U+001F.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, DataFrame, functions as F

# Text that a CSV scan reads as null.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# What cleaning removes, and what counts as a token.
URL = r"(?U)https?://[^\s\x{1C}-\x{1F}]+"
MENTION = r"@[\p{L}\p{N}_]+"
SPACES = r"(?U)[\s\x{1C}-\x{1F}]+"
TOKEN = r"[\p{L}\p{N}_]{2,}"
MESSAGE_TIME = "MMM d HH:mm:ss Z yyyy"
WEEKDAY = "^(Mon|Tue|Wed|Thu|Fri|Sat|Sun) "


def _names_pattern(names: list[str]) -> str:
    """One pattern for many names that goes letter by letter and prefers the longest."""
    tree: dict = {}
    for name in names:
        node = tree
        for letter in name:
            node = node.setdefault(letter, {})
        node[""] = {}

    def write(node: dict) -> str:
        parts = [letter + write(below) for letter, below in sorted(node.items()) if letter]
        if not parts:
            return ""
        body = parts[0] if len(parts) == 1 and "" not in node else f"(?:{'|'.join(parts)})"
        return body + "?" if "" in node else body

    return write(tree)


_ENTITY_NAME = f"^{_names_pattern(list(html5))}"
_NUMBER = "^#(?:[0-9]+|[xX][0-9a-fA-F]+);?"
# Numbers that stand for the characters of Windows-1252.
WINDOWS = "€\x81‚ƒ„…†‡ˆ‰Š‹Œ\x8dŽ\x8f\x90‘’“”•–—˜™š›œ\x9džŸ"


def _named(name: Column) -> Column:
    """The text of an entity's name, from a constant table."""
    table = F.str_to_map(
        F.lit("\x1e".join(f"{k}\x1f{v}" for k, v in html5.items())), F.lit("\x1e"), F.lit("\x1f")
    )
    return F.element_at(table, name)


def _numbered(written: Column) -> Column:
    """The character of a number as it stands after the ampersand."""
    digits = F.regexp_replace(written, "[#;]", "")
    hexadecimal = digits.rlike("^[xX]")
    digits = F.regexp_replace(digits, "^[xX]?0*(?=.)", "")
    number = F.when(F.length(digits) > 8, F.lit(0x110000)).otherwise(
        F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(digits).cast("long")
    )
    utf32 = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    low = number.bitwiseAND(F.lit(0xFFFF))
    nothing = (
        number.between(0x1, 0x8) | number.between(0xB, 0xB) | number.between(0xE, 0x1F) | (number == 0x7F)
        | number.between(0xFDD0, 0xFDEF) | ((number >= 0xFFFE) & low.isin(0xFFFE, 0xFFFF))
    )
    return (
        F.when((number == 0) | number.between(0xD800, 0xDFFF) | (number > 0x10FFFF), F.lit("\ufffd"))
        .when(number.between(0x80, 0x9F), F.substring(F.lit(WINDOWS), (number - 127).cast("int"), F.lit(1)))
        .when(nothing, F.lit(""))
        .otherwise(utf32)
    )


def _decoded(part: Column) -> Column:
    """What follows an ampersand, up to the next, with the entity it begins with decoded."""
    number = F.regexp_extract(part, _NUMBER, 0)
    name = F.regexp_extract(part, _ENTITY_NAME, 0)
    return (
        F.when(number != "", F.concat(_numbered(number), F.substr(part, F.length(number) + 1)))
        .when(name != "", F.concat(_named(name), F.substr(part, F.length(name) + 1)))
        .otherwise(F.concat(F.lit("&"), part))
    )


def null_if_token(text: Column) -> Column:
    return F.when(~text.isin(*NULL_TOKENS), text)


def decode_entities(text: Column) -> Column:
    """One pass over all HTML5 entities; the longest name counts, with or without semicolon.

    No entity holds an ampersand, so each stretch behind one is decoded by itself.
    """
    parts = F.split(text, "&")
    rest = F.transform(F.slice(parts, F.lit(2), F.size(parts) - 1), _decoded)
    return F.when(
        text.contains("&"), F.concat(F.element_at(parts, 1), F.array_join(rest, ""))
    ).otherwise(text)


def clean_text(text: Column) -> Column:
    """Null-safe: decode entities, drop links and mentions, collapse white space, trim."""
    out = decode_entities(F.coalesce(text, F.lit("")))
    for pattern, replacement in ((URL, ""), (MENTION, ""), (SPACES, " ")):
        out = F.regexp_replace(out, pattern, replacement)
    return F.trim(out)


def parse_message_time(text: Column) -> Column:
    """``Tue Oct 31 22:10:47 +0000 2017`` to a timestamp; anything else becomes null.

    The weekday is checked apart from the rest, as Spark parses no weekday names.
    """
    rest = F.when(text.rlike(WEEKDAY), F.substr(text, F.lit(5)))
    return F.try_to_timestamp(rest, F.lit(MESSAGE_TIME))


def month_of(time: Column) -> Column:
    return F.date_trunc("month", time)


def strip(text: Column) -> Column:
    """Trim all white space, line ends included."""
    space = r"[\s\x{1C}-\x{1F}]"
    return F.regexp_replace(text, rf"(?U)\A{space}+|(?<!{space}){space}+\z", "")


def is_blank(text: Column) -> Column:
    return ~F.coalesce(text, F.lit("")).rlike(r"(?U)[^\s\x{1C}-\x{1F}]")


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def with_terms(
    df: DataFrame, text_col: str, out: str = "terms", ngrams: tuple[int, int] = (1, 2)
) -> DataFrame:
    """Add the array of all n-grams of ``text_col``, in order, repeats kept.

    Tokens are a column of their own first, so the pattern runs once per row.
    """
    low, high = ngrams
    df = df.withColumn("_tokens", tokens(F.coalesce(F.col(text_col), F.lit(""))))
    size = F.size("_tokens")
    grams, wanted = F.col("_tokens"), []
    for n in range(1, high + 1):
        if n > 1:
            kept = F.greatest(size - (n - 1), F.lit(0))
            grams = F.zip_with(
                F.slice(grams, F.lit(1), kept),
                F.slice("_tokens", F.lit(n), kept),
                lambda left, right: F.concat(left, F.lit(" "), right),
            )
        if n >= low:
            wanted.append(grams)
    terms = wanted[0] if len(wanted) == 1 else F.concat(*wanted)
    return df.withColumn(out, terms).drop("_tokens")


def display_label(label: Column) -> Column:
    return F.initcap(F.replace(label, F.lit("_"), F.lit(" ")))


def display_percent(share: Column) -> Column:
    return F.format_string("%.0f%%", F.bround(share * 100, 0))
