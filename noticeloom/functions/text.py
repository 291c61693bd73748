"""HTML and text cleaning as built-in column expressions."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from noticeloom.functions.arrays import bind

# Parts of a page that carry no text: comments, script, noscript and style bodies, declarations, tags.
# Attributes are read in possessive runs, which take a tag of any length without a stack; the last branch is
# for tags with an unclosed quote. Without the possessive marks the pattern matches the same (see data.py).
MARKUP = (
    r"(?is)<(?:!--.*?-->"
    r"|script\b[^>]*>.*?</script\s*>"
    r"|noscript\b[^>]*>.*?</noscript\s*>"
    r"|style\b[^>]*>.*?</style\s*>"
    r"|![a-z][^>]*>"
    r"|/?[a-z](?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
    r"|/?[a-z][^>]*>)"
)
INPUT_WITH_VALUE = r"(?is)<input\b(?=[^>]*\bvalue\s*=)(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"
ASTRAL = r"[\x{10000}-\x{10FFFF}]"
SPACE_OR_ASTRAL = r"[ \x{10000}-\x{10FFFF}]"
# White space at the edges of a value: ASCII white space and the Unicode separators.
EDGE_SPACE = " \t\n\r\f\v\u00a0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(chr(c) for c in range(0x2000, 0x200B))
NOT_WORD = r"[^\p{L}\p{N}_]"

# The patterns and entity names the cleaning rules are defined by.
PIECE_BREAK = r"['\"]\w+['\":]+"
CDATA = r"(?i)//<!\[CDATA\[[^>]*//\]\]>"
OLD_SCRIPT = r"(?i)<\s*script[^>]*>[^<]*<\s*/\s*script\s*>"
OLD_STYLE = r"(?i)<\s*style[^>]*>[^<]*<\s*/\s*style\s*>"
OLD_BREAK = r"<br\s*?/?>"
OLD_TAG = r"</?\w+[^>]*>"
OLD_OTHER = r"<[^>]+>"
OLD_COMMENT = r"<!--[^>]*-->"
ENTITY_NAMES = {
    "nbsp": " ", "160": " ",
    "lt": "<", "60": "<",
    "gt": ">", "62": ">",
    "amp": "&", "38": "&",
    "quot": '"', "34": '"',
}
# Names of character references: those that need a semicolon, and the old ones that do not.
CLOSED_NAMES = {name[:-1]: chars for name, chars in html5.items() if name.endswith(";")}
OPEN_NAMES = {name: chars for name, chars in html5.items() if not name.endswith(";")}
# Numbers that stand for another character: null, and the control range by its Windows meaning.
MOVED_NUMBERS = {0: "\ufffd", 13: "\r"} | {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}
MD5_MARK = "@crazy@"
VALUE_LIMIT = 300


def _literal_map(values: dict, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(values)), f"map<{kind},string>")


def code_point(number: Column) -> Column:
    """The character of a numeric reference; a number that is no character gives U+FFFD, a control none."""
    moved = F.element_at(_literal_map({str(k): v for k, v in MOVED_NUMBERS.items()}, "string"), number.cast("string"))
    none = number.isNull() | (number > 0x10FFFF) | number.between(0xD800, 0xDFFF)
    control = number.between(1, 0x1F) & ~number.isin(9, 10, 12) | (number == 0x7F) | number.between(0xFDD0, 0xFDEF) | (number.bitwiseAND(0xFFFE) == 0xFFFE)
    char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    return F.coalesce(moved, F.when(none, F.lit("\ufffd")).when(control, F.lit("")).otherwise(char))


def decode_entities(text: Column) -> Column:
    """Named and numeric character references of HTML5, each decoded once, left to right.

    A name without its semicolon counts if it is one of the old ones, by the longest that fits.
    """
    closed = _literal_map(CLOSED_NAMES, "string")
    opened = _literal_map(OPEN_NAMES, "string")
    old = f"^({'|'.join(sorted(OPEN_NAMES, key=len, reverse=True))})"

    def one(piece: Column) -> Column:
        """A piece that followed an ampersand."""
        plain = F.concat(F.lit("&"), piece)

        def number(digits: Column, base: int) -> Column:
            short = F.when(F.length(F.ltrim(digits, F.lit("0"))) <= 9, F.conv(digits, base, 10).cast("bigint"))
            return code_point(short)

        def numeric(pattern: str, base: int) -> Column:
            return F.concat(number(F.regexp_extract(piece, pattern, 1), base), F.regexp_replace(piece, pattern, ""))

        def named(name: Column) -> Column:
            whole = F.element_at(closed, name)
            first = F.regexp_extract(piece, old, 1)
            return F.coalesce(
                F.concat(whole, F.substr(piece, F.length(name) + 2)),
                F.concat(F.element_at(opened, first), F.substr(piece, F.length(first) + 1)),
                plain,
            )

        return (
            F.when(piece.rlike("^#[0-9]"), numeric("^#([0-9]+);?", 10))
            .when(piece.rlike("^#[xX][0-9a-fA-F]"), numeric("^#[xX]([0-9a-fA-F]+);?", 16))
            .when(piece.rlike("^[A-Za-z]"), bind(F.regexp_extract(piece, "^([0-9A-Za-z]{1,32});", 1), named))
            .otherwise(plain)
        )

    def decode(value: Column) -> Column:
        pieces = F.split(value, "&", -1)
        joined = F.array_join(F.transform(pieces, lambda p, i: F.when(i == 0, p).otherwise(one(p))), "")
        return F.when(F.contains(value, F.lit("&")), joined).otherwise(value)

    return bind(text, decode)


ENTITY = r"&#?[\p{L}\p{N}_]+;"


def replace_entities(text: Column) -> Column:
    """The basic entities replaced and other entities removed until none is left.

    Two rounds settle all but nested ones; only a text that still holds an entity goes on, for at most
    as many rounds as it has ampersands.
    """

    def once(value: Column) -> Column:
        names = "|".join(name for name, char in ENTITY_NAMES.items() if char == "&")
        value = F.regexp_replace(value, rf"&(?:#?(?:{names});)+", "&")
        for char in dict.fromkeys(ENTITY_NAMES.values()):
            if char != "&":
                names = "|".join(name for name, c in ENTITY_NAMES.items() if c == char)
                value = F.regexp_replace(value, rf"&#?(?:{names});", char)
        return F.regexp_replace(value, ENTITY, "")

    def rest(value: Column) -> Column:
        rounds = F.when(value.rlike(ENTITY), F.sequence(F.lit(1), F.size(F.split(value, "&", -1)))).otherwise(F.array().cast("array<int>"))
        return F.aggregate(rounds, value, lambda held, _: F.when(held.rlike(ENTITY), once(held)).otherwise(held))

    return bind(text, lambda value: F.when(F.contains(value, F.lit("&")), bind(once(once(value)), rest)).otherwise(value))


def strip_tags_plain(html: Column) -> Column:
    """Unescape, drop CDATA, script, style, tags and comments; br gives a line, td a space."""
    text = decode_entities(F.coalesce(html, F.lit("")))
    for pattern, by in (
        (CDATA, ""),
        (OLD_SCRIPT, ""),
        (OLD_STYLE, ""),
        (OLD_BREAK, "\n"),
        ("</td>", " "),
        (OLD_TAG, ""),
        (OLD_OTHER, ""),
        (OLD_COMMENT, ""),
    ):
        text = F.regexp_replace(text, pattern, by)
    return replace_entities(text)


def visible_text(html: Column) -> Column:
    """String value of a page without markup."""
    return decode_entities(F.regexp_replace(html, MARKUP, ""))


def hidden_input_text(html: Column) -> Column:
    """Longest piece of the text hidden in ``input value=`` attributes, the first of equals."""
    hidden = F.array_join(F.transform(F.regexp_extract_all(html, F.lit(INPUT_WITH_VALUE), 0), strip_tags_plain), "")
    pieces = F.split(hidden, PIECE_BREAK, -1)
    ranked = F.transform(pieces, lambda p, i: F.struct(F.length(p).alias("n"), (-i).alias("i"), p.alias("p")))
    return F.when(F.contains(F.lower(html), F.lit("<input")), F.array_max(ranked)["p"]).otherwise(F.lit(""))


def squeeze_lines(text: Column, breaks: str = r"[\r\n\f\t]+") -> Column:
    """Spaces and astral characters dropped, each run of line breaks and tabs made one line end."""
    return F.regexp_replace(F.regexp_replace(text, SPACE_OR_ASTRAL, ""), breaks, "\n")


def _with_breaks(html: Column) -> Column:
    return F.regexp_replace(F.coalesce(html, F.lit("")), r"</(p|tr|td)>", "\n</$1>")


def clean_html(html: Column, hidden_inputs: bool = True) -> Column:
    """Text of a notice page; null and empty pages give an empty string."""

    def text(page: Column) -> Column:
        return F.concat(hidden_input_text(page), visible_text(page)) if hidden_inputs else visible_text(page)

    return squeeze_lines(bind(_with_breaks(html), text))


def clean_html_short(html: Column) -> Column:
    """Variant without the hidden-input step that also removes tabs."""
    return squeeze_lines(F.translate(visible_text(_with_breaks(html)), "\t", ""), r"[\r\n\f]+")


def word_content(html: Column) -> Column:
    """Word characters of a page in quotes, empty when there are none."""
    words = F.regexp_replace(F.regexp_replace(visible_text(F.coalesce(html, F.lit(""))), ASTRAL, ""), NOT_WORD, "")
    return bind(words, lambda w: F.when(w == "", F.lit("")).otherwise(F.concat(F.lit("'"), w, F.lit("'"))))


def fingerprint(text: Column) -> Column:
    return F.md5(text)


def strip_space(text: Column) -> Column:
    return F.btrim(text, F.lit(EDGE_SPACE))


def general_value(value: Column, limit: int | None = None) -> Column:
    """Trim, drop line ends, tabs and spaces; with a ``limit``, cut to so many characters."""
    plain = F.translate(strip_space(value), "\n\r\t ", "")
    return plain if limit is None else F.substring(plain, 1, limit)


def compact_key(value: Column) -> Column:
    """Field-name cleaning: every kind of space removed, no-break, ideographic and en space too."""
    return F.translate(value, " \n\r\t\u00a0\u3000\u2002", "")


def cap(text: Column, limit: int) -> Column:
    return F.substring(text, 1, limit)


def add_md5_mark(text: Column, md5: Column) -> Column:
    return F.concat(text, F.lit(MD5_MARK), md5)


def drop_md5_mark(text: Column) -> Column:
    return F.get(F.split(text, MD5_MARK, 2), 0)


def bracket_fields(text: Column) -> Column:
    """``【key】value`` text to a map; a later key replaces an earlier one."""

    def build(keys: Column, values: Column) -> Column:
        names = F.array_distinct(keys)
        last = F.transform(
            names, lambda k: F.element_at(F.filter(F.arrays_zip(keys.alias("k"), values.alias("v")), lambda e: e["k"] == k), -1)["v"]
        )
        return F.map_from_arrays(names, last)

    keys = F.transform(F.regexp_extract_all(text, F.lit("【([^【】]*)】([^【】]*)"), 1), compact_key)
    values = F.regexp_extract_all(text, F.lit("【([^【】]*)】([^【】]*)"), 2)
    return build(keys, values)


def post_fields(text: Column) -> Column:
    """Sender and body of a mail-style post; null when the post does not match."""
    plain = F.replace(text, F.lit("\u00a0"), F.lit(" "))

    def found(pattern: str) -> Column:
        return F.when(plain.rlike(pattern), F.regexp_extract(plain, pattern, 1))

    return F.struct(
        found(r"发信人: (.+?),").alias("sender"),
        F.trim(found(r"站内(.+?)--")).alias("content"),
    )


def text_link(source: Column, text: Column) -> Column:
    """Deep link that highlights ``text`` in the source page."""
    return F.concat(F.coalesce(source, F.lit("")), F.lit("#:~:text="), F.coalesce(text, F.lit("")))
