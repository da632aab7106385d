"""Text expressions: stripping, HTML cleaning, keys, embedding input, redaction."""

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake import constants as C

# Fixed value: the characters Python's str.strip() and str.split() treat as blank.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
# The same set without the plain space; far faster than a listed class.
_ODD_BLANK = r"(?U)[\s\x{1c}-\x{1f}&&[^ ]]"

# One pass over comments, elements whose text nobody reads, and tags. Possessive
# quantifiers keep the regex engine from backtracking on hostile pages. A construct left open runs to the end.
_MARKUP = (
    r"(?is)<(?:!--.*?(?:-->|\z)"
    r"|(script|style|template|rt|rp)\b[^>]*+>.*?(?:</\1\s*+>|\z)"
    r"|[a-z/!?][^>=]*+"
    r"""(?>=\s*+(?:"[^"]*+"|'[^']*+')?+[^>=]*+)*+"""
    r"[^>]*+(?:>|\z))"
)


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it occurs in there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def or_empty(c) -> Column:
    """NULL becomes the empty string."""
    return F.coalesce(as_col(c), F.lit(""))


def nonempty(c) -> Column:
    """The empty string becomes NULL, so that coalesce() falls through on both."""
    return F.nullif(as_col(c), F.lit(""))


def strip(c) -> Column:
    """Remove every leading and trailing blank, not only spaces; NULL becomes ''."""
    return F.trim(or_empty(c), F.lit(BLANKS))


def collapse(c) -> Column:
    """Runs of blanks become one space; ends are stripped."""
    spaced = F.regexp_replace(or_empty(c), _ODD_BLANK, " ")
    return F.trim(F.regexp_replace(spaced, " {2,}", " "))


def literal_map(table: dict[str, str]) -> Column:
    """A constant string map; one literal to build and folded when the plan is made."""
    pairs = "\x1e".join(f"{key}\x1f{value}" for key, value in table.items())
    return F.str_to_map(F.lit(pairs), F.lit("\x1e"), F.lit("\x1f"))


def _named_entities() -> Column:
    """entity name -> character: the HTML 4 set plus ``apos``."""
    return literal_map({"apos": "'", **{n: chr(p) for n, p in name2codepoint.items()}})


def _code_point(cp: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(cp), 8, "0")), "UTF-32")


def decode_entities(c) -> Column:
    """Decode ``&name;``, ``&#n;`` and ``&#xh;``; anything unknown stays as it is."""
    named = _named_entities()

    def numeric(part: Column) -> Column:
        token = F.regexp_extract(part, r"^#(0*[0-9]{1,7}|[xX]0*[0-9a-fA-F]{1,6})", 1)
        is_hex = F.lower(token).startswith("x")
        cp = F.when(is_hex, F.conv(F.substr(token, F.lit(2)), 16, 10)).otherwise(
            nonempty(token)
        ).cast("int")
        valid = cp.between(1, 0x10FFFF) & ~cp.between(0xD800, 0xDFFF)
        rest = F.regexp_replace(F.substr(part, F.length(token) + 2), r"^;", "")
        return F.when(valid, F.concat(_code_point(cp), rest)).otherwise(
            F.concat(F.lit("&"), part)
        )

    def one(part: Column, index: Column) -> Column:
        name = F.regexp_extract(part, r"^([A-Za-z][A-Za-z0-9]{0,9});", 1)
        char = F.try_element_at(named, name)
        return (
            F.when(index == 0, part)
            .when(part.startswith("#"), numeric(part))
            .when(char.isNotNull(), F.concat(char, F.substr(part, F.length(name) + 2)))
            .otherwise(F.concat(F.lit("&"), part))
        )

    def decode(value: Column) -> Column:
        parts = F.transform(F.split(value, "&"), one)
        return F.when(value.contains("&"), F.array_join(parts, "")).otherwise(value)

    return let(as_col(c), decode)


def _clean(c, joint: str) -> Column:
    return collapse(decode_entities(F.regexp_replace(or_empty(c), _MARKUP, joint)))


def clean_spaced(c) -> Column:
    """HTML to text, text nodes joined with a space."""
    return _clean(c, " ")


def clean_tight(c) -> Column:
    """HTML to text, tags removed without a space so that particles stay attached."""
    return _clean(c, "")


def content_key(basis) -> Column:
    """sha1 hex of the stripped key basis."""
    return F.sha1(strip(basis).cast("binary"))


def key_basis(*candidates) -> Column:
    """The first candidate that is not blank, stripped; NULL when none is left."""
    return F.coalesce(*[nonempty(strip(c)) for c in candidates])


def first_ticker(c) -> Column:
    """First entry of a comma list, without its exchange prefix."""
    first = strip(F.substring_index(or_empty(c), ",", 1))
    return strip(F.substring_index(first, ":", -1))


def embed_text(title, body, *, body_chars: int = C.EMBED_BODY_CHARS) -> Column:
    """Embedding input: title, a space, the first characters of the body."""
    return strip(
        F.concat(or_empty(title), F.lit(" "), F.substring(or_empty(body), 1, body_chars))
    )


def redact(c) -> Column:
    """Hide the value of every ``key=`` parameter."""
    return F.regexp_replace(as_col(c), r"(?U)(key=)[^&\s]+", "$1[redacted]")


def truncate(c, chars: int) -> Column:
    return F.substring(as_col(c), 1, chars)


def job_detail(detail, error, *, error_chars: int = C.JOB_ERROR_CHARS) -> Column:
    """``detail | ERROR: message`` without dangling separators."""
    joined = F.concat(
        strip(detail), F.lit(" | ERROR: "), truncate(or_empty(error), error_chars)
    )
    return F.trim(joined, F.lit(" |"))


def norm_title(c) -> Column:
    """Lower-cased title with every run of non-letters and non-digits as one space."""
    return F.trim(F.regexp_replace(F.lower(or_empty(c)), r"[^\p{L}\p{N}]+", " "))


def headline(source, title, *, chars: int = C.HEADLINE_CHARS) -> Column:
    """Preview line: source, and the start of the title when there is one."""
    tail = F.when(
        nonempty(title).isNotNull(), F.concat(F.lit(" · "), truncate(title, chars))
    ).otherwise("")
    return F.concat(F.lit(C.LATEST_PREFIX), or_empty(source), tail)
