"""Contact-cleaning Column functions.

Everything here is a built-in expression, so it stays inside whole-stage
codegen. The phone and name helpers approximate full numbering-plan and
name-parser libraries; the covered cases are the ones in the docstrings.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# US state and territory names (lower case) to postal codes.
STATE_TO_CODE = {
    "alabama": "AL", "alaska": "AK", "arizona": "AZ", "arkansas": "AR", "california": "CA",
    "colorado": "CO", "connecticut": "CT", "delaware": "DE", "district of columbia": "DC",
    "florida": "FL", "georgia": "GA", "hawaii": "HI", "idaho": "ID", "illinois": "IL",
    "indiana": "IN", "iowa": "IA", "kansas": "KS", "kentucky": "KY", "louisiana": "LA",
    "maine": "ME", "maryland": "MD", "massachusetts": "MA", "michigan": "MI", "minnesota": "MN",
    "mississippi": "MS", "missouri": "MO", "montana": "MT", "nebraska": "NE", "nevada": "NV",
    "new hampshire": "NH", "new jersey": "NJ", "new mexico": "NM", "new york": "NY",
    "north carolina": "NC", "north dakota": "ND", "ohio": "OH", "oklahoma": "OK", "oregon": "OR",
    "pennsylvania": "PA", "puerto rico": "PR", "rhode island": "RI", "south carolina": "SC",
    "south dakota": "SD", "tennessee": "TN", "texas": "TX", "utah": "UT", "vermont": "VT",
    "virginia": "VA", "washington": "WA", "west virginia": "WV", "wisconsin": "WI", "wyoming": "WY",
}

# Name prefixes treated as titles by the name splitter.
NAME_TITLES = ["mr", "mrs", "ms", "miss", "mx", "dr", "prof", "rev", "sen", "rep", "gov", "hon", "sir"]

# NANP number in free text: optional +1 / 1, area code and exchange 2-9xx,
# separators space . - and parentheses; not glued to other digits.
# Spark form: look-arounds keep the boundaries out of the match (faster in
# Java). RE2 has no look-around, so SQL twins use the equivalent form that
# consumes one boundary character on each side.
PHONE_IN_TEXT_LOOKAROUND = (r"(?<![0-9])(?:\+?1[ .-]?)?\(?[2-9][0-9]{2}\)?[ .-]?"
                            r"[2-9][0-9]{2}[ .-]?[0-9]{4}(?![0-9])")
PHONE_IN_TEXT = (r"(^|[^0-9])(\+?1[ .-]?)?\(?([2-9][0-9]{2})\)?[ .-]?"
                 r"([2-9][0-9]{2})[ .-]?([0-9]{4})([^0-9]|$)")
VALID_PHONE = r"^1?[2-9][0-9]{9}$"
FIVE_DIGITS = r"[0-9]{5}"


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def canon_email(c) -> Column:
    """``TRIM(LOWER(x))``."""
    return F.trim(F.lower(_c(c)))


def email_key(c) -> Column:
    """canonical email with every dot removed (domain included)."""
    return F.replace(canon_email(c), F.lit("."), F.lit(""))


def is_valid_phone(c) -> Column:
    """whole-string NANP check, optional leading 1."""
    return _c(c).rlike(VALID_PHONE)


def phone10(c) -> Column:
    """last ten characters."""
    return F.right(_c(c), F.lit(10))


def zip5(c) -> Column:
    """first five characters, left-padded with zeros; null unless 5 digits."""
    z = F.lpad(F.left(_c(c), F.lit(5)), 5, "0")
    return F.when(z.rlike("^[0-9]{5}$"), z)


def extract_phone(c) -> Column:
    """First US number in free text as ``1`` + 10 digits; null if none
    (so 9-digit strings give null)."""
    # Any number holds three digits in a row, so texts without them skip the
    # costly pattern (a cheap scan). One pattern scan otherwise; the digits
    # come from the short match (only the optional leading 1 precedes them).
    t = _c(c)
    hit = F.when(t.rlike("[0-9]{3}"), F.regexp_extract(t, PHONE_IN_TEXT_LOOKAROUND, 0)).otherwise(F.lit(""))
    digits = F.regexp_replace(hit, "[^0-9]", "")
    return F.when(hit != "", F.concat(F.lit("1"), F.right(digits, F.lit(10))))


def extract_postal_code(c) -> Column:
    """First run of five digits, else null."""
    return F.nullif(F.regexp_extract(_c(c), FIVE_DIGITS, 0), F.lit(""))


# Words of a last name that stand before its main part, and suffixes that belong to no name part.
NAME_PARTICLES = ("van", "von", "der", "den", "de", "del", "della", "di", "da", "dos", "la", "le", "du", "bin", "ibn", "al", "st", "st.")
NAME_SUFFIXES = ("jr", "sr", "ii", "iii", "iv", "esq", "md", "phd")


def normalize_name_case(first, last) -> tuple[Column, Column]:
    """Re-case both names only if the whole name is all upper or all lower;
    parts after a hyphen or apostrophe and after Mc are capitalised, particles
    before the main part of a last name stay small. Mixed case is kept."""
    f, l_ = _c(first), _c(last)
    full = F.concat_ws(" ", f, l_)
    plain = (full == F.upper(full)) | (full == F.lower(full))

    def recase(x: Column) -> Column:
        # initcap capitalises after spaces only: a mark and a space make every
        # part a word ("doe-roe" -> "Doe-Roe"), then both are taken out
        marked = F.regexp_replace(F.lower(x), r"(-|'|\bmc(?=\p{L}{3}))", "$1\u0001 ")
        cased = F.replace(F.initcap(marked), F.lit("\u0001 "), F.lit(""))
        particles = "|".join(p.capitalize().replace(".", "[.]") for p in NAME_PARTICLES)
        return F.array_join(F.transform(F.split(cased, " "), lambda w, i: F.when(
            (i < F.size(F.split(cased, " ")) - 1) & w.rlike(f"^({particles})$"), F.lower(w)).otherwise(w)), " ")
    return F.when(plain, recase(f)).otherwise(f), F.when(plain, recase(l_)).otherwise(l_)


def split_name(c) -> Column:
    """Full name -> struct(full, first, last). "Last, First" is turned
    round; a suffix (Jr, III) is left out; a leading title joins the first
    name; particles (van der) join the last name; other middle names are
    dropped; case rules as X4."""
    suffix = r"(?i)[\s,]+(" + "|".join(NAME_SUFFIXES) + r")[.]?$"
    text = F.regexp_replace(F.regexp_replace(F.trim(_c(c)), suffix, ""), r"\s+", " ")
    text = F.trim(F.regexp_replace(text, r"^([^,]+),\s*([^,]+)$", "$2 $1"))
    toks = F.split(text, " ")
    titles = F.array(*[F.lit(t) for t in NAME_TITLES])
    has_title = (F.size(toks) > 1) & F.array_contains(titles, F.regexp_replace(F.lower(toks[0]), r"\.$", ""))
    rest = F.when(has_title, F.array_join(F.slice(toks, F.lit(2), F.size(toks)), " ")).otherwise(text)
    particles = "|".join(p.replace(".", "[.]") for p in NAME_PARTICLES)
    first = F.regexp_extract(rest, r"^(\S*)", 1)
    # the shortest middle, so that the last name takes all particles before its main part
    last = F.regexp_extract(rest, rf"(?i)^\S+\s(?:.*?\s)??((?:(?:{particles})\s)*\S+)$", 1)
    first = F.when(has_title, F.concat_ws(" ", toks[0], first)).otherwise(first)
    nf, nl = normalize_name_case(first, last)
    return F.struct(F.trim(F.concat_ws(" ", nf, nl)).alias("full"), nf.alias("first"), nl.alias("last"))


def _state_map() -> Column:
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in STATE_TO_CODE.items()))


def _state_codes() -> Column:
    return F.array(*[F.lit(v) for v in sorted(set(STATE_TO_CODE.values()))])


def city_state(c) -> Column:
    """struct(city, state) from "City, State" text; state by full name,
    two-word name, or code; "west virginia" is checked first. Null pair when
    there are fewer than two words or no state is recognised."""
    _STATE_MAP, _STATE_CODES = _state_map(), _state_codes()
    p = F.split(F.trim(F.regexp_replace(_c(c), ",", " ")), r"\s+")
    n = F.size(p)
    last = F.lower(F.element_at(p, -1))
    prev = F.lower(F.element_at(p, -2))
    two = F.concat_ws(" ", prev, last)

    def city(drop: int) -> Column:
        return F.array_join(F.slice(p, 1, n - drop), " ")
    state = (F.when(n < 2, F.lit(None))
             .when((last == "virginia") & (prev == "west"), F.lit("WV"))
             .when(F.element_at(_STATE_MAP, last).isNotNull(), F.element_at(_STATE_MAP, last))
             .when(F.element_at(_STATE_MAP, two).isNotNull(), F.element_at(_STATE_MAP, two))
             .when(F.array_contains(_STATE_CODES, F.upper(last)), F.upper(last)))
    drop2 = ((last == "virginia") & (prev == "west")) | (
        F.element_at(_STATE_MAP, last).isNull() & F.element_at(_STATE_MAP, two).isNotNull())
    cty = F.when(state.isNotNull(), F.when(drop2, city(2)).otherwise(city(1)))
    return F.struct(cty.alias("city"), state.alias("state"))


def has_value(c) -> Column:
    """Null and NaN are "no value"; '' and 0 are values."""
    x = _c(c)
    return x.isNotNull() & ~F.coalesce(F.isnan(x), F.lit(False))


def postal_text(c) -> Column:
    """Numeric postal code -> zero-filled five-character text."""
    return F.lpad(_c(c).cast("bigint").cast("string"), 5, "0")


def id_text(c, width: int = 1024) -> Column:
    """Id as text, cut to ``width`` characters (varchar(n) semantics)."""
    return F.substring(_c(c).cast("string"), 1, width)
