"""String cleaning. Patterns run with Unicode classes, because offers are French and hold no-break spaces."""

from __future__ import annotations

import re
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from offermart import vocab as V

# Letters and digits of any script plus underscore; combining marks do not count.
WORD = r"\p{L}\p{N}_"
# White space as Unicode has it, which ``\\s`` stands for in a ``unicode`` pattern: the blank, and all other signs.
SPACES = "\t\n\x0b\x0c\r\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def unicode(pattern: str) -> str:
    return "(?U)" + pattern


def any_case(pattern: str) -> str:
    return "(?iU)" + pattern


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` reads it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def whole_words(*bodies: str) -> str:
    """Pattern of any of the bodies, standing as whole words. Look-arounds run faster than ``\\b`` and cut at the same
    places; a body that starts with a sign needs a word character before it, as ``\\b`` would."""
    signed = [b for b in bodies if b.startswith("\\+")]
    plain_bodies = [b for b in bodies if b not in signed]
    parts = [rf"(?<![{WORD}])(?:{'|'.join(plain_bodies)})"] if plain_bodies else []
    parts += [rf"(?<=[{WORD}])(?:{'|'.join(signed)})"] if signed else []
    return unicode(rf"((?:{'|'.join(parts)})(?![{WORD}]))")


def runs(pattern: str) -> list[str]:
    """Runs of plain characters that every match of the pattern holds, longest first; none where no run is sure."""
    if re.search(r"\||\(\?|\)[?*{]", pattern):
        return []
    signs = re.sub(r"\\.|\[[^\]]*\]|\{[^}]*\}", lambda m: "*" if m[0][0] == "{" else "\0", pattern)
    return sorted(dict.fromkeys(re.findall(r"(?:[\w€/:,' -](?![?*]))+", signs)), key=len, reverse=True)


def required(pattern: str) -> str:
    """The longest of the ``runs``; empty when there is none."""
    return next(iter(runs(pattern)), "")


def may_match(text: Column, pattern: str) -> Column:
    """The text holds all ``runs`` of the pattern; a plain search, which spares most texts the pattern itself."""
    return reduce(and_, [text.contains(run) for run in runs(pattern)], F.lit(True))


def holds(lower: Column, body: str) -> Column:
    """The body stands as a whole word in a lower-cased text, as ``whole_words`` finds it; the pattern only runs over texts that hold its letters, and
    looks behind only where the body begins, for plain letters once they are found."""
    edge = "(?<=" if body.startswith("\\+") else "(?<!"
    pattern = rf"(?={body}){edge}[{WORD}])(?:{body})(?![{WORD}])"
    if re.fullmatch(r"\w+", body):
        pattern = rf"{body}(?![{WORD}])(?<![{WORD}]{body})"
    return may_match(lower, body) & lower.rlike(unicode(pattern))


def drop(col: Column, pattern: str) -> Column:
    return F.regexp_replace(col, unicode(pattern), "")


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(" " + SPACES))


def squeeze(col: Column) -> Column:
    """Every run of white space becomes one blank; single blanks are passed over, since they stay as they are."""
    return F.regexp_replace(col, unicode(r" \s+|[\s&&[^ ]]\s*"), " ")


def blank(col: Column) -> Column:
    """True for null and for the empty string."""
    return F.coalesce(col, F.lit("")) == ""


def or_unknown(col: Column) -> Column:
    return F.when(blank(col), F.lit(V.NON_SPECIFIE)).otherwise(col)


def title_case(col: Column) -> Column:
    """Upper-case the first letter of every run of letters, lower-case the rest (``l'oréal`` -> ``L'Oréal``)."""
    runs = F.regexp_extract_all(col, F.lit(unicode(r"(\p{L}+|[^\p{L}]+)")), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def clean_title(col: Column, source: str) -> Column:
    text = F.coalesce(col, F.lit(""))
    if source == V.A:
        return strip(drop(text, V.TITLE_GENDER))
    if source == V.F:
        return title_case(strip(drop(text, V.TITLE_GENDER)))
    for pattern in (V.TITLE_GENDER_SPACED, V.TITLE_CDI, V.TITLE_DASH_GENDER, V.TITLE_AMOUNT):
        text = drop(text, pattern)
    return strip(squeeze(text))


def _first_part(col: Column) -> Column:
    return F.substring_index(col, ",", 1)


def clean_city(col: Column, source: str) -> Column:
    if source == V.W:
        lower = F.lower(col)
        named = strip(_first_part(drop(drop(col, V.BRACKETED_NUMBER), V.POSTCODE)))
        return (
            F.when(blank(col), V.NON_SPECIFIE)
            .when(lower.contains("télétravail"), "Télétravail")
            .when(lower.contains("france") & (F.char_length(col) < 15), "France")
            .otherwise(or_unknown(named))
        )
    named = strip(drop(strip(_first_part(col)), V.POSTCODE))
    if source == V.F:
        return or_unknown(drop(named, V.DEPARTMENT_PREFIX))
    return F.when(col == "France", V.NON_SPECIFIE).otherwise(or_unknown(named))


def clean_company(col: Column) -> Column:
    """Legal form and trailing brackets removed. Only an absent name becomes the sentinel."""
    name = drop(drop(drop(col, V.COMPANY_BRACKETS), V.COMPANY_SAS), V.COMPANY_SA)
    return F.when(blank(col), V.NON_SPECIFIE).otherwise(strip(name))


def search_text(parts: list[Column], skills: Column, pad_without_skills: bool = False) -> Column:
    """Lower-cased text of an offer with everything but words and white space blanked out.

    ``pad_without_skills`` keeps the separator before an empty skill list, as the A source does.
    """
    tail = F.array_join(skills, " ") if pad_without_skills else skills
    joined = F.concat_ws(" ", *[F.coalesce(p, F.lit("")) for p in parts], tail)
    # Plain letters and blanks, most of a text, are passed over first.
    return F.regexp_replace(F.lower(joined), unicode(rf"(?![a-z ])[^{WORD}\s]"), " ")


def snippet(col: Column) -> Column:
    return F.substring(col, 1, 300)


def truncate_description(col: Column) -> Column:
    return F.substring(col, 1, 5000)


def initials(col: Column) -> Column:
    """First letters of the first two words; ``JI`` without a name."""
    words = F.slice(F.split(col, " "), 1, 2)
    letters = F.upper(F.array_join(F.transform(words, lambda w: F.substring(w, 1, 1)), ""))
    return F.when(blank(col), "JI").otherwise(letters)


def slug(col: Column) -> Column:
    return F.regexp_replace(col, rf"[^{WORD}]+", "_")


def location_tail(col: Column) -> Column:
    return F.substring_index(col, " - ", -1)


def strip_tags(col: Column) -> Column:
    return F.regexp_replace(col, r"<[^>]+>", " ")


def fingerprint(titre: Column, entreprise: Column, lieu: Column) -> Column:
    parts = [F.lower(F.coalesce(c, F.lit(""))) for c in (titre, entreprise, lieu)]
    return F.concat_ws("|", *parts)
