"""Salaries: ordered patterns over text, bounds and cascades. All results are whole euros per month unless noted."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from offermart import vocab as V
from offermart.functions.text import any_case, let, may_match, unicode

# Bounds above this are yearly pay.
YEARLY_ABOVE = 10000


def whole(col: Column) -> Column:
    """Integer value of a digit string; null when it is empty, the usual case, which is not left to a failing cast, or too long."""
    return let(col, lambda digits: F.when(digits != "", digits.try_cast("int")))


def _div(col: Column, by: int) -> Column:
    """Integer quotient of a non-negative number, kept in integer arithmetic."""
    return F.floor(col / F.lit(by)).cast("int")


def _per_month(number: Column, unit: str) -> Column:
    if unit == "year":
        return _div(number, 12)
    if unit == "kyear":
        return _div(number * 1000, 12)
    return number * 20 if unit == "day" else number


def first_amount(text: Column, rules: list[tuple[str, str]], flag=unicode) -> Column:
    """Amount of the first rule that matches; a regex is only run when those before it failed and, where case counts, the text holds its letters."""

    def amount(pattern: str, unit: str) -> Column:
        found = _per_month(whole(F.regexp_extract(text, flag(pattern), 1)), unit)
        return F.when(may_match(text, pattern), found) if flag is unicode else found

    found = F.coalesce(*[amount(*rule) for rule in rules])
    # Every rule needs two digits in a row, so text without them skips the cascade.
    return F.when(text.rlike(unicode(r"\d\d")), found)


def salary_from_text(col: Column, source: str) -> Column:
    rules = V.SALARY_TEXT_W if source == V.W else V.SALARY_TEXT_F
    return let(F.lower(col), lambda lower: first_amount(lower, rules))


def salary_from_title(col: Column) -> Column:
    return first_amount(col, V.SALARY_TITLE_W, any_case)


def _bound_per_month(bound: Column) -> Column:
    return F.when(bound > YEARLY_ABOVE, F.floor(bound / 12)).otherwise(F.floor(bound)).cast("int")


def monthly_salary(source: str, description: Column, titre: Column, low: Column, high: Column) -> Column:
    """A reads the bounds only; F the text, then the lower bound; W text, title, then the lower bound."""
    if source == V.A:
        return F.when(low > 0, _bound_per_month(low)).when(high > 0, _bound_per_month(high))
    if source == V.F:
        fallback = F.when((low != 0) & (low != YEARLY_ABOVE), _bound_per_month(low))
        return F.coalesce(salary_from_text(description, source), fallback)
    zero = F.lit(0)
    return F.coalesce(
        F.nullif(salary_from_text(description, source), zero),
        F.nullif(salary_from_title(titre), zero),
        F.when(low > 0, _bound_per_month(low)),
    )


def bounds_from_label(label: Column) -> Column:
    """First two digit runs of a label, spaces removed: ``35000.0 à 40000.0`` reads as (35000, 0)."""
    runs = F.regexp_extract_all(F.replace(label, F.lit(" "), F.lit("")), F.lit(unicode(r"\d+")), F.lit(0))
    return F.struct(
        whole(F.try_element_at(runs, F.lit(1))).alias("salaire_min"),
        whole(F.try_element_at(runs, F.lit(2))).alias("salaire_max"),
    )


def _thousands(text: Column) -> Column:
    number = whole(F.regexp_replace(text, unicode(r"\s"), ""))
    return F.when(number < 500, number * 1000).otherwise(number)


def bounds_from_page(text: Column) -> Column:
    """Bounds printed on a page; small numbers are thousands. The first pattern that matches gives both bounds."""
    found = None
    for pattern, has_upper in V.SALARY_PAGE_W:
        hit = may_match(text, pattern) & text.rlike(unicode(pattern))
        first = _thousands(F.regexp_extract(text, unicode(pattern), 1))
        upper = _upper(F.regexp_extract(text, unicode(pattern), 2)) if has_upper else F.lit(None).cast("int")
        both = F.struct(first.alias("salaire_min"), upper.alias("salaire_max"))
        found = F.when(hit, both) if found is None else found.when(hit, both)
    none = F.lit(None).cast("int")
    return found.otherwise(F.struct(none.alias("salaire_min"), none.alias("salaire_max")))


def _upper(text: Column) -> Column:
    """As the lower bound, but a zero stays a zero."""
    number = whole(F.regexp_replace(text, unicode(r"\s"), ""))
    return F.when((number != 0) & (number < 500), number * 1000).otherwise(number)
