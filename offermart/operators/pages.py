"""Fields of saved offer pages: an ``html`` column in, card and detail columns out, by regular expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offermart import vocab as V
from offermart.functions import labels, salary, text
from offermart.functions.text import any_case, blank, let, squeeze, strip, strip_tags

# Tags in any case, text across lines.
_TAG = "(?is)"
HEADING = r"<h2\b[^>]*>(.*?)</h2>"
MARKED = r"<div\b[^>]*role=[\"']mark[\"'][^>]*>(.*?)</div>"
LINK_LABEL = r"<a\b[^>]*aria-label=[\"]([^\"]*)[\"]"
ANY_HEADING = r"<h[23]\b[^>]*>(.*?)</h[23]>"
PAGE_HEADING = r"<h1\b[^>]*>(.*?)</h1>"
HREF = r"<a\b[^>]*href=[\"']([^\"']*)[\"']"
ALT = r"<img\b[^>]*alt=[\"]([^\"]*)[\"]"
PLACES = [rf"<(\w+)\b[^>]*data-testid=[\"'][^\"']*{p}[^\"']*[\"'][^>]*>(.*?)</\1>" for p in
          ("location", "city", "place", "contract")]
SPAN = r"<span\b[^>]*>(.*?)</span>"
MAIN = r"<main\b[^>]*>(.*)</main>"
# Start tags of the containers of a description, from the most to the least certain.
DESCRIPTIONS = [
    r"<(\w+)\b[^>]*data-testid=[\"']job-description[\"'][^>]*>",
    r"<(div)\b[^>]*class=[\"'](?:[^\"']*\s)?job-description(?:\s[^\"']*)?[\"'][^>]*>",
    r"<(section)\b[^>]*data-testid=[\"'][^\"']*description[^\"']*[\"'][^>]*>",
    r"<(div)\b[^>]*class=[\"'][^\"']*description[^\"']*[\"'][^>]*>",
]
ARTICLE = r"<(article)\b[^>]*>"

ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]


def plain(html: Column) -> Column:
    """Visible text: tags dropped, common entities decoded, white space collapsed."""
    out = strip_tags(html)
    for entity, char in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return strip(squeeze(out))


def _texts(html: Column, *patterns: tuple[str, int]) -> Column:
    """Visible texts of the first element each pattern finds, in order, without the empty ones.

    One lambda cleans them all, which keeps the generated code small however many patterns there are.
    """
    raw = F.array(*[F.regexp_extract(html, _TAG + pattern, group) for pattern, group in patterns])
    return F.filter(F.transform(raw, plain), lambda t: t != "")


def _first_text(html: Column, *patterns: tuple[str, int], use=lambda texts: texts) -> Column:
    """Head of ``use(_texts(...))``; a pattern is only looked for when those before it gave nothing."""
    return F.coalesce(*[_head(use(_texts(html, p))) for p in patterns])


def _head(values: Column) -> Column:
    return F.try_element_at(values, F.lit(1))


def _all(html: Column, pattern: str) -> Column:
    return F.regexp_extract_all(html, F.lit(_TAG + pattern), F.lit(1))


def title(html: Column, page_heading: bool = False) -> Column:
    """Heading, else marked element, else link label without its fixed prefix, else any lower heading.

    ``page_heading`` also accepts the main heading of a whole page, after the card rules.
    """
    label = F.regexp_replace(plain(F.regexp_extract(html, _TAG + LINK_LABEL, 1)), any_case(V.LINK_LABEL_PREFIX), "")
    rest = [(ANY_HEADING, 1)] + ([(PAGE_HEADING, 1)] if page_heading else [])
    return F.coalesce(
        _first_text(html, (HEADING, 1), (MARKED, 1)), F.nullif(strip(label), F.lit("")), _first_text(html, *rest)
    )


def offer_url(html: Column, base: str = V.BASE_URL_W) -> Column:
    """First link to a job, else first link; relative links get the base address; empty without links."""
    href = let(_all(html, HREF), lambda links: F.coalesce(_head(F.filter(links, lambda h: h.contains("/jobs/"))), _head(links)))
    full = let(href, lambda h: F.when(h.startswith("http"), h).otherwise(F.concat(F.lit(base), h)))
    return F.coalesce(full, F.lit(""))


def offer_id(url: Column, titre: Column, keyword: Column) -> Column:
    """``company__slug`` of a job address, else its last part, else title and keyword, as words joined by ``_``."""
    pattern = r"/companies/([^/]+)/jobs/([^?#]+)"
    named = F.concat_ws("__", F.regexp_extract(url, pattern, 1), F.regexp_extract(url, pattern, 2))
    from_url = F.when(url.rlike(pattern), named).otherwise(text.slug(F.substring_index(url, "/", -1)))
    fallback = F.lower(text.slug(F.concat_ws("_", titre, keyword)))
    return F.coalesce(F.nullif(from_url, F.lit("")), fallback)


def company(html: Column) -> Column:
    """First image label that names something: not empty, not ``cover``, under 80 characters."""

    def name(labels: Column) -> Column:
        good = F.filter(labels, lambda a: (a != "") & (F.lower(a) != "cover") & (F.char_length(a) < 80))
        first = _head(labels)
        return F.coalesce(_head(good), F.when(first != "", first))

    return F.coalesce(let(F.transform(_all(html, ALT), plain), name), F.lit(V.NON_SPECIFIE))


def place(html: Column, titre: Column, entreprise: Column) -> Column:
    """First labelled element, else the first short span that looks like a place, else ``France``."""

    def other(text: Column) -> Column:
        return (text != titre) & (text != entreprise)

    # An element of one of the patterns has the attribute they all ask for.
    marked = F.when(F.lower(html).contains("data-testid"), _first_text(html, *[(p, 2) for p in PLACES], use=lambda texts: F.filter(texts, other)))
    labelled = F.nullif(marked, F.lit("France"))
    spans = F.filter(
        F.transform(_all(html, SPAN), plain),
        lambda s: (F.char_length(s) > 2) & (F.char_length(s) < 35) & ~s.contains("€") & other(s) & ~s.rlike(r"(?U)^\d"),
    )
    return F.coalesce(labelled, _head(spans), F.lit("France"))


def _container(html: Column, start: str) -> Column:
    """Inner html of the first element with this start tag, up to the end tag on its own level."""
    tag = F.regexp_extract(html, _TAG + start, 1)
    # One character in front keeps the first piece from being taken for a tag; every other piece begins with one.
    rest = F.concat(F.lit("-"), F.regexp_extract(html, _TAG + start + "(.*)", 2))
    pieces = F.split(rest, F.concat(F.lit("(?i)(?=</?"), tag, F.lit("\\b)")))

    def step(state: Column, piece: Column) -> Column:
        change = F.when(piece.startswith("</"), F.lit(-1)).when(piece.startswith("<"), F.lit(1)).otherwise(F.lit(0))
        depth = F.when(state["depth"] > 0, state["depth"] + change).otherwise(F.lit(0))
        return F.struct(depth.alias("depth"), (state["n"] + (depth > 0).cast("int")).alias("n"))

    def inner(pieces: Column) -> Column:
        inside = F.aggregate(pieces, F.struct(F.lit(1).alias("depth"), F.lit(0).alias("n")), step)["n"]
        return F.substring(F.array_join(F.slice(pieces, F.lit(1), inside), ""), 2, 2**31 - 1)

    return F.when(tag != "", let(pieces, inner))


def description(html: Column, any_article: bool = False, main: Column | None = None, shown: Column | None = None) -> Column:
    """Text of the first description container that holds any, else the start of the main text, else empty.

    An article counts inside the main part; ``any_article`` takes one anywhere. ``main`` and ``shown`` are the main part and its text where they
    are columns already. A container is only looked for when those before it hold nothing.
    """
    main = F.regexp_extract(html, _TAG + MAIN, 1) if main is None else main

    def text_of(container: Column) -> Column:
        return _head(F.filter(F.transform(F.array(container), plain), lambda t: t != ""))

    # The start tags of all containers but the article hold this word.
    named = F.when(F.lower(html).contains("description"), F.coalesce(*[text_of(_container(html, p)) for p in DESCRIPTIONS]))
    article = text_of(_container(html if any_article else main, ARTICLE))
    return F.coalesce(named, article, F.substring(plain(main) if shown is None else shown, 1, 3000))


def cards(pages: DataFrame, keyword: str | Column = "", page_heading: bool = False) -> DataFrame:
    """Card fields of every page that has a title."""
    word = F.lit(keyword) if isinstance(keyword, str) else keyword
    html = F.col("html")
    # Generated, not filtered: a filter on the title would be pushed down and the title be computed twice.
    titled = F.filter(F.array(title(html, page_heading)), lambda t: ~blank(t))
    named = pages.select("*", F.explode(titled).alias("_titre"))
    named = named.withColumns({"_url": offer_url(html), "_keyword": word, "_entreprise": company(html)})
    return named.withColumns(
        {
            "_lieu": place(html, F.col("_titre"), F.col("_entreprise")),
            "_id": offer_id(F.col("_url"), F.col("_titre"), F.col("_keyword")),
            "_contrat": let(strip_tags(html), labels.contract_from_card),
        }
    )


def details(pages: DataFrame, any_article: bool = False) -> DataFrame:
    """Description and salary bounds of a detail page; bounds are read from its main part."""
    html, main, shown, bounds = F.col("html"), F.col("_main"), F.col("_shown"), F.col("_bounds")
    # Columns of their own, so each is computed once however many expressions read it.
    cut = pages.withColumn("_main", F.regexp_extract(html, _TAG + MAIN, 1)).withColumn("_shown", plain(main))
    read = cut.withColumns({"description": description(html, any_article, main, shown), "_bounds": salary.bounds_from_page(shown)})
    return read.withColumns({c: bounds[c] for c in ("salaire_min", "salaire_max")}).drop("_main", "_shown", "_bounds")
