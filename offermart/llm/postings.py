"""Benchmark decontamination with a stored positional inverted index.

The postings ``(document, position, term)`` of every training word that occurs in the benchmark are stored once. Each
benchmark window is looked up from its rarest term: the positions of that term, less its offset in the window, are the places where
the window could start. They are intersected with the postings of the second rarest term, less its offset, and
what is left with all others. All terms at their offsets make a phrase; with ``slop`` a term may also stand that many
words off, which makes a proximity match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offermart.llm.common import identity, stored, table
from offermart.llm.registry import query

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
END = "\x00"  # no word can be this: its one posting per row holds the number of words
SMALL_ROWS = 500_000  # a narrow table of at most so many rows is broadcast; a larger one is shuffled


def ascii_lower(text: Column) -> Column:
    """Only A-Z change. ``lower`` does the same, and faster, for text without other letters."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= SMALL_ROWS else df


def windows(benchmark: DataFrame, length: int, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(win, item, terms)``: every run of ``length`` words of an item, or all its words if it has fewer."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), words(F.col(text_col)).alias("w"))
    items = items.where(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - length, F.lit(0)))
    runs = items.select("item", F.explode(F.transform(starts, lambda i: F.slice("w", i + 1, length))).alias("terms"))
    return runs.select(F.xxhash64("terms").alias("win"), "item", "terms").distinct()


def index(docs: DataFrame, vocabulary: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Stored postings ``(id, r1, r2, pos, term)`` of the words in the vocabulary, and one of ``END`` per row.

    ``r1, r2`` identify a row by its id and text: equal rows share their postings' keys and have equal results.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), *identity(id_col, text_col),
        F.posexplode(F.array_append(words(F.col(text_col)), F.lit(END))).alias("pos", "word"),
    )
    return stored(rows.join(_small(vocabulary), "word").drop("word"), "postings")


def matches(
    docs: DataFrame, benchmark: DataFrame, length: int = 10, slop: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(rows, hits, runs)``: all rows ``(id, r1, r2, n_words)``; ``(r1, r2, start, win, len, kind)`` with kind
    ``phrase`` or ``proximity``; and the windows ``(win, item, terms)``.

    A null text has no words. Empty tables give empty results. Nothing is capped: a passage in a third of the rows
    gives one hit per row and window.
    """
    if not 1 <= length <= 60 or slop < 0:
        raise ValueError("length must be 1 to 60, slop not negative")
    runs = stored(windows(benchmark, length), "windows")
    spelled = runs.select("win", "terms").distinct()
    spelled = spelled.select("win", F.size("terms").alias("len"), F.posexplode("terms").alias("off", "word"))
    vocabulary = spelled.select("word").unionByName(docs.sparkSession.sql(f"SELECT '{END}' AS word")).distinct()
    vocabulary = stored(vocabulary.select("word", F.xxhash64("word").alias("term")), "vocabulary")
    postings = index(docs, vocabulary, id_col, text_col)
    end = F.col("term") == F.xxhash64(F.lit(END))
    rows = postings.where(end).select("id", "r1", "r2", F.col("pos").cast("long").alias("n_words"))
    postings = postings.where(~end).select("r1", "r2", "pos", "term")

    frequency = postings.groupBy("term").agg(F.count("*").alias("freq"))
    rarest = Window.partitionBy("win").orderBy("freq", "off")
    sought = spelled.join(vocabulary, "word").join(frequency, "term")
    sought = sought.withColumn("rank", F.row_number().over(rarest))
    sought = sought.withColumn("known", F.max("rank").over(Window.partitionBy("win"))).where("known = len")
    sought = stored(sought.select("win", "len", "off", "term", "rank"), "window-terms")

    shifts = F.explode(F.sequence(F.lit(-slop), F.lit(slop))).alias("shift")
    place = ["r1", "r2", "start", "win", "len"]
    first = _small(sought.where("rank = 1").select("term", "win", "len", "off"))
    starts = postings.join(first, "term").select("r1", "r2", (F.col("pos") - F.col("off")).alias("start"), "win", "len")
    starts = starts.where("start >= 0")

    def intersect(starts: DataFrame, ranks: Column, among: DataFrame) -> DataFrame:
        """Offset-adjusted intersection: the bits of the ranks found, anywhere within the slop and exactly."""
        terms = sought.where(ranks).select("win", "term", "off", "rank")
        wanted = starts.join(_small(terms), "win").select(*place, "term", "off", "rank", shifts)
        wanted = wanted.withColumn("pos", F.col("start") + F.col("off") + F.col("shift"))
        bit = F.expr("shiftleft(1L, rank - 1)")
        return wanted.join(among, ["r1", "r2", "pos", "term"]).groupBy(*place).agg(
            F.bit_or(bit).alias("near"), F.bit_or(F.when(F.col("shift") == 0, bit).otherwise(F.lit(0))).alias("exact")
        )

    second = postings.join(_small(sought.where("rank = 2").select("term").distinct()), "term", "left_semi")
    pairs = intersect(starts.where("len > 1"), F.col("rank") == 2, second)
    pairs = stored(pairs, "rarest-pairs")
    holders = _small(pairs.where("len > 2").select("r1", "r2").distinct())
    rest = postings.join(holders, ["r1", "r2"], "left_semi")
    others = intersect(pairs.where("len > 2").select(*place), F.col("rank") > 2, rest)
    one = F.lit(1).cast("long")
    found = starts.where("len = 1").distinct().select(*place, one.alias("near"), one.alias("exact"))
    found = found.unionByName(pairs.withColumns({c: F.col(c).bitwiseOR(one) for c in ("near", "exact")}))
    found = found.unionByName(others)
    masks = found.groupBy(*place).agg(F.bit_or("near").alias("near"), F.bit_or("exact").alias("exact"))
    full = F.expr("shiftleft(1L, len) - 1")
    kind = F.when(F.col("exact") == full, "phrase").otherwise("proximity")
    return rows, masks.where(F.col("near") == full).select(*place, kind.alias("kind")), runs


def contamination(docs: DataFrame, benchmark: DataFrame, length: int = 10, **columns: str) -> DataFrame:
    """``(id, r1, r2, n_words, n_hit, n_items, items, contaminated)`` per row: the words inside any occurrence of a window.

    ``items`` are the ids of the items with an occurring window, as sorted strings; empty if there is none.
    """
    rows, hits, runs = matches(docs, benchmark, length, **columns)
    hits = stored(hits.where("kind = 'phrase'"), "phrase-hits")
    covered = hits.select("r1", "r2", F.explode(F.expr("sequence(start, start + len - 1)")).alias("pos")).distinct()
    covered = covered.groupBy("r1", "r2").agg(F.count("*").alias("n_hit"))
    items = hits.select("r1", "r2", "win").distinct().join(_small(runs.select("win", "item")), "win")
    items = items.groupBy("r1", "r2").agg(F.array_sort(F.collect_set("item")).alias("items"))
    out = rows.join(covered.join(items, ["r1", "r2"]), ["r1", "r2"], "left")
    return out.select(
        "id", "r1", "r2", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, length: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without any occurrence of a benchmark window."""
    found = contamination(docs, benchmark, length, id_col=id_col, text_col=text_col).where("contaminated")
    r1, r2 = identity(id_col, text_col)
    known = found.select(F.col("r1").alias("_r1"), F.col("r2").alias("_r2")).distinct()
    return docs.withColumns({"_r1": r1, "_r2": r2}).join(known, ["_r1", "_r2"], "left_anti").select(*docs.columns)


_OP8_SQL = rf"""
WITH w AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
wins AS (SELECT DISTINCT item_id, least(len(w), 10) AS n,
        array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS gram
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM w WHERE len(w) > 0)),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
grams AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS gram
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM wins) WHERE len(w) >= n)),
hits AS (SELECT DISTINCT doc_id, item_id, i, g.n FROM grams g JOIN wins USING (n, gram)),
agg AS (SELECT doc_id, list(DISTINCT CAST(item_id AS VARCHAR)) AS items FROM hits GROUP BY doc_id),
cover AS (SELECT doc_id, count(*) AS n_hit FROM
    (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
    CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
    sha256(array_to_string(list_sort(coalesce(items, [])), ',')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN agg USING (doc_id) LEFT JOIN cover USING (doc_id)
"""


@query(_OP8_SQL)
def op8_postings(spark, sf_dir):
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )
