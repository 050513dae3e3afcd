"""License scans by diagonal voting.

Every pair of neighbouring words is hashed; the hashes that templates hold are joined with the pairs of the license templates, and the words behind
equal hashes are compared. A match of text position ``p`` with template position ``q`` votes for the diagonal ``p - q``. All
votes of one diagonal are one undisturbed stretch; the diagonals up to ``GAP`` behind one belong to one copy with words put in or left out
and are merged with it. A merged span is accepted when it begins and ends with the template's ends that it holds, is no longer than the template and ``GAP``
words, and lacks few of its pairs. Of accepted spans that overlap only the one with most of its template counts, so a license is not taken for one
whose notice is part of it.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offermart.llm.common import identity, stored, table
from offermart.llm.postings import LOWER, UPPER, ascii_lower
from offermart.llm.registry import query

# The base phrases and their labels.
BASE = {"cc-by": "cc by", "gpl": "general public license", "reserved": "all rights reserved"}
# Widely used license notices, by label in their usual wordings.
NOTICES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0", "Apache License, Version 2.0", "Apache License v2.0", "Apache License 2.0", "Apache-2.0",
    ],
    "apache-2.0-terms": [
        "Unless required by applicable law or agreed to in writing, software distributed under the License is"
        " distributed on an AS IS basis, without warranties or conditions of any kind"
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met",
        "BSD License", "BSD 2-Clause License", "BSD 3-Clause License",
    ],
    "cc-by-4.0": ["CC BY 4.0", "Creative Commons Attribution 4.0"],
    "cc-by-nc-4.0": ["Licensed under CC BY-NC 4.0", "CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0"],
    "cc-by-nc-nd-4.0": ["CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0"],
    "cc-by-nc-sa-4.0": ["CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0"],
    "cc-by-nd-4.0": ["CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0"],
    "cc-by-sa-4.0": ["Licensed under CC BY-SA 4.0", "CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0"],
    "cc0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights", "CC0 1.0 Universal",
    ],
    "gpl-2.0": ["GNU General Public License, version 2", "GNU General Public License v2", "GNU GPL v2", "GPL version 2"],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3", "GNU General Public License, version 3",
        "GNU General Public License v3", "GNU GPL v3", "GPL version 3",
    ],
    "mit": ["Released under the MIT License", "MIT License", "MIT licensed"],
    "mit-terms": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and"
        " associated documentation files"
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", "Mozilla Public License, v. 2.0",
        "Mozilla Public License Version 2.0", "Mozilla Public License 2.0",
    ],
    "public-domain": ["Released into the public domain", "Dedicated to the public domain"],
}
GAP = 3  # diagonals at most so far apart are one span, which may be so many words longer than its template
COVERAGE = 0.8  # share of the template's word pairs in an accepted span; templates of more than LOOSE pairs may in any case lack one
LOOSE = 3
NEAR = 63 + GAP  # words between the beginnings of spans that overlap, at most
WIDE = 1 << 40


def _terms(text: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c in UPPER else c for c in text))


def template_pairs(base: dict[str, str], notices: dict[str, str | list[str]]) -> list[dict]:
    """One row per neighbouring pair of template words; ``form`` numbers the wordings. They need 2 to 63 words."""
    out = []
    for kind, texts in ((True, base), (False, notices)):
        for label, wordings in texts.items():
            for form, text in enumerate([wordings] if isinstance(wordings, str) else wordings):
                terms = _terms(text)
                if not 2 <= len(terms) <= 63:
                    raise ValueError(f"template {label} needs 2 to 63 words")
                out += [
                    {"label": label, "form": form, "base": kind, "pairs": len(terms) - 1, "off": i, "a": a, "b": b}
                    for i, (a, b) in enumerate(zip(terms, terms[1:]))
                ]
    return out


def _words(text: Column) -> Column:
    """Lower-cased words; a null text has none. Cutting at what stands between them is several times faster than finding them."""
    return F.filter(F.split(ascii_lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda x: x != "")


def _templates(spark: SparkSession, rows: list[dict]) -> DataFrame:
    kind = "array<struct<label string, form int, base boolean, pairs int, off int, a string, b string>>"
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), kind)))


def spans(
    docs: DataFrame, base: dict[str, str] = BASE, notices: dict[str, str | list[str]] = NOTICES, id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """``(rows, spans)``: every row ``(id, r1, r2, n_words)``, and per template and merged span ``(r1, r2, label, base, first,
    last, coverage, accepted)`` in words from 0. For a base phrase each exact place is a span of its own.

    Null and empty texts have no words and no spans; an empty table gives empty results. Equal rows share ``r1, r2``. All words of all texts are
    looked at. Of equally good spans that overlap the one that begins first counts, then the label and wording that come first.
    """
    spark = docs.sparkSession
    rows = template_pairs(base, notices)
    known = _templates(spark, rows).withColumn("h", F.xxhash64("a", "b"))  # a few rows for each template given
    # The hash of every pair of neighbours is looked up among those of the templates before rows are made of what was found.
    hashes = [r[0] for r in known.select("h").distinct().collect()]  # at most 62 for each wording given
    pair_at = lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1)).isin(hashes)
    pairs = F.filter(F.sequence(F.lit(0), F.greatest(F.size("w") - 2, F.lit(0))), lambda i: (i < F.size("w") - 1) & pair_at(i))
    split = docs.select(F.col(id_col).alias("id"), *identity(id_col, text_col), _words(F.col(text_col)).alias("w"))
    grams = split.withColumns({"n_words": F.size("w").cast("long"), "found": pairs})
    # One more row for every row, at place -1, tells the number of its words.
    grams = grams.select("id", "r1", "r2", "n_words", "w", F.explode(F.array_append("found", F.lit(-1))).alias("pos"))
    grams = grams.select("id", "r1", "r2", "n_words", "pos", F.get("w", "pos").alias("wa"), F.get("w", F.col("pos") + 1).alias("wb"))
    same = (F.xxhash64("wa", "wb") == F.col("h")) & (F.col("wa") == F.col("a")) & (F.col("wb") == F.col("b")) & (F.col("pos") >= 0)
    votes = grams.join(F.broadcast(known), same, "left").where("label IS NOT NULL OR pos < 0")
    votes = stored(votes.select("id", "r1", "r2", "n_words", "pos", "label", "form", "base", "pairs", "off"), "license-votes")
    all_rows = votes.where("pos < 0").select("id", "r1", "r2", "n_words")
    place = ["r1", "r2", "label", "form", "base", "pairs"]
    diagonals = votes.where("label IS NOT NULL").groupBy(*place, (F.col("pos") - F.col("off")).cast("long").alias("diagonal")).agg(
        F.expr("bit_or(shiftleft(1L, off))").alias("seen"), F.min("pos").cast("long").alias("first"), F.max("pos").cast("long").alias("last")
    )
    full = F.expr("bit_count(seen) = pairs")
    exact = diagonals.where(F.col("base") & full).withColumn("in_order", F.lit(True))
    # A diagonal with those just behind it; the ends of the template that were seen must be the ends of the span.
    behind = Window.partitionBy("r1", "r2", "label", "form").orderBy("diagonal").rangeBetween(0, GAP)
    ends = [(F.col(c) - F.col("diagonal")) * F.lit(WIDE) + F.col(c) for c in ("first", "last")]
    merged = diagonals.where(~F.col("base")).select(
        *place, "diagonal", F.bit_or("seen").over(behind).alias("seen"), F.min("first").over(behind).alias("first"), F.max("last").over(behind).alias("last"),
        F.min(ends[0]).over(behind).alias("low"), F.max(ends[1]).over(behind).alias("high"),
    )
    in_order = (F.col("low") % WIDE == F.col("first")) & (F.col("high") % WIDE == F.col("last"))
    merged = merged.withColumn("in_order", in_order).drop("low", "high")
    hits = F.expr("CAST(bit_count(seen) AS LONG)")
    out = exact.unionByName(merged).withColumns({"hits": hits, "coverage": hits / F.col("pairs").cast("double")})
    enough = (F.col("coverage") >= COVERAGE) | (F.col("pairs") > LOOSE) & (F.col("hits") == F.col("pairs") - 1)
    fits = F.col("last") - F.col("first") + 1 <= F.col("pairs") + GAP
    out = out.withColumn("good", ~F.col("base") & F.col("in_order") & enough & fits)
    # The spans that can overlap one begin near it: a bounded number of wordings at a bounded number of places.
    rank = F.struct((-F.col("hits")).alias("hits"), (-F.col("coverage")).alias("coverage"), "first", "label", "form", "diagonal", "last")
    near = Window.partitionBy("r1", "r2").orderBy("first").rangeBetween(-NEAR, NEAR)
    good = out.where("good").withColumn("near", F.collect_list(rank).over(near)).withColumn("own", rank)
    better = F.exists("near", lambda t: (t < F.col("own")) & (t["first"] <= F.col("last") + 1) & (t["last"] + 1 >= F.col("first")))
    good = good.withColumn("accepted", ~better).drop("near", "own")
    out = out.where(~F.col("good")).withColumn("accepted", F.col("base")).unionByName(good)
    return all_rows, out.select("r1", "r2", "label", "base", "first", (F.col("last") + 1).alias("last"), "coverage", "accepted")


def licenses(docs: DataFrame, **options) -> DataFrame:
    """Per row ``(id, n_words, n_base, first_word, last_word, base_labels, labels, score)``.

    ``score`` is the largest share of any template found in one span; 0 if nothing was found.
    """
    rows, found = spans(docs, **options)
    is_base = F.col("base")
    named = found.groupBy("r1", "r2").agg(
        F.count_if(is_base).alias("n_base"),
        F.min(F.when(is_base, F.col("first"))).alias("first_word"),
        F.max(F.when(is_base, F.col("first"))).alias("last_word"),
        F.collect_set(F.when(is_base, F.col("label"))).alias("base_labels"),
        F.collect_set(F.when(F.col("accepted"), F.col("label"))).alias("labels"),
        F.max("coverage").alias("score"),
    )
    joined = lambda c: F.coalesce(F.array_join(F.array_sort(c), ","), F.lit("")).alias(c)
    return rows.join(named, ["r1", "r2"], "left").select(
        "id", "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), "first_word", "last_word",
        joined("base_labels"), joined("labels"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )


_VALUES = ", ".join(
    "('{label}', {form}, {base}, {pairs}, {off}, '{a}', '{b}')".format(**r) for r in template_pairs(BASE, NOTICES)
)
_OP6_SQL = rf"""
WITH t(label, form, base, pairs, off, a, b) AS (VALUES {_VALUES}),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT doc_id, i - 1 AS pos, w[i] AS a, w[i + 1] AS b
    FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM d)),
diag AS (SELECT doc_id, label, form, base, pairs, pos - off AS diagonal, bit_or(1::BIGINT << off::INT) AS seen,
        min(pos) AS first, max(pos) AS last FROM g JOIN t USING (a, b) GROUP BY ALL),
merged AS (SELECT doc_id, label, form, base, pairs, diagonal, bit_or(seen) OVER behind AS seen, min(first) OVER behind AS first,
    max(last) OVER behind AS last, min((first - diagonal) * {WIDE} + first) OVER behind AS low, max((last - diagonal) * {WIDE} + last) OVER behind AS high
    FROM diag WHERE NOT base
    WINDOW behind AS (PARTITION BY doc_id, label, form ORDER BY diagonal RANGE BETWEEN CURRENT ROW AND {GAP} FOLLOWING)),
spans AS (SELECT doc_id, label, form, base, pairs, diagonal, seen, first, last, true AS in_order FROM diag WHERE base AND bit_count(seen) = pairs
    UNION ALL SELECT doc_id, label, form, base, pairs, diagonal, seen, first, last, low % {WIDE} = first AND high % {WIDE} = last FROM merged),
scored AS (SELECT *, bit_count(seen)::BIGINT AS hits, bit_count(seen) / pairs::DOUBLE AS coverage FROM spans),
good AS (SELECT * FROM scored WHERE NOT base AND in_order AND last - first + 1 <= pairs + {GAP}
    AND (coverage >= {COVERAGE} OR pairs > {LOOSE} AND hits = pairs - 1)),
accepted AS (SELECT DISTINCT doc_id, label FROM good s WHERE NOT EXISTS (SELECT 1 FROM good t WHERE t.doc_id = s.doc_id
    AND (-t.hits, -t.coverage, t.first, t.label, t.form, t.diagonal, t.last) < (-s.hits, -s.coverage, s.first, s.label, s.form, s.diagonal, s.last)
    AND t.first <= s.last + 1 AND t.last + 1 >= s.first)),
labelled AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS l FROM accepted GROUP BY doc_id),
named AS (SELECT doc_id, count(*) FILTER (base) AS n_base, min(first) FILTER (base) AS first_word,
    max(first) FILTER (base) AS last_word, list_sort(list(DISTINCT label) FILTER (base)) AS bl,
    max(coverage) AS score FROM scored GROUP BY doc_id),
all_labels AS (SELECT doc_id, array_to_string(bl, ',') AS bl, coalesce(l, '') AS l FROM named LEFT JOIN labelled USING (doc_id))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(all_labels.bl, '') AS base_labels,
    coalesce(CASE WHEN coalesce(all_labels.bl, '') = '' THEN l ELSE array_to_string(list_sort(list_distinct(string_split(all_labels.bl || CASE WHEN l = '' THEN '' ELSE ',' END || l, ','))), ',') END, '') AS labels,
    coalesce(score, 0.0) AS score
FROM d LEFT JOIN named USING (doc_id) LEFT JOIN all_labels USING (doc_id)
"""


@query(_OP6_SQL)
def op6_diagonals(spark, sf_dir):
    return licenses(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
