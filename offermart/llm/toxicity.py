"""Toxicity scores: a learned lexicon, Levenshtein automata over its trie, and the context of each hit.

The lexicon holds words that many toxic training documents use and hardly any clean ones. Families of copies are counted
instead of documents, so that copies of one do not make all its words toxic. Beginnings of several words for which the same
holds are stems. A Levenshtein automaton, run on the trie of the lexicon, accepts words a few edits away; words
that clean training documents use are taken out again. Every hit is then read in its window: between quotation marks
or behind a word of reporting it counts as quoted, else as abuse. A logistic model weighs the counts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offermart.llm.common import stored, table
from offermart.llm.models import fit_logistic, fold, labelled, sigmoid
from offermart.llm.registry import query

MIN_FAMILIES, MIN_SHARE = 5, 0.9  # toxic families that use a term or stem; their share of all families that do
STEM_LENGTHS, STEM_WORDS = range(4, 9), 3  # letters of a stem; words of toxic documents that must begin with it
MAX_TERMS = 5_000  # bound of the lexicon: the words with most toxic families
ONE_EDIT_FROM, TWO_EDITS_FROM = 4, 8  # lengths of terms from which so many edits are allowed
REACH, CUE_WORDS = 80, 6  # letters of the window on each side of a hit; words before it that are searched for a cue
REMEMBERED = 300_000  # words whose answer a worker remembers

# Words that report what others say.
CUES = set(
    "said says say wrote writes quote quoted quotes quoting called calls calling term word phrase reported reports"
    " dit écrit cite citation mot terme appelé sagte sagt schrieb zitat zitiert wort begriff nannte"
    " dijo dice escribió cita palabra término llamó".split()
)
_LOOKALIKE = str.maketrans("013457$@", "oieastsa")
_WORD = re.compile(r"[^\W_]+(?:[$@][^\W_]+)*")
_MARKS = {'"': '"', "“": "”", "„": "“”", "«": "»", "‘": "’", "‹": "›"}


class Trie:
    """Terms as a trie, and the Levenshtein automaton (with swaps of neighbours as one edit) run over it.

    A state is ``(node, edits, rest of a swap)``; the set of states after a word's first letters is remembered, and nearly all
    words die within three or four letters.
    """

    def __init__(self, terms: list[str]):
        self.next: list[dict[str, int]] = [{}]
        self.allowed: list[int] = [-1]  # edits allowed at the end of a term, -1 inside one
        for term in sorted(set(terms)):
            node = 0
            for letter in term:
                if letter not in self.next[node]:
                    self.next[node][letter] = len(self.next)
                    self.next.append({})
                    self.allowed.append(-1)
                node = self.next[node][letter]
            self.allowed[node] = (len(term) >= ONE_EDIT_FROM) + (len(term) >= TWO_EDITS_FROM)
        self.most = max(self.allowed)
        # No state may spend more edits than some term below it allows.
        self.budget = list(self.allowed)
        for node in range(len(self.next) - 1, -1, -1):
            self.budget[node] = max([self.allowed[node], *(self.budget[n] for n in self.next[node].values())])
        self.after: dict[str, frozenset] = {"": self._closed({(0, 0, "")})}

    def _closed(self, states: set) -> frozenset:
        """Adds what is reached by leaving letters of a term out."""
        todo = list(states)
        while todo:
            node, edits, swap = todo.pop()
            if swap:
                continue
            for child in self.next[node].values():
                state = (child, edits + 1, "")
                if edits < self.budget[child] and state not in states:
                    states.add(state)
                    todo.append(state)
        return frozenset(states)

    def _step(self, states: frozenset, letter: str) -> frozenset:
        out = set()
        for node, edits, swap in states:
            if swap:
                if letter == swap:
                    out.add((node, edits, ""))
                continue
            for key, child in self.next[node].items():
                if key == letter:
                    out.add((child, edits, ""))
                elif edits < self.budget[child]:
                    out.add((child, edits + 1, ""))
                    follow = self.next[child].get(letter)
                    if follow is not None and edits < self.budget[follow]:
                        out.add((follow, edits + 1, key))
            if edits < self.budget[node]:
                out.add((node, edits + 1, ""))
        return self._closed(out)

    def distance(self, word: str) -> int | None:
        """Edits to the nearest term within its allowance, or None."""
        states = self.after[""]
        for i, letter in enumerate(word):
            known = self.after.get(word[: i + 1]) if i < 4 else None
            if known is None:
                known = self._step(states, letter)
                if i < 4 and len(self.after) < REMEMBERED:
                    self.after[word[: i + 1]] = known
            states = known
            if not states:
                return None
        ends = [edits for node, edits, swap in states if not swap and edits <= self.allowed[node]]
        return min(ends, default=None)


class Lexicon:
    """``kind(word)``: 0 for a term, 1 for a stem, 2 for a misspelled term, None otherwise."""

    def __init__(self, terms: list[str], stems: list[str], clean: set[str] = frozenset()):
        self.terms, self.stems, self.clean = set(terms), tuple(stems), set(clean)
        self.trie = Trie(terms)
        self.known: dict[str, int | None] = {}

    def near(self, word: str) -> bool:
        plain = word.translate(_LOOKALIKE) if not word.isalpha() else word
        return plain in self.terms or self.trie.distance(plain) is not None

    def kind(self, word: str) -> int | None:
        if word in self.known:
            return self.known[word]
        if word in self.terms:
            found = 0
        elif word in self.clean:
            found = None
        elif self.stems and word.startswith(self.stems):
            found = 1
        else:
            found = 2 if self.near(word) else None
        if len(self.known) < REMEMBERED:
            self.known[word] = found
        return found


def quoted(text: str, start: int, end: int) -> bool:
    """Whether the hit stands between quotation marks of its window, or shortly after a word of reporting."""
    before, after = text[max(0, start - REACH) : start], text[end : end + REACH]
    before, after = before.rpartition("\n")[2], after.partition("\n")[0]
    for left, rights in _MARKS.items():
        if left in rights:
            if before.count(left) % 2 == 1 and left in after:
                return True
        elif before.rfind(left) > max(before.rfind(r) for r in rights) and any(r in after for r in rights):
            return True
    return not CUES.isdisjoint(_WORD.findall(before)[-CUE_WORDS:])


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """Abusive terms, stems and misspellings, quoted hits, and hits per hundred words, of a whole text."""
    if not text:
        return [0.0] * 5
    lower = text.lower()
    words = _WORD.findall(lower)
    kinds = {w: k for w in set(words) if (k := lexicon.kind(w)) is not None}
    if not kinds:
        return [0.0] * 5
    counts, in_quotes = [0, 0, 0], 0
    for m in _WORD.finditer(lower):
        k = kinds.get(m[0])
        if k is not None:
            if quoted(lower, m.start(), m.end()):
                in_quotes += 1
            else:
                counts[k] += 1
    return [*np.log1p(counts), float(np.log1p(in_quotes)), float(np.log1p(100 * sum(counts) / len(words)))]


def _grams(words: set[str]) -> set[str]:
    """The words, and their beginnings marked by a dash."""
    return words | {f"{w[:n]}-" for w in words for n in STEM_LENGTHS if len(w) > n}


def _family(words: set[str]) -> int:
    """The smallest word hash of a document: the same for nearly all its copies and near copies."""
    return min(zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words)


def _word_sets(pdf: pd.DataFrame) -> Iterator[set[str]]:
    for text in pdf["text"]:
        words = set(_WORD.findall(text.lower())) if isinstance(text, str) else set()
        if words:
            yield words


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """The lexicon of labelled rows ``(id, text, y)``, which are bounded; the counting is done by Spark."""
    toxic, clean = sample.where("y >= 0.5").select("text"), sample.where("y < 0.5").select("text")

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(g, family) for words in _word_sets(pdf) for family in [_family(words)] for g in _grams(words)]
            yield pd.DataFrame(rows, columns=["gram", "family"])

    seen = toxic.mapInPandas(spread, "gram string, family long").groupBy("gram").agg(F.count_distinct("family").alias("bad"))
    seen = stored(seen, "toxicity-grams")
    words = seen.where("gram NOT LIKE '%-'")
    heads = words.select(F.explode(F.array(*[F.when(F.length("gram") > n, F.substring("gram", 1, n)) for n in STEM_LENGTHS])).alias("head"))
    heads = heads.where("head IS NOT NULL").groupBy(F.concat("head", F.lit("-")).alias("gram")).agg(F.count("*").alias("words"))
    common = seen.where(F.col("bad") >= MIN_FAMILIES).join(heads, "gram", "left")
    common = common.where(F.coalesce("words", F.lit(STEM_WORDS)) >= STEM_WORDS).where("length(gram) >= 3")
    bad = {r["gram"]: r["bad"] for r in common.collect()}
    # So many clean families a gram may have; one more and it is out.
    most = {gram: int(n * (1 - MIN_SHARE) / MIN_SHARE) for gram, n in bad.items()}

    def count_clean(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        families: dict[str, set[int]] = {}
        for pdf in batches:
            for words in _word_sets(pdf):
                family = _family(words)
                for gram in _grams(words) & most.keys():
                    known = families.setdefault(gram, set())
                    if len(known) <= most[gram]:
                        known.add(family)
        yield pd.DataFrame([(g, f) for g, known in families.items() for f in known], columns=["gram", "family"])

    good = clean.mapInPandas(count_clean, "gram string, family long").groupBy("gram").agg(F.count_distinct("family").alias("n"))
    out = {r["gram"] for r in good.collect() if r["n"] > most[r["gram"]]} if most else set()
    chosen = sorted((g for g in bad if g not in out), key=lambda g: (-bad[g], g))
    terms = [g for g in chosen if not g.endswith("-")][:MAX_TERMS]
    stems: list[str] = []
    for gram in sorted((g for g in chosen if g.endswith("-")), key=lambda g: (len(g), g)):
        if not gram[:-1].startswith(tuple(stems)):
            stems.append(gram[:-1])
    first = Lexicon(terms, [])

    def nearby(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: set[str] = set()
        for pdf in batches:
            for words in _word_sets(pdf):
                known.update(w for w in words if w not in first.terms and first.kind(w) is not None)
        yield pd.DataFrame({"word": sorted(known)}, dtype=object)

    # Clean words close to a term: bounded by the sample, and few.
    near = clean.mapInPandas(nearby, "word string").distinct().collect() if terms else []
    return Lexicon(terms, stems, {r["word"] for r in near})


def toxicity(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5,
    carry: bool = False,
) -> DataFrame:
    """``(id, held_out, score, predicted)`` per row: the probability that the label is 1.

    With ``carry`` a last column ``row`` holds all columns of ``docs``, so that filtering by the score needs no join.

    Lexicon and weights come from labelled rows outside the held-out fold. Null and empty texts have no hits. Without
    labels of both kinds every score is the base rate. Rows repeat as they come.
    """
    spark = docs.sparkSession
    held_out = fold(F.col(id_col), 5) == 0
    sample = stored(labelled(docs, labels, label, held_out, id_col, text_col), "toxicity-sample")
    lexicon = spark.sparkContext.broadcast(learn_lexicon(sample))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [features(t if isinstance(t, str) else None, lexicon.value) for t in pdf["text"]]
            yield pd.DataFrame({"x": rows, "y": pdf["y"]})

    measured = sample.mapInPandas(measure, "x array<double>, y double").groupBy("x", "y").count().toPandas()
    x = np.vstack([np.zeros((0, 5)), *measured["x"]])
    times = measured["count"].to_numpy(dtype=int)
    weights = fit_logistic(np.repeat(x, times, axis=0), np.repeat(measured["y"].to_numpy(dtype=float), times))

    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).cast("string").alias("text"),
        *[F.struct(*docs.columns).alias("row")] * carry,
    )
    schema = rows.select("id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), *["row"] * carry).schema

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_py(), lexicon.value) for t in batch.column(2)]).reshape(-1, 5)
            p = sigmoid(x @ weights[:-1] + weights[-1])
            out = [batch.column(0), batch.column(1), pa.array(p), pa.array((p >= threshold).astype(np.int32)), *batch.columns[3:]]
            yield pa.RecordBatch.from_arrays(out, names=["id", "held_out", "score", "predicted", *["row"] * carry])

    return rows.mapInArrow(score, schema)


@query(tested_by="tests/llm/test_learned_operators.py")
def op7_lexicon_automata(spark, sf_dir):
    found = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.withColumnRenamed("id", "doc_id")
