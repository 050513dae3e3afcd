"""Repair of the structure of conversations: alternating user and assistant turns after at most one system turn.

A conversation is an initial and a fault per turn. It is aligned with the alternating grammar string of every feasible
length (Wagner-Fischer). All lengths share their suffixes, so one table of suffix costs serves them all; and an incumbent, the cost of
a simple repair, bounds how far the number of turns left and the length left can drift apart (Ukkonen's band). Each cheapest
target is traced back to the least audit of its edits, and the audits of all of them are compared. Conversations of more than
``TABLE_ROWS`` turns keep two numbers per turn instead of the table, the least cost by the parity of the length left, from which
the same audit is walked out letter by letter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offermart.llm.common import stored, table
from offermart.llm.registry import query

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
TABLE_ROWS = 1024
ROWS_OUT = 4096  # rows of one output batch
FAR = 1 << 40  # cost of what cannot be reached
BLANK, DUPLICATE, CUT, FINE = "b", "d", "t", "f"
NOT_SPACE = r"[^\x20\x09-\x0D]"


class Turns:
    """Initials (u, a, s or anything else) and faults of a conversation as numbers.

    ``parity``: 0 for a user turn, 1 for an assistant's, -1 for others; ``extra``: what it costs to let a turn stay; ``gone``: it must go.
    """

    def __init__(self, initials: str, faults: str):
        self.n = len(initials)
        self.initials = initials
        self.gone = [f in (BLANK, DUPLICATE) for f in faults]
        self.extra = [TRUNCATED if f == CUT else 0 for f in faults]
        self.parity = [{"u": 0, "a": 1}.get(c, -1) for c in initials]
        self.forced = DELETE * sum(self.gone)

    def stay(self, i: int, parity: int) -> int:
        """Cost of turn ``i`` in the place of a user (0) or an assistant (1)."""
        return FAR if self.gone[i] else self.extra[i] + (KEEP if self.parity[i] == parity else REROLE)

    def incumbent(self) -> int:
        """Cost of a simple repair: every turn that may stay takes the next place; a last assistant turn is added if it is missing."""
        cost, places, system = self.forced, 0, False
        for i in range(self.n):
            if self.gone[i]:
                continue
            if places == 0 and not system and self.initials[i] == "s":
                system, cost = True, cost + self.extra[i]
                continue
            cost, places = cost + self.stay(i, places % 2), places + 1
        cost += INSERT * (2 if system and not places else places % 2)
        return min(cost, DELETE * self.n)

    def spare(self, start: int, end: int) -> int:
        """What a simple repair of the turns from ``start`` to ``end`` costs at most beyond the forced deletions, from and to either parity."""
        costs, places = [0, 0], 0
        for i in range(start, end):
            if not self.gone[i]:
                costs = [c + self.stay(i, (places + p) % 2) for p, c in enumerate(costs)]
                places += 1
        return max(costs) + INSERT


class Band:
    """Rows of suffix costs: the turns from ``i`` on against the last ``r`` places of the grammar string.

    Only ``r`` within the band around the turns left that may stay are held: ``below`` fewer, each costs a deletion, and ``above`` more,
    each costs an insertion; beyond, the cost exceeds the incumbent.
    """

    def __init__(self, turns: Turns, spare: int, even: int = 0, odd: int = FAR):
        """``spare``: the incumbent's cost beyond that of the end. The end costs ``even`` with no place left and ``odd`` with one."""
        self.turns, self.below, above = turns, spare // DELETE + 1, spare // INSERT + 1
        self.k = np.arange(self.below + above + 1)
        self.slope = INSERT * self.k
        self.left = 0  # turns that may stay, from the present row to the end
        self.row = np.full(len(self.k), FAR)
        self.row[self.below], self.row[self.below + 1] = even, odd
        self._insert()

    def lengths(self) -> np.ndarray:
        return self.k + self.left - self.below

    def _insert(self) -> None:
        self.row = np.minimum(np.minimum.accumulate(self.row - self.slope) + self.slope, FAR)
        self.row[self.lengths() < 0] = FAR

    def step(self, i: int) -> np.ndarray:
        """The row of turn ``i``, from that of turn ``i + 1``."""
        if self.turns.gone[i]:
            self.row = self.row + DELETE
        else:
            self.left += 1
            costs = np.array([self.turns.stay(i, 0), self.turns.stay(i, 1)])
            new = self.row + costs[self.lengths() % 2]  # an even number of places left begins with a user's
            new[:-1] = np.minimum(new[:-1], self.row[1:] + DELETE)
            self.row = new
        self._insert()
        return self.row


def _audit_by_targets(turns: Turns) -> tuple[int, str]:
    """Cost and least audit over the grammar strings of all feasible lengths, from one table."""
    n, band = turns.n, Band(turns, turns.incumbent() - turns.forced)
    rows, lefts = [band.row], [band.left]
    for i in range(n - 1, -1, -1):
        rows.append(band.step(i))
        lefts.append(band.left)
    rows, lefts = rows[::-1], lefts[::-1]

    def cost(i: int, r: int) -> int:
        k = r - lefts[i] + band.below
        return int(rows[i][k]) if r >= 0 and 0 <= k < len(band.k) else FAR

    def ends(i: int, least: int) -> Iterator[int]:
        lengths = band.k + lefts[i] - band.below
        yield from lengths[(lengths >= least) & (lengths % 2 == 0) & (rows[i] < FAR)].tolist()

    targets = [(cost(0, r), 0, r, "") for r in ends(0, 0)]  # without a system turn
    for i in range(n):  # what stands before the system turn goes
        if turns.initials[i] == "s" and not turns.gone[i]:
            targets += [(DELETE * i + turns.extra[i] + cost(i + 1, r), i + 1, r, "D" * i + "K") for r in ends(i + 1, 2)]
    best = min(t[0] for t in targets)

    def trace(i: int, r: int) -> str:
        out = []
        while i < n or r > 0:
            here = cost(i, r)
            if i < n and cost(i + 1, r) + DELETE == here:
                out.append("D")
                i += 1
            elif cost(i, r - 1) + INSERT == here:
                out.append("I")
                r -= 1
            else:
                out.append("K" if turns.parity[i] == r % 2 else "R")
                i, r = i + 1, r - 1
        return "".join(out)

    return best, min(start + trace(i, r) for total, i, r, start in targets if total == best)


def _audit_by_parity(turns: Turns, chunk: int = TABLE_ROWS) -> tuple[int, str]:
    """The same for conversations of any length: a band for every ``chunk`` turns, whose ends cost what follows; two numbers per turn remain."""
    n = turns.n
    least = np.full((n + 1, 2), FAR)
    least[n] = 0, INSERT
    for end in range(n, 0, -chunk):
        start = max(0, end - chunk)
        even, odd = least[end].tolist()
        band = Band(turns, turns.spare(start, end) + abs(even - odd), even, odd)
        for i in range(end - 1, start - 1, -1):
            band.step(i)
            odd_ones = band.lengths() % 2 == 1
            least[i] = band.row[~odd_ones].min(initial=FAR), band.row[odd_ones].min(initial=FAR)
    even, odd = least.T.tolist()
    # Places left even: a user's turn is next; odd: an assistant's. After a system turn at least one place must follow.
    begun = [0] * (n + 1)
    begun[n] = 2 * INSERT
    first = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        begun[i] = min(begun[i + 1] + DELETE, odd[i] + INSERT, odd[i + 1] + turns.stay(i, 0))
        system = begun[i + 1] + turns.extra[i] if turns.initials[i] == "s" and not turns.gone[i] else FAR
        first[i] = min(first[i + 1] + DELETE, odd[i] + INSERT, odd[i + 1] + turns.stay(i, 0), system)
    costs = {"first": first, "begun": begun, "even": even, "odd": odd}
    i, state, out = 0, "first", []
    while True:
        here = costs[state][i]
        if i == n and here == 0 and state in ("first", "even"):
            return first[0], "".join(out)
        parity, after = (1, "even") if state == "odd" else (0, "odd")
        if i < n and costs[state][i + 1] + DELETE == here:
            out.append("D")
            i += 1
        elif costs[after][i] + INSERT == here:
            out.append("I")
            state = after
        elif state == "first" and turns.initials[i] == "s" and not turns.gone[i] and begun[i + 1] + turns.extra[i] == here:
            out.append("K")
            i, state = i + 1, "begun"
        else:
            out.append("K" if turns.parity[i] == parity else "R")
            i, state = i + 1, after


@lru_cache(maxsize=50_000)
def _short_audit(initials: str, faults: str) -> tuple[int, str]:
    return _audit_by_targets(Turns(initials, faults))


def audit(initials: str, faults: str) -> tuple[int, str]:
    """Cost and letters (D, I, K, R) of the cheapest edits that give ``(s?(ua)+)?``; of equals the least in ASCII."""
    if len(initials) <= 64:
        return _short_audit(initials, faults)
    return _audit_by_targets(Turns(initials, faults)) if len(initials) <= TABLE_ROWS else _audit_by_parity(Turns(initials, faults))


def damage(rows: DataFrame) -> DataFrame:
    """``(conv, turn, role, text, copy)`` of turns damaged by the crc32 of ``conv:turn``; a dropped turn stays as a row with copy null.

    Of 20 remainders 0 drops a turn, 1 empties its text, 2 takes the ends of its sentences, 3 repeats it, 4 makes it a user's. Null is one space.
    """
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", word("conv"), word("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(word("text"), "[.!?]", "")).otherwise(word("text"))
    role = F.when(kind == 4, "user").otherwise(word("role"))
    copies = F.when(kind == 0, F.array(F.lit(None).cast("int"))).when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy"))


def ordered(rows: DataFrame) -> DataFrame:
    """``rows (conv, turn, role, text, copy)`` with ``at``, numbers that rise with the turn (nulls first), role and text of a conversation.

    Dealt out by ranges of that order and stored, so a conversation with a third of all rows spreads over many tasks.
    """
    numbered = ["conv", F.col("turn").asc_nulls_first()]
    begins = [F.substring(c, 1, 32) for c in ("role", "text")]  # the keys that are sampled for the ranges stay short
    dealt = rows.repartitionByRange(*numbered, *begins)
    placed = dealt.sortWithinPartitions(*numbered, "role", "text", "copy").withColumn("at", F.monotonically_increasing_id())
    # The text's own hashes tell rows apart from here on; whole texts are read again only for the repaired conversation.
    hashes = [F.xxhash64("role", "text").alias("h1"), F.xxhash64("text", "role").alias("h2")]
    shown = F.regexp_extract("text", rf"({NOT_SPACE})[\x20\x09-\x0D]*$", 1)
    blank = ~F.col("text").rlike(NOT_SPACE)
    fault = F.when(blank, BLANK).when(~shown.isin(".", "!", "?"), CUT).otherwise(FINE)
    initial = F.substring("role", 1, 1)
    return stored(placed.select("*", *hashes, fault.alias("fault"), initial.alias("initial")), "turns-ordered")


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


AUDITS = (
    "conv {id}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
)


def audits(placed: DataFrame) -> DataFrame:
    """One row per conversation of ``ordered`` rows: gaps, faults, illegal neighbours, and the cost and audit of its repair.

    A task reads a conversation's turns as narrow rows in order and holds two letters per turn, as many as the audit it returns.
    """
    real = placed.where("copy IS NOT NULL").select("conv", "at", "h1", "h2")
    firsts = real.groupBy("conv", "h1", "h2").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("new"))
    narrow = placed.select("conv", "at", "turn", "initial", "fault", F.col("copy").isNotNull().alias("real")).join(firsts, "at", "left")
    again = (F.col("fault") != BLANK) & F.col("new").isNull()
    narrow = narrow.select("conv", "at", F.col("turn").cast("long").alias("turn"), "initial", F.when(again, DUPLICATE).otherwise(F.col("fault")).alias("fault"), "real")
    sorted_ = narrow.repartition("conv").sortWithinPartitions("conv", "at")
    id_type = placed.schema["conv"].dataType.simpleString()

    def summary(conv, numbers: list, initials: list, faults: list) -> tuple:
        low, high, distinct = numbers
        gaps = high - low + 1 - distinct if distinct else 0
        counts = [faults.count(f) for f in (BLANK, DUPLICATE, CUT)]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, letters = audit("".join(c if c in ("s", "u", "a") else "o" for c in initials), "".join(faults))
        return (conv, gaps, *counts, illegal, cost, letters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = None
        held, numbers, initials, faults, out = None, [], [], [], []

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            kinds = [batch.column(0).type, *[pa.int64()] * 6, pa.string()]
            for conv, _, turn, initial, fault, exists in zip(*(c.to_pylist() for c in batch.columns)):
                if held is None or held[0] != conv:
                    if held is not None:
                        out.append(summary(held[0], numbers, initials, faults))
                    held, numbers, initials, faults = (conv,), [None, None, 0], [], []  # smallest and largest number, distinct ones
                if exists:
                    if turn is not None and turn != numbers[1]:
                        numbers = [turn if numbers[0] is None else numbers[0], turn, numbers[2] + 1]
                    initials.append(initial)
                    faults.append(fault)
            if out:
                yield batch_of(out)
                out = []
        if held is not None:
            yield batch_of([summary(held[0], numbers, initials, faults)])

    return sorted_.mapInArrow(run, AUDITS.format(id=id_type))


def repaired(placed: DataFrame, audited: DataFrame) -> DataFrame:
    """``(conv, place, role, text)`` of the repaired conversations, inserted turns with empty text.

    The audit comes first in a conversation's rows and the turns follow in their order, so a task holds one audit and one turn at a time.
    """
    said = placed.where("copy IS NOT NULL").select("conv", "at", "role", "text")
    plans = audited.select("conv", F.lit(-1).cast("long").alias("at"), F.lit("").alias("role"), F.col("audit").alias("text"))
    rows = plans.unionByName(said).repartition("conv").sortWithinPartitions("conv", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for piece in _edited(batches):
            held.append(piece)
            if len(held) == ROWS_OUT:
                yield _batch(held, ["conv", "place", "role", "text"])
                held = []
        if held:
            yield _batch(held, ["conv", "place", "role", "text"])

    return rows.mapInArrow(run, f"conv {placed.schema['conv'].dataType.simpleString()}, place long, role string, text string")


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    """Rows that end with the type of their first column."""
    *columns, kinds = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[0] if i == 0 else None) for i, c in enumerate(columns)], names=names)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Applies each conversation's audit to the turns that follow it: ``(conv, place, role, text, type of conv)``; inserted places have empty text."""
    letters, at, place, shift, conv, kind = "", 0, 0, 0, None, None
    roles = "user", "assistant"

    def inserted() -> Iterator[tuple]:
        nonlocal at, place
        while at < len(letters) and letters[at] == "I":
            yield conv, place, roles[(place + shift) % 2], "", kind
            at, place = at + 1, place + 1

    for batch in batches:
        kind = batch.column(0).type
        for now, number, role, text in zip(*(c.to_pylist() for c in batch.columns)):
            if number < 0:
                yield from inserted()  # what the conversation before still lacks
                letters, at, place, conv = text, 0, 0, now
                shift = (len(letters) - letters.count("D")) % 2  # an odd number of turns begins with a system turn
                continue
            yield from inserted()
            edit, at = letters[at], at + 1
            if edit != "D":
                yield conv, place, role if edit == "K" else roles[(place + shift) % 2], text, kind
                place += 1
    yield from inserted()


def repair_hashes(placed: DataFrame, audited: DataFrame) -> DataFrame:
    """``audited`` with ``repaired_sha256``: of the repaired turns as ``role:text``, joined by newlines; of nothing, the hash of an empty text."""
    said = placed.where("copy IS NOT NULL").select("conv", "at", "role", "text")
    plans = audited.select("conv", F.lit(-1).cast("long").alias("at"), F.lit("").alias("role"), F.col("audit").alias("text"))
    rows = plans.unionByName(said).repartition("conv").sortWithinPartitions("conv", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, held, done = None, None, []
        for conv, place, role, text, kind in _edited(batches):
            if place == 0:
                if held is not None:
                    done.append((held[0], digest.hexdigest(), held[1]))
                digest, held = hashlib.sha256(), (conv, kind)
            piece = f"{role}:{text}".encode("utf-8", "surrogatepass")
            digest.update(piece if place == 0 else b"\n" + piece)
            if len(done) == ROWS_OUT:
                yield _batch(done, ["_conv", "sha"])
                done = []
        if held is not None:
            done.append((held[0], digest.hexdigest(), held[1]))
        if done:
            yield _batch(done, ["_conv", "sha"])

    hashed = rows.mapInArrow(run, f"_conv {placed.schema['conv'].dataType.simpleString()}, sha string")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    joined = audited.join(hashed, _same(F.col("conv"), F.col("_conv")), "left")
    return joined.withColumn("repaired_sha256", F.coalesce("sha", nothing)).drop("_conv", "sha")


def structure(
    turns: DataFrame, damaged: bool = False, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """The ordered turns (see ``ordered``) and one audit per conversation; ``repaired`` and ``repair_hashes`` make the rest of them.

    A conversation is the rows of one id, those without id being one too. Turns follow in the order of their number, nulls first, then role
    and text. Null roles and texts are one space. Blank turns and repetitions of a role with its text go; a text whose last shown character ends no
    sentence may stay at a cost. Extra columns are ignored; an empty table gives empty results. ``damaged`` applies ``damage`` first.
    """
    rows = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text")
    )
    if damaged:
        rows = damage(rows)
    else:
        word = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
        rows = rows.select("conv", "turn", word("role"), word("text"), F.lit(0).alias("copy"))
    placed = ordered(rows)
    return placed, stored(audits(placed), "turns-audits")


def _oracle() -> str:
    # CRC-32 bit by bit is no SQL function; a table of 256 remainders folds it over the bytes of the key.
    table_ = []
    for b in range(256):
        c = b
        for _ in range(8):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        table_.append(str(c))
    crc = (
        "xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda c: ord(c)::BIGINT)), "
        f"lambda r, b: xor(r >> 8, [{', '.join(table_)}][(xor(r, b) & 255) + 1]::BIGINT)))"
    )
    shown = r"regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1)"

    def add(cost: str, letter: str, said: str, key: str) -> str:
        """Another edit before those of ``key``: eight digits of cost, the letters, a mark, the repaired turns."""
        return (
            f"CASE WHEN {key} IS NULL OR ({cost}) IS NULL THEN NULL ELSE printf('%08d', substr({key}, 1, 8)::INT + {cost}) || '{letter}' || "
            f"substr({key}, 9, strpos({key}, chr(1)) - 8) || {said} || substr({key}, strpos({key}, chr(1)) + 1) END"
        )

    def stay(place: str, key: str) -> list[str]:
        role = {"u": "user", "a": "assistant"}[place]
        end = "chr(10)"
        return [
            add(f"CASE WHEN NOT gone AND initial = '{place}' THEN extra END", "K", f"r.role || ':' || r.text || {end}", key),
            add(f"CASE WHEN NOT gone AND initial <> '{place}' THEN extra + 2 END", "R", f"'{role}:' || r.text || {end}", key),
        ]

    def least(options: list[str]) -> str:
        return "least(" + ", ".join(options) + ")"

    system = add("CASE WHEN NOT gone AND initial = 's' THEN extra END", "K", "r.role || ':' || r.text || chr(10)", "begun")
    put = {"odd": "'user:' || chr(10)", "even": "'assistant:' || chr(10)"}  # the state that follows an inserted turn
    return rf"""
    WITH RECURSIVE keyed AS MATERIALIZED (
        SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
    dealt AS MATERIALIZED (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc} % 20 AS kind FROM keyed),
    damaged AS (
        SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
            CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
            unnest(CASE kind WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
        FROM dealt WHERE kind <> 0),
    told AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
            substr(role, 1, 1) AS initial, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, {shown} IN ('.', '!', '?') AS ended
        FROM damaged),
    judged AS (SELECT *, NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again FROM told),
    turns AS MATERIALIZED (
        SELECT *, blank OR again AS gone, NOT blank AND NOT again AND NOT ended AS cut, (NOT blank AND NOT again AND NOT ended)::INT AS extra,
            initial || lead(initial) OVER (PARTITION BY conv_id ORDER BY i) AS pair
        FROM judged),
    convs AS MATERIALIZED (SELECT d.conv_id, count(t.i) AS n FROM (SELECT DISTINCT conv_id FROM conversations) d
        LEFT JOIN turns t ON t.conv_id IS NOT DISTINCT FROM d.conv_id GROUP BY d.conv_id),
    steps AS (
        SELECT conv_id, n AS i, '00000000' || chr(1) AS first, '00000000' || chr(1) AS even,
            '00000002I' || chr(1) || {put['even']} AS odd, '00000004II' || chr(1) || {put['odd']} || {put['even']} AS begun FROM convs
        UNION ALL
        SELECT conv_id, i, least(first, {add('2', 'I', put['odd'], 'o1')}), least(e0, {add('2', 'I', put['odd'], 'o0')}), o1, least(begun, {add('2', 'I', put['odd'], 'o1')})
        FROM (SELECT *, least(o0, {add('2', 'I', put['even'], 'e0')}) AS o1 FROM (
            SELECT s.conv_id, s.i - 1 AS i,
                {least([add('3', 'D', "''", 'first'), *stay('u', 'odd'), system])} AS first,
                {least([add('3', 'D', "''", 'begun'), *stay('u', 'odd')])} AS begun,
                {least([add('3', 'D', "''", 'even'), *stay('u', 'odd')])} AS e0,
                {least([add('3', 'D', "''", 'odd'), *stay('a', 'even')])} AS o0
            FROM steps s JOIN turns r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.i)))
    SELECT c.conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
        count(*) FILTER (again) AS duplicate, count(*) FILTER (cut) AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
        any_value(substr(first, 1, 8)::BIGINT) AS cost, any_value(substr(first, 9, strpos(first, chr(1)) - 9)) AS audit,
        any_value(sha256(regexp_replace(substr(first, strpos(first, chr(1)) + 1), '\n$', ''))) AS repaired_sha256
    FROM convs c LEFT JOIN turns t ON t.conv_id IS NOT DISTINCT FROM c.conv_id
    JOIN (SELECT conv_id AS id, first FROM steps WHERE i = 0) s ON s.id IS NOT DISTINCT FROM c.conv_id
    GROUP BY c.conv_id"""


@query(_oracle())
def op12_turn_repair(spark, sf_dir):
    placed, audited = structure(table(spark, sf_dir, "conversations"), damaged=True)
    return repair_hashes(placed, audited).withColumnRenamed("conv", "conv_id")
