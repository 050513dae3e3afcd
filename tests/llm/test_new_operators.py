"""Codes of vectors, repair of conversations and fingerprints, each against a plain version and on awkward rows."""

import hashlib
import itertools
import random
import zlib
from functools import lru_cache

import numpy as np
import pytest

from offermart.llm import fingerprints as FP
from offermart.llm import turns as T
from offermart.llm import vector_codes as V
from offermart.llm.common import table
from offermart.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


# --- vector codes ---------------------------------------------------------------------------------------------------


def plain_codes(vectors, parts, entries, rounds):
    """All distances, no blocks: ``vectors`` in the order of their ids."""
    q = np.floor(np.array(vectors, np.float64) * 4096).astype(np.int64).reshape(len(vectors), parts, -1)
    books = q[:entries].transpose(1, 0, 2).copy()
    for last in [False] * rounds + [True]:
        apart = ((q[:, :, None, :] - books[None]) ** 2).sum(-1)
        chosen = apart.argmin(-1)
        if last:
            return chosen, apart.min(-1).sum(1), books
        for p, e in itertools.product(range(parts), range(books.shape[1])):
            own = q[chosen[:, p] == e, p]
            if len(own):
                books[p, e] = [int(s) // len(own) for s in own.sum(0)]


def test_hilbert_neighbours_touch():
    for n, bits in ((2, 4), (3, 3)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=n)))
        keys = V.hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        path = cells[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_shortlists_are_exact():
    rng = np.random.default_rng(3)
    shorter = 0
    for spread in (1, 5, 50, 500):
        parts, books = rng.integers(-500, 500, 8) + rng.integers(-spread, spread + 1, (64, 8)), rng.integers(-500, 500, (16, 8))
        books[7] = books[2]  # a tie
        listed = V.shortlist(parts.min(0), parts.max(0), books)
        chosen, apart = V.nearest(parts, books, listed)
        every = ((parts[:, None] - books) ** 2).sum(-1)
        assert (chosen == every.argmin(1)).all() and (apart == every.min(1)).all()
        shorter += len(listed) < 16
    assert shorter >= 2


@pytest.mark.parametrize("n", [3, 400])
def test_codes_equal_plain(spark, n):
    rng = np.random.default_rng(n)
    centres = rng.normal(0, 0.3, (5, 16))
    vectors = [(centres[i % 5] + rng.normal(0, 0.01, 16)).astype(np.float32).tolist() for i in range(n)]
    vectors[1] = vectors[0]
    rows = [(i, v, i % 3 or None) for i, v in enumerate(vectors)]
    rows += [(n, None, 1), (n + 1, [float("nan")] + [0.0] * 15, 1), (n + 2, [None] + [0.0] * 15, 1), (None, vectors[2], 2)]
    rows += [(n + 3, [float("inf")] + [0.0] * 15, 1), (n + 4, [], 1), (n + 5, [1.0] * 15, 1), (n + 6, [1.0] * 8, 1), (0, vectors[0], None)]
    extra = "rid string, pos string, code string, error string, n string, id string"
    df = spark.createDataFrame([(*r, *["x"] * 6) for r in rows], f"vec_id long, embedding array<float>, label int, {extra}").repartition(3)
    coded, books = V.compress(df, parts=4, entries=6, rounds=4)
    got = sorted((-1 if r["id"] is None else r["id"], r["code"], r["error"], r["label_error"]) for r in V.label_errors(coded).collect())
    kept = sorted(((10**9 if r[0] is None else r[0]), i, r) for i, r in enumerate(rows) if r[1] and len(r[1]) == 16 and np.isfinite(np.array(r[1], float)).all())
    chosen, error, want_books = plain_codes([k[2][1] for k in kept], 4, 6, 4)
    by_label = {}
    for (_, _, r), e in zip(kept, error):
        by_label[r[2]] = by_label.get(r[2], 0) + int(e)
    want = sorted(
        (-1 if r[0] is None else r[0], "".join(f"{c:02x}" for c in codes), int(e), by_label[r[2]]) for (_, _, r), codes, e in zip(kept, chosen, error)
    )
    assert got == want and (books == want_books).all()


def test_whole_blocks_are_taken_by_their_sum():
    """Of well separated groups most blocks need no distance of a single part."""
    rng = np.random.default_rng(0)
    centres = rng.integers(-10_000, 10_000, (16, 8))
    parts = np.repeat(centres, 1000, axis=0) + rng.integers(-20, 20, (16_000, 8))
    parts = parts[np.argsort(V._curve(parts, 11_000), kind="stable")]
    sizes = [len(V.shortlist(b.min(0), b.max(0), centres)) for b in np.split(parts, 125)]
    assert sizes.count(1) > 60


def test_no_vectors_and_too_large(spark):
    schema = "vec_id long, embedding array<float>, label int"
    coded, books = V.compress(spark.createDataFrame([(1, None, 2)], schema))
    assert V.label_errors(coded).collect() == [] and books.size == 0
    with pytest.raises(ValueError):
        V.compress(spark.createDataFrame([(1, [1e6] * 8, 2)], schema))


# --- conversations --------------------------------------------------------------------------------------------------


def plain_audit(initials, faults):
    """Least (cost, audit) over all edits, by their definition."""

    @lru_cache(None)
    def go(i, state, added):
        options = [(0, "")] if i == len(initials) and state in "02" else []
        letter, after = {"0": "u1", "3": "u1", "1": "a2", "2": "u1"}[state]
        if added < 3:
            options += [(2 + c, "I" + a) for c, a in [go(i, after, added + 1)]]
        if i < len(initials):
            options += [(3 + c, "D" + a) for c, a in [go(i + 1, state, 0)]]
            if faults[i] not in "bd":
                extra, fits = faults[i] == "t", initials[i] == letter
                options += [(extra + (0 if fits else 2) + c, ("K" if fits else "R") + a) for c, a in [go(i + 1, after, 0)]]
                if state == "0" and initials[i] == "s":
                    options += [(extra + c, "K" + a) for c, a in [go(i + 1, "3", 0)]]
        return min(options, default=(10**6, ""))

    return go(0, "0", 0)


def test_audits_equal_plain():
    rng = random.Random(1)
    for _ in range(1500):
        n = rng.randint(0, 11)
        initials = "".join(rng.choice("suuaaao" if rng.random() < 0.5 else "ua") for _ in range(n))
        faults = "".join(rng.choice("bdtffff") for _ in range(n))
        want = plain_audit(initials, faults)
        assert T._audit_by_targets(T.Turns(initials, faults)) == want
        assert T._audit_by_parity(T.Turns(initials, faults), chunk=rng.choice([1, 2, 3, 100])) == want


def test_long_conversation():
    rng = random.Random(2)
    initials, faults = "".join(rng.choice("uas") for _ in range(3000)), "".join(rng.choice("bdtffff") for _ in range(3000))
    assert T.audit(initials, faults) == T._audit_by_targets(T.Turns(initials, faults))


def plain_repair(rows):
    """The contract, row by row."""
    out = {}
    for conv in {r[0] for r in rows}:
        said = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            if kind == 0:
                continue
            text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
            said += [(turn is not None, turn or 0, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
        said.sort(key=lambda r: (r[0], r[1], r[2].encode(), r[3].encode()))
        seen, faults = set(), ""
        for _, _, role, text in said:
            shown = text.strip(" \t\n\v\f\r")
            faults += "b" if not shown else "d" if (role, text) in seen else "t" if shown[-1] not in ".!?" else "f"
            seen.add((role, text))
        initials = [r[2][:1] for r in said]
        cost, audit = plain_audit("".join(c if c in ("s", "u", "a") else "o" for c in initials), faults)
        known = {r[1] for r in said if r[0]}
        lines, rest, odd = [], list(said), (len(audit) - audit.count("D")) % 2
        for letter in audit:
            row = None if letter == "I" else rest.pop(0)
            if letter != "D":
                role = row[2] if letter == "K" else ("user", "assistant")[(len(lines) + odd) % 2]
                lines.append(f"{role}:{row[3] if row else ''}")
        out[conv] = (
            max(known) - min(known) + 1 - len(known) if known else 0, *(faults.count(f) for f in "bdt"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def test_repair_equals_plain(spark):
    rng = random.Random(5)
    rows = []
    for conv in [*range(60), None]:
        for turn in [*range(rng.randint(1, 9)), *[None] * rng.randint(0, 2)]:
            role = rng.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"])
            rows.append((conv, turn, role, rng.choice(["Yes.", "Yes.", "No! ", "Why", "", None, " \x1c", "a.b\n", f"x{rng.random()}."])))
    rows += rows[:5]
    extra = [c for c in ("conv", "at", "copy", "initial", "fault", "h1", "place", "audit", "cost")]
    schema = "conv_id long, turn long, role string, text string, " + ", ".join(f"{c} string" for c in extra)
    df = spark.createDataFrame([(*r, *["x"] * len(extra)) for r in rows], schema).repartition(3)
    placed, audited = T.structure(df, damaged=True)
    found = T.repair_hashes(placed, audited)
    assert found.columns == ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = {r[0]: tuple(r[1:]) for r in found.collect()}
    assert got == plain_repair(rows)
    # The repaired turns themselves, in any order, give the same hash.
    lines = {}
    for r in sorted(T.repaired(placed, audited).collect(), key=lambda r: r["place"]):
        lines.setdefault(r["conv"], []).append(f"{r['role']}:{r['text']}")
    assert {c: hashlib.sha256("\n".join(lines.get(c, [])).encode()).hexdigest() for c in got} == {c: v[-1] for c, v in got.items()}


def test_repair_of_sound_and_no_turns(spark):
    schema = "conv_id long, turn int, role string, text string"
    sound = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi?"), (1, 2, "assistant", "Hello.")]
    placed, audited = T.structure(spark.createDataFrame(sound, schema))
    assert [(r["cost"], r["audit"]) for r in audited.collect()] == [(0, "KKK")]
    placed, audited = T.structure(spark.createDataFrame([], schema), damaged=True)
    assert T.repair_hashes(placed, audited).collect() == [] and T.repaired(placed, audited).collect() == []


# --- fingerprints ---------------------------------------------------------------------------------------------------


def plain_next(rows):
    """Rows ``(id, text)`` by falling id, each with its edited text; ids differ."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = {}
    for (key, text), (_, more) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + more[:half]
        own, new, following = (FP.fingerprint(t) for t in (text, edited, more))
        hexed = lambda f: "".join(f"{w:016x}" for w in f)
        out[key] = (
            len(text), hashlib.sha256(edited.encode()).hexdigest(), hexed(own), hexed(new), round(FP.likeness(own, new), 9), round(FP.likeness(own, following), 9)
        )
    return out


def shown(df):
    columns = df.select("id", "n_chars", "edited_sha256", FP.digits(df.fp), FP.digits(df.edited_fp), "near_edited", "near_next")
    return {r[0]: (*r[1:5], round(r[5], 9), round(r[6], 9)) for r in columns.collect()}


def test_fingerprint_by_definition():
    """Votes counted one by one, and short, long and empty texts."""
    for text in ("one two three two One", "word", "a b", "x " * 20_000 + "tail"):
        terms = FP.term_hashes(text.encode())
        words = text.lower().split()
        assert len(terms) == len(words) + max(0, len(words) - 2)
        votes = np.zeros(256)
        for h, n in zip(*np.unique(terms, return_counts=True)):
            votes += np.rint(64 * (1 + np.log(n))) * (2.0 * FP._bits(np.array([h]))[0] - 1)
        assert (np.unpackbits(FP.fingerprint(text).view(np.uint8), bitorder="little") == (votes > 0)).all()
    assert not FP.fingerprint("").any() and not FP.fingerprint(None).any() and not FP.fingerprint(" \n").any()


def test_next_and_edited_equal_plain(spark, docs, none):
    rows = [(i, f"text number {i} " + "and so on " * (i % 7) + "日本 x"[: i % 6]) for i in range(1, 90)] + [(None, None), (200, ""), (201, "long " * 30_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert shown(FP.with_next(df.repartition(5))) == plain_next(rows)
    one = spark.createDataFrame([(7, "only one text here")], "doc_id long, text string")
    assert shown(FP.with_next(one)) == plain_next([(7, "only one text here")])
    assert FP.with_next(none).collect() == []
    awkward = FP.with_next(docs).collect()  # null and repeated ids, clashing columns
    assert len(awkward) == docs.count()
    by_text = {}
    for r in docs.collect():
        by_text.setdefault(r["doc_id"], []).append(len(r["text"] or ""))
    got = {}
    for r in awkward:
        got.setdefault(r["id"], []).append(r["n_chars"])
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in by_text.items()}


@pytest.mark.parametrize("radius, blocks", [(7, 8), (3, 4), (2, 4), (6, 8)])
def test_search_finds_all_within_radius(spark, radius, blocks):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2, (20, 256), dtype=np.uint8)
    bits = [b for b in base]
    for b in base:
        for flips in range(1, 11):
            other = b.copy()
            other[rng.choice(256, flips, replace=False)] ^= 1
            bits.append(other)
    words = np.packbits(np.array(bits), axis=1, bitorder="little").view("<i8")
    prints = spark.createDataFrame([(w.tolist(),) for w in words], "fp array<long>").distinct()
    queries = spark.createDataFrame([(w.tolist(),) for w in words[::3]], "fp array<long>").distinct()
    got = sorted((tuple(r["q"]), tuple(r["fp"]), r["differ"]) for r in FP.within(prints, queries, radius, blocks).collect())
    want = []
    for q in words[::3]:
        far = np.bitwise_count(words.view(np.uint64) ^ q.view(np.uint64)).sum(1)
        want += [(tuple(q.tolist()), tuple(words[i].tolist()), int(far[i])) for i in np.flatnonzero(far <= radius)]
    assert got == sorted(want) and len(want) > len(words[::3])


def test_fingerprint_query_equals_plain(spark):
    found = QUERIES["op13_fingerprints"](spark, SF).collect()
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    want = plain_next(rows)
    got = {r["doc_id"]: (r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in found}
    assert got == want
    bits = {r["doc_id"]: np.array([int(r["fingerprint"][i : i + 16], 16) for i in range(0, 64, 16)], np.uint64) for r in found}
    for r in found:
        near = sum(int(np.bitwise_count(b ^ bits[r["doc_id"]]).sum()) <= 7 for b in bits.values()) - 1
        assert r["n_near"] == (near if r["doc_id"] % 20 == 0 else None)
    assert np.mean([r["near_edited"] > r["near_next"] for r in found if r["n_chars"] > 40]) > 0.97
