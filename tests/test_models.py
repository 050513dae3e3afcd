"""Operators against plain Python models on random, skewed rows."""

import datetime as dt
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from offermart.operators import dedup, keys, market, match, search
from offermart.operators import star as S
from offermart.sources import read_bronze_with_rejects, read_cvs


def greedy_model(rows):
    ids, fps, kept = set(), set(), []
    for order, key, fp in sorted(rows):
        if key not in ids and fp not in fps:
            ids.add(key)
            fps.add(fp)
            kept.append(order)
    return kept


def test_greedy_unique_is_the_sequential_pass(spark):
    rng = random.Random(3)
    # A third of the rows share one id; another share one fingerprint.
    rows = [
        (i, "hot" if i % 3 == 0 else f"k{rng.randrange(400)}", "hot" if i % 5 == 0 else f"f{rng.randrange(400)}")
        for i in rng.sample(range(3000), 3000)
    ]
    df = spark.createDataFrame(rows, "ord long, id string, titre string").withColumns(
        {"entreprise": F.lit("E"), "lieu": F.lit(None).cast("string")}
    )
    kept = [r.ord for r in dedup.greedy_unique(df).orderBy("ord").collect()]
    assert kept == greedy_model(rows)


def test_greedy_unique_ends_on_a_long_chain(spark):
    rows = [(i, f"k{i // 2}", f"f{(i + 1) // 2}") for i in range(60)]
    df = spark.createDataFrame(rows, "ord long, id string, titre string").withColumns({"entreprise": F.lit("E"), "lieu": F.lit("")})
    kept = [r.ord for r in dedup.greedy_unique(df).orderBy("ord").collect()]
    assert kept == greedy_model(rows)


def test_first_and_last_by_id(spark):
    rows = [(3, "a"), (1, "a"), (2, "b")]
    df = spark.createDataFrame(rows, "ord long, id string")
    assert {tuple(r) for r in dedup.first_by_id(df).collect()} == {(1, "a"), (2, "b")}
    assert {tuple(r) for r in dedup.last_by_id(df).collect()} == {(3, "a"), (2, "b")}


def test_upsert_states_merge_like_one_pass(spark):
    rng = random.Random(5)
    rows = [(i, f"o{rng.randrange(40)}", f"t{i}", f"v{i}") for i in range(400)]
    fill = {c: F.lit(None).cast("string") for c in S.FROM_GOLD if c not in ("titre_clean", "ville")}
    gold = spark.createDataFrame(rows, "ord long, id string, titre_clean string, ville string").withColumns(
        {**fill, "entreprise": F.lit("E")}
    )
    model = {}
    for order, key, title, city in rows:
        first = model.get(key, (title, city))
        model[key] = (title, first[1])
    parts = [S.upsert_states(gold.filter(F.col("ord") % 3 == n)) for n in range(3)]
    # A replayed part changes nothing.
    merged = S.merge_states(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[1]))
    for states in (S.upsert_states(gold), merged):
        got = {r.id_offre: (r.titre_clean, r.ville) for r in S.fact_rows(states).collect()}
        assert got == model


@pytest.mark.parametrize("parts", [1, 4, 40])
def test_dense_keys_follow_name_order(spark, parts):
    rng = random.Random(1)
    names = list({rng.choice("aéZ€z") * rng.randrange(1, 9) + str(rng.randrange(999)) for _ in range(700)})
    df = spark.createDataFrame([(n,) for n in names], "nom string").repartition(5)
    got = {r.nom: r.k for r in keys.dense_keys(df.repartition(parts), "nom", "k").collect()}
    assert got == {n: i for i, n in enumerate(sorted(names, key=lambda s: s.encode()), 1)}
    old = spark.createDataFrame([(1, "m"), (2, "b")], "k int, nom string")
    more = keys.extend_dimension(old, spark.createDataFrame([("c",), ("b",), ("a",)], "nom string"), "nom", "k")
    assert {(r.k, r.nom) for r in more.collect()} == {(1, "m"), (2, "b"), (3, "a"), (4, "c")}


def matches_model(users, offers, k):
    out = set()
    for user, skills, city, contract in users:
        scored = []
        for offer, offered, place, kind in offers:
            shared = len(set(skills) & {s.lower() for s in offered})
            if shared:
                fits = 1.0 if contract is None or contract == kind else 0.0
                near = 1.0 if (city or "").lower() in (place or "").lower() else 0.5
                score = round(100 * (0.35 * shared / len(offered) + 0.15 * (fits + near) / 2), 6)
                scored.append((-round(score, 1), offer, shared))
        out |= {(user, offer, shared, -score) for score, offer, shared in sorted(scored)[:k]}
    return out


def test_match_top_is_the_full_comparison(spark, monkeypatch):
    rng = random.Random(7)
    names = ["Python", "SQL", "Spark", "Kafka", "Power BI", "R"]
    offers = [
        (f"o{i}", ["Python"] if i % 3 == 0 else rng.sample(names, rng.randrange(1, 5)),
         rng.choice(["Paris", "Lyon", None, "Grand Paris"]), rng.choice(["CDI", "CDD"]))
        for i in range(900)
    ]
    users = [
        (i, ["python"] if i % 3 == 0 else sorted(n.lower() for n in rng.sample(names, rng.randrange(1, 4))),
         rng.choice(["Paris", "Lyon"]), rng.choice(["CDI", None]))
        for i in range(60)
    ]
    # Several blocks, cells and slices, with a class larger than any of them.
    for name, value in {"BLOCK_ROWS": 7, "CELL_ROWS": 5, "ASKED_ROWS": 4, "BUCKET_BITS": 1, "ROUNDS": (1, 3, None)}.items():
        monkeypatch.setattr(search, name, value)
    got = match.match_top(
        spark.createDataFrame(users, "id_utilisateur long, competences array<string>, ville string, contrat string"),
        spark.createDataFrame(offers, "id_offre string, competences array<string>, ville string, type_contrat string"),
        4,
    )
    assert {(r.id_utilisateur, r.id_offre, r.communs, r.score_match) for r in got.collect()} == matches_model(users, offers, 4)


def test_blended_score(spark):
    # Cosine 0.8, one of two skills, same contract, another city.
    users = spark.createDataFrame([(1, ["python"], "Paris", "CDI", [1.0, 0.0])], "id_utilisateur long, competences array<string>, ville string, contrat string, vecteur array<float>")
    offers = spark.createDataFrame([("o", ["Python", "SQL"], "Lyon", "CDI", [0.8, 0.6])], "id_offre string, competences array<string>, ville string, type_contrat string, vecteur array<float>")
    assert match.match_top(users, offers).first().score_match == 68.8


def test_growth_of_an_empty_past(spark):
    now = dt.datetime(2024, 5, 1)
    df = spark.createDataFrame([(now - dt.timedelta(days=1),)] * 30, "date_scraping timestamp_ntz")
    assert market.growth(df, now).first().growth == 2900.0


def test_user_without_skills_gets_a_null(spark):
    users = spark.createDataFrame([(1,), (2,)], "id_utilisateur long")
    skills = spark.createDataFrame([(1, "sql"), (1, "python")], "id_utilisateur long, nom_competence string")
    got = {r.id_utilisateur: r.competences for r in market.user_skills(users, skills).collect()}
    assert got == {1: ["python", "sql"], 2: [None]}


def test_keyword_wildcards(spark):
    df = spark.createDataFrame([("a_b",), ("axb",)], "t string")
    assert df.filter(market.keyword("A_B", "t")).count() == 2
    assert df.filter(market.keyword("A_B", "t", literal=True)).count() == 1


def test_bronze_files_lists_objects_and_broken(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "1.json").write_text('[{"id": "a", "titre": "x"}, {"id": "b"}]')
    (tmp_path / "2.json").write_text('{"id": "c"}')
    (tmp_path / "3.json").write_text('{"id": ')
    good, bad = read_bronze_with_rejects(spark, str(tmp_path))
    assert sorted(r.id for r in good.collect()) == ["a", "b", "c"]
    assert bad.count() == 1


def test_cv_text_drops_bad_bytes(spark, tmp_path):
    (tmp_path / "jean.txt").write_bytes(b"Python\xff\n  et\tSQL")
    assert [tuple(r) for r in read_cvs(spark, str(tmp_path)).collect()] == [("jean", "Python et SQL")]


def test_term_vectors_are_exact_and_rank_like_a_full_comparison(spark):
    rng = random.Random(11)
    words = ["python", "sql", "spark", "équipe", "mission", "lyon", "cloud", "c++"]
    texts = [(f"o{i}", " ".join(rng.choice(words) for _ in range(rng.randrange(0, 30))) + " Fin." * (i % 2), ["Python", "SQL"]) for i in range(80)]
    texts += [("long", "mission " * 3000 + "python", ["SQL"]), ("null", None, ["SQL"])]
    offers = spark.createDataFrame(texts, "id_offre string, texte string, competences array<string>").withColumns(
        {"ville": F.lit("Lyon"), "type_contrat": F.lit("CDI")}
    )
    users = spark.createDataFrame(
        [(1, ["python"]), (2, ["sql"]), (3, ["python", "sql"]), (4, ["cobol", "sql"])], "id_utilisateur long, competences array<string>"
    ).withColumns({"ville": F.lit("Lyon"), "contrat": F.lit("CDI")})
    encoder = match.TermEncoder().fit(offers, "id_offre", F.col("texte"))
    asked = encoder.transform(users, "id_utilisateur", F.array_join("competences", " "))
    offered = encoder.transform(offers, "id_offre", F.col("texte"), only=asked)
    got = {(r.id_utilisateur, r.id_offre, r.score_match) for r in match.match_top(asked, offered, 3).collect()}

    split = lambda t: Counter(w for w in re.split(r"\W+", (t or "").lower()) if w)
    counted = {o: split(t) for o, t, _ in texts}
    df = Counter(w for c in counted.values() for w in c)
    weigh = lambda c: {w: n * math.log((len(texts) + 1) / (df[w] + 1)) for w, n in c.items() if w in df}

    def cosine(a, b):
        length = math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
        return sum(x * b.get(w, 0) for w, x in a.items()) / length if length else 0.0

    want = set()
    for user, skills in ((1, ["python"]), (2, ["sql"]), (3, ["python", "sql"]), (4, ["cobol", "sql"])):
        scored = []
        for offer, _, offered_skills in texts:
            shared = len(set(skills) & {s.lower() for s in offered_skills})
            if shared:
                cos = cosine(weigh(split(" ".join(skills))), weigh(counted[offer]))
                scored.append((-round(round(100 * (0.5 * cos + 0.35 * shared / len(offered_skills) + 0.15), 6), 1), offer))
        want |= {(user, o, -s) for s, o in sorted(scored)[:3]}
    assert got == want
    whole = {r.id_offre: dict(zip(r.termes, r.poids)) for r in encoder.transform(offers, "id_offre", F.col("texte")).collect()}
    assert all(abs(sum(w * w for w in v.values()) - 1) < 1e-9 for v in whole.values() if v)


def test_text_vectors_shuffle_texts_not_words(spark):
    """Words are counted where the texts of a key lie; repeated and null keys count as they did."""
    rows = [(i, f"a b{i} a c") for i in range(20)]
    for more in ([], [(3, "a d"), (None, "a e"), (None, "f")]):
        df = spark.createDataFrame(rows + more, "k long, t string")
        encoder = match.TermEncoder().fit(df, "k", F.col("t"))
        texts = {}
        for k, t in rows + more:
            texts.setdefault(k, []).extend(t.split())
        seen = Counter(w for words in texts.values() for w in set(words))
        want = {w: round(math.log((len(rows + more) + 1) / (n + 1)), 9) for w, n in seen.items()}
        assert {r.mot: round(r.rarete, 9) for r in encoder.terms.collect()} == want
    number = {r.mot: r.terme for r in encoder.terms.collect()}
    got = encoder.transform(df, "k", F.col("t"))
    weights = {w: n * want[w] for w, n in Counter(texts[3]).items()}
    long = math.sqrt(sum(w * w for w in weights.values()))
    three = [r for r in got.collect() if r.k == 3]
    assert len(three) == 2 and all({t: round(p, 6) for t, p in zip(r.termes, r.poids)} == {number[w]: round(x / long, 6) for w, x in weights.items() if x} for r in three)
    plan = executed_plan(encoder._counted(df, "k", F.col("t")))
    assert plan.count("hashpartitioning") == 1 and re.search(r"hashpartitioning\(k#\d+L, \d+\)", plan)


def executed_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def near_centres(rng, n, dims=12, centres=40, spread=0.05):
    import numpy as np

    middle = rng.normal(size=(centres, dims))
    return (middle[rng.integers(0, centres, n)] + rng.normal(0, spread, (n, dims))).astype(np.float32)


@pytest.mark.parametrize("cosine", [True, False])
def test_search_prunes_and_stays_exact(spark, monkeypatch, cosine):
    import numpy as np

    rng = np.random.default_rng(4)
    items, queries = near_centres(rng, 6000) * rng.uniform(0.5, 2, (6000, 1)).astype(np.float32), near_centres(rng, 50)
    items[100:2100] = items[7]  # a third of all rows is one vector
    items[5], queries[3] = 0, 0
    for name, value in {"CELL_ROWS": 32, "BUCKET_BITS": 2, "ASKED_ROWS": 16}.items():
        monkeypatch.setattr(search, name, value)
    left = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "query long, v array<float>")
    right = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(items)], "id long, v array<float>").repartition(6)
    trace = []
    found = search.search(left, right, "id", 5, match.ProductScorer(4), "v", cosine, trace=trace)
    got = sorted((r["query"], -r["value"], r["id"]) for r in found.collect())
    a, b = queries.astype(float), items.astype(float)
    if cosine:
        a, b = search.unit(a)[0], search.unit(b)[0]
    steps = np.rint(a @ b.T * 10_000)
    want = sorted((q, -steps[q, i], i) for q in range(50) for i in np.lexsort((np.arange(6000), -steps[q]))[:5])
    assert got == [(q, v, int(i)) for q, v, i in want]
    assert sum(pairs for _, pairs in trace) < 50 * 6000 / 4


def test_search_of_nothing(spark):
    schema = "query long, v array<float>"
    none, one = spark.createDataFrame([], schema), spark.createDataFrame([(1, [1.0, 0.0])], schema)
    for left, right, rows in ((none, one, 0), (one, none, 0), (one, one, 1)):
        found = search.search(left, right.withColumnRenamed("query", "id"), "id", 3, match.ProductScorer(), "v")
        assert found.count() == rows


def test_matching_by_vectors_visits_few_cells(spark):
    """Blended scores over clustered vectors: the full comparison's result from a small part of the pairs."""
    import numpy as np

    rng = np.random.default_rng(9)
    names = ["python", "sql", "spark", "kafka", "airflow", "r"]
    pick = lambda: sorted(rng.choice(names, rng.integers(1, 4), replace=False).tolist())
    o_vec, u_vec = near_centres(rng, 4000), near_centres(rng, 40)
    offers = [(f"o{i:04}", pick(), ["Paris", "Lyon"][i % 2], ["CDI", "CDD", None][i % 3], v.tolist()) for i, v in enumerate(o_vec)]
    users = [(i, pick(), ["Paris", "Nice"][i % 2], ["CDI", None][i % 2], v.tolist()) for i, v in enumerate(u_vec)]
    trace = []
    got = match.match_top(
        spark.createDataFrame(users, "id_utilisateur long, competences array<string>, ville string, contrat string, vecteur array<float>"),
        spark.createDataFrame(offers, "id_offre string, competences array<string>, ville string, type_contrat string, vecteur array<float>"),
        4, trace=trace,
    )
    cos = search.unit(u_vec.astype(float))[0] @ search.unit(o_vec.astype(float))[0].T
    want = set()
    for user, skills, city, contract, _ in users:
        scored = []
        for i, (offer, offered, place, kind, _) in enumerate(offers):
            shared = len(set(skills) & set(offered))
            if shared:
                fits, near = float(contract is None or contract == kind), 1.0 if city.lower() in place.lower() else 0.5
                total = round(100 * (0.5 * cos[user, i] + 0.35 * shared / len(offered) + 0.15 * (fits + near) / 2), 6)
                scored.append((-round(total, 1), offer, shared))
        want |= {(user, offer, shared, -score) for score, offer, shared in sorted(scored)[:4]}
    assert {(r.id_utilisateur, r.id_offre, r.communs, r.score_match) for r in got.collect()} == want
    assert sum(pairs for _, pairs in trace) < 40 * 4000 / 3


def isotropic_case(rng, n_offers, n_users, dims=32, alike=False):
    """Offers and users over vectors without any structure, some alike, some zero. With ``alike`` the users have few wishes."""
    import numpy as np

    names = ["python", "sql", "spark", "kafka", "airflow", "r", "cobol"]
    pick = lambda: sorted(rng.choice(names[:6], rng.integers(1, 4), replace=False).tolist())
    o_vec, u_vec = rng.normal(size=(n_offers, dims)).astype(np.float32), rng.normal(size=(n_users, dims)).astype(np.float32)
    o_vec[10:40] = o_vec[5]
    o_vec[50], u_vec[3] = 0, 0
    offers = [(f"o{i:05}", pick(), ["Paris", "Lyon", None][i % 3], ["CDI", "CDD", None][i % 4 % 3]) for i in range(n_offers)]
    offers[7] = ("o00007", ["cobol"], "Paris", "CDI")
    users = [(i, pick(), ["Paris", "Nice", None][i % 3], ["CDI", None][i % 2]) for i in range(n_users)]
    if alike:
        users = [(i, [["python"], ["spark", "sql"]][i % 2], ["Paris", "Lyon"][i % 2], "CDI") for i in range(n_users)]
    users[1] = (1, ["cobol"], "Paris", None)  # one offer shares a skill
    return offers, o_vec, users, u_vec


def blended_model(offers, o_vec, users, u_vec, k):
    cos = search.unit(u_vec.astype(float))[0] @ search.unit(o_vec.astype(float))[0].T
    want = set()
    for user, skills, city, contract in users:
        scored = []
        for i, (offer, offered, place, kind) in enumerate(offers):
            shared = len(set(skills) & set(offered))
            if shared:
                fits, near = float(contract is None or contract == kind), 1.0 if (city or "").lower() in (place or "").lower() else 0.5
                total = round(100 * (0.5 * cos[user, i] + 0.35 * shared / len(offered) + 0.15 * (fits + near) / 2), 6)
                scored.append((-round(total, 1), offer, shared))
        want |= {(user, offer, shared, -score) for score, offer, shared in sorted(scored)[:k]}
    return want


def test_matching_over_isotropic_vectors_scores_few_pairs(spark):
    """Pairs are bounded by the leading numbers of their vectors where no cell can be left out."""
    import numpy as np

    offers, o_vec, users, u_vec = isotropic_case(np.random.default_rng(2), 9000, 300, 64, alike=True)
    trace = []
    got = match.match_top(
        spark.createDataFrame([(*u, v.tolist()) for u, v in zip(users, u_vec)], "id_utilisateur long, competences array<string>, ville string, contrat string, vecteur array<float>"),
        spark.createDataFrame([(*o, v.tolist()) for o, v in zip(offers, o_vec)], "id_offre string, competences array<string>, ville string, type_contrat string, vecteur array<float>"),
        3, trace=trace,
    )
    assert {(r.id_utilisateur, r.id_offre, r.communs, r.score_match) for r in got.collect()} == blended_model(offers, o_vec, users, u_vec, 3)
    assert sum(pairs for _, pairs in trace) < 300 * 9000 / 2


@pytest.mark.parametrize("floors", [False, True])
def test_leading_numbers_bound_every_pair(monkeypatch, floors):
    """One block of queries and items, cut into many packs, slabs, waves and strips, with and without floors."""
    import numpy as np
    import pandas as pd

    from offermart.operators import leading

    rng = np.random.default_rng(6)
    offers, o_vec, users, u_vec = isotropic_case(rng, 700, 60)
    small = {"PACK_ROWS": 9, "PACK_LEAST": 4, "STRIP_ROWS": 24, "FIRST_ROWS": 8, "FEW_TRAITS": 3, "TABLE": 600, "REFINED": 50, "WAVES": ((0, 16), (16, 64), (64, None))}
    for name, value in small.items():
        monkeypatch.setattr(leading, name, value)
    scorer = match.OfferScorer(match.Scoring(), "vecteur")
    items = pd.DataFrame([(o, s, c and c.lower(), k) for o, s, c, k in offers], columns=["_id", "competences", "ville", "type_contrat"])
    queries = pd.DataFrame([(u, s, c and c.lower(), k) for u, s, c, k in users], columns=["query", "competences", "ville", "contrat"])
    want = blended_model(offers, o_vec, users, u_vec, 4)
    lowest = {u: min(s for w, _, _, s in want if w == u) * 10 for u, *_ in users}
    queries["floor"] = [lowest[u] if floors and u % 3 else None for u in queries["query"]]
    queries["floor"] = queries["floor"].astype(float)
    own, theirs = (search.unit(v.astype(float))[0] for v in (u_vec, o_vec))
    by = leading.rotation(theirs[:200])
    assert np.allclose(by @ by.T, np.eye(32))
    pairs = leading.best_pairs(queries, items, own, theirs, by, 4, scorer)
    got = {(int(queries["query"][r.row]), r.id, round(r.value) / 10) for r in pairs.itertuples()}
    assert got == {(u, o, s) for u, o, _, s in want}


def test_encoder_model_runs_in_batches(spark):
    df = spark.createDataFrame([("a",), ("bbb",), (None,)], "t string")

    def load():
        return lambda texts: [[float(len(t)), 1.0] for t in texts]

    assert sorted(r.vecteur for r in match.encode(df, "t", load).collect()) == [[0.0, 1.0], [1.0, 1.0], [3.0, 1.0]]


def test_als_ranks_and_is_saved(spark, tmp_path):
    from pyspark.ml.recommendation import ALSModel

    from offermart.operators import als
    from offermart.sinks import save_model

    rows = [(u, f"o{i}", float((u + i) % 5)) for u in range(8) for i in range(12) if (u * i) % 3]
    scored = spark.createDataFrame(rows * 2, "id_utilisateur long, id_offre string, score_recommandation double")
    ratings, ids = als.ratings(scored)
    assert ratings.count() == len(rows) and ids.count() == len({o for _, o, _ in rows})
    model = als.train(ratings)
    top = als.top_offers(model, 3).collect()
    users = {r.id: r.features for r in model.userFactors.collect()}
    items = {r.id: r.features for r in model.itemFactors.collect()}
    for user, own in users.items():  # the list of each user is the best of all products
        products = sorted((-sum(a * b for a, b in zip(own, item)), i) for i, item in items.items())[:3]
        mine = sorted((r.rang, r.offre_id, r.score) for r in top if r.user_id == user)
        assert [i for _, i, _ in mine] == [i for _, i in products]
        assert [round(s, 4) for *_, s in mine] == [round(-p, 4) for p, _ in products]
    assert {r.rang for r in top} == {1, 2, 3} and len(top) == 3 * ratings.select("user_id").distinct().count()
    save_model(model, str(tmp_path / "model"))
    assert ALSModel.load(str(tmp_path / "model")).rank == 10


def test_the_last_round_writes_no_row_per_query_and_cell(spark, monkeypatch):
    """Cells that are still open after the rounds with a limit are bounded and scored in one task; ties keep the order of the cells."""
    import numpy as np

    rng = np.random.default_rng(5)
    items, queries = rng.normal(size=(300, 6)).astype(np.float32).round(1), rng.normal(size=(30, 6)).astype(np.float32).round(1)
    for name, value in {"BLOCK_ROWS": 8, "CELL_ROWS": 4, "BUCKET_BITS": 1, "ROUNDS": (1, 3, None)}.items():
        monkeypatch.setattr(search, name, value)
    limits, visit = [], search._to_visit
    monkeypatch.setattr(search, "_to_visit", lambda *a: limits.append(a[-1]) or visit(*a))
    left = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(queries)], "query long, v array<float>")
    right = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(items)], "id long, v array<float>")
    got = {(r["query"], r["id"], r["value"]) for r in search.search(left, right, "id", 4, match.ProductScorer(2), "v").collect()}
    steps = np.rint(search.unit(queries.astype(float))[0] @ search.unit(items.astype(float))[0].T * 100)
    assert got == {(q, int(i), steps[q, i]) for q in range(30) for i in np.lexsort((np.arange(300), -steps[q]))[:4]}
    assert limits == [1, 2]
    bound, open_ = np.array([[1.0, 3, 3, 3, 2]]), np.array([[True, True, False, True, True]])
    assert search._best(bound, open_, 1).tolist() == [[False, True, False, False, False]]
    assert search._best(bound, open_, 3).tolist() == [[False, True, False, True, True]]
