"""Unit cases of the column functions: input and expected value, worked out by hand from the rules."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from offermart import vocab as V
from offermart.functions import labels, salary, skills, text, values
from offermart.operators import terms as terms_module
from offermart.operators.terms import find_terms

CASES = {
    "title_a": (lambda c: text.clean_title(c, V.A), [("Data Engineer (H/F)", "Data Engineer"), (None, "")]),
    "title_f": (
        lambda c: text.clean_title(c, V.F),
        [("data analyst junior - (H/F)", "Data Analyst Junior -"), ("c++/sql l'oréal 3d", "C++/Sql L'Oréal 3D")],
    ),
    "title_w": (
        lambda c: text.clean_title(c, V.W),
        [("Data Architect 45 k€ Paris", "Data ArchitectParis"), ("ML (CDI)", "ML"), ("Dev ( H / F )", "Dev")],
    ),
    "city_a": (
        lambda c: text.clean_city(c, V.A),
        [("France", "Non spécifié"), ("Paris 75001, IdF", "Paris"), ("", "Non spécifié"), (None, "Non spécifié")],
    ),
    "city_f": (lambda c: text.clean_city(c, V.F), [("75 - Paris 75001", "Paris"), ("France", "France"), (None, "Non spécifié")]),
    "city_w": (
        lambda c: text.clean_city(c, V.W),
        [("Lyon (69), Rhône", "Lyon"), ("En télétravail, Lyon", "Télétravail"), ("Île-de-France", "France")],
    ),
    "company": (text.clean_company, [("Acme S.A.S.", "Acme"), ("Acme SA", "Acme"), ("X (Groupe)", "X"), ("", "Non spécifié")]),
    "contract_a": (lambda c: labels.normalize_contract(c, V.A), [("cdi", "CDI"), ("Autre", "Autre"), (None, "Non spécifié")]),
    "contract_f": (lambda c: labels.normalize_contract(c, V.F), [("MIS", "Intérim"), ("Intérim", "Non spécifié")]),
    "contract_f_kept": (lambda c: labels.normalize_contract(c, V.F, keep_interim=True), [("Intérim", "Intérim")]),
    "contract_w": (lambda c: labels.normalize_contract(c, V.W), [(" vie ", "VIE"), ("autre", "AUTRE")]),
    "contract_text": (
        labels.contract_from_text,
        [("Poste Permanent", "CDI"), ("INDÉPENDANT", "Freelance"), ("contracts", "Non spécifié")],
    ),
    "contract_code": (labels.contract_from_code, [("CCE", "Freelance"), ("SAI", "Saisonnier"), ("x", "Non spécifié")]),
    "experience_f": (
        lambda c: labels.experience_level(c, V.F),
        [("Profil confirmé, manager", "Mid"), ("DÉBUTANT", "Entry"), ("5+ ans", "Senior"), ("mideast", "Non spécifié")],
    ),
    "experience_w": (
        lambda c: labels.experience_level(c, V.W),
        [("0–2 ans", "Entry"), ("x+5 ans", "Senior"), (" +5 ans", "Non spécifié"), ("2 ans et senior", "Mid")],
    ),
    "salary_f": (
        lambda c: salary.salary_from_text(c, V.F),
        [
            ("3000-4000 €/mois", 4000), ("45 k€", 3750), ("TJM : 400", 8000), ("36000 € par an", 3000),
            ("36000 / an", 3000), ("Salaire : 2500 €", 2500), ("à partir de 2100 €", 2100), ("450 € / jour", 9000),
            ("45 000 €", None), ("rien", None), (None, None),
        ],
    ),
    "salary_w": (lambda c: salary.salary_from_text(c, V.W), [("2500 € brut", 2500), ("à partir de 2100 €", None)]),
    "salary_title": (salary.salary_from_title, [("Dev 36000€", 3000), ("Dev 45 K €", 3750), ("Dev 45 k / an", 3750)]),
    "skills": (
        lambda c: F.array_join(skills.extract_skills(c, V.SKILLS_ETL_FW), "|"),
        [
            ("Python, SQL ci/cd et R, Scikit-learn power  bi javascript", "CI/CD|Power BI|Python|R|SQL|Scikit-learn"),
            ("NoSQL robot scikit learn", ""), (None, ""), ("R&D cicd", "CI/CD|R"),
        ],
    ),
    "skills_collector": (
        lambda c: F.array_join(skills.extract_skills(c, V.SKILLS_COLLECTOR), "|"),
        [("scikit learn DBT postgresql", "PostgreSQL|Scikit-learn|dbt")],
    ),
    "skills_substring": (
        lambda c: F.array_join(skills.extract_skills(c, V.SKILLS_CV), "|"), [("JavaScript PostgreSQL", "java|postgresql|sql")]
    ),
    "search_text": (lambda c: text.search_text([c], F.array().cast("array<string>")), [("Données €/an", "données   an")]),
    "initials": (text.initials, [("jean paul luc", "JP"), ("acme", "A"), (None, "JI"), ("", "JI")]),
    "tail": (text.location_tail, [("75 - Paris - Nord", "Nord"), ("Paris", "Paris")]),
    "slug": (text.slug, [("a b-c", "a_b_c"), ("été", "été")]),
    "number": (values.to_number, [("1.5", 1.5), ("x", None)]),
}


@pytest.mark.parametrize("name", CASES)
def test_column_function(spark, name):
    fn, cases = CASES[name]
    rows = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(cases)], "i int, x string")
    got = [r[0] for r in rows.select("i", fn(F.col("x")).alias("y")).orderBy("i").select("y").collect()]
    assert got == [y for _, y in cases]


def test_salary_bounds(spark):
    rows = spark.createDataFrame(
        [(0, "Annuel de 35000.0 Euros à 40000.0 Euros"), (1, "Mensuel de 2 500 Euros"), (2, None)], "i int, x string"
    )
    got = [tuple(r[0]) for r in rows.orderBy("i").select(salary.bounds_from_label(F.col("x"))).collect()]
    assert got == [(35000, 0), (2500, None), (None, None)]
    pages = ["40 000 € - 50 000 €", "35K - 45K", "38 000 € / an", "sans"]
    rows = spark.createDataFrame(list(enumerate(pages)), "i int, x string")
    got = [tuple(r[0]) for r in rows.orderBy("i").select(salary.bounds_from_page(F.col("x"))).collect()]
    assert got == [(40000, 50000), (35000, 45000), (38000, None), (None, None)]


def test_salary_cascades(spark):
    rows = spark.createDataFrame([(0, "", 10000), (1, "", 24000), (2, "", 3000), (3, "45 k€", 3000)], "i int, d string, low int")
    args = (F.col("d"), F.lit(""), F.col("low"), F.lit(None).cast("int"))
    got = rows.orderBy("i").select(
        salary.monthly_salary(V.A, *args), salary.monthly_salary(V.F, *args), salary.monthly_salary(V.W, *args)
    )
    assert [tuple(r) for r in got.collect()] == [
        (10000, None, 10000), (2000, 2000, 2000), (3000, 3000, 3000), (3000, 3750, 3750)
    ]


def test_scores(spark):
    one = spark.range(1)
    score = values.quality_score(F.lit(600), F.lit(5), F.lit("CDI"), F.lit(3000))
    row = one.select(score.alias("s"), values.quality_percent(score).alias("p")).first()
    assert (row.s, row.p) == (7, 100.0)
    shown = one.select(*[values.display_score(F.lit(n)) for n in (0, 1, 30)]).first()
    assert tuple(shown) == (65, 62, 99)
    assert one.select(values.harmonic_score(F.lit(1), F.lit(2), F.lit(3))).first()[0] == 0.25


def test_vocabulary_with_overlapping_terms(spark):
    vocabulary = {"Power": "power", "Power BI": r"power\s*bi", "SQL": "sql", "SQL Server": r"sql\s+server", "R": "r"}
    rows = [("power bi and SQL Server", "Power|Power BI|SQL|SQL Server"), ("Powerful r", "R"), ("sql", "SQL"), (None, "")]
    df = spark.createDataFrame(rows, "text string, want string")
    got = df.select(F.array_join(skills.find_words(F.col("text"), vocabulary), "|"), "want").collect()
    assert all(a == b for a, b in got)
    assert skills.split_overlaps(vocabulary)[0] == {"R": "r"}


@pytest.mark.parametrize(
    "names, text, want",
    [
        (["node", "node.js", "c", "c++", "ml", "mlops"], "we use node.js, c++ and ml-ops", "c|c++|ml|node|node.js"),
        (["node", "node.js", "c", "c++", "ml", "mlops"], "C, mlops; Node js", "c|mlops|node"),
        (["c++", "c++11", ".net", "a.b"], "c++11 asp.net .net a.b.c c++x", ".net|a.b|c++11"),
        (["sql", "sql server", "server"], "SQL  Server", "server|sql"),
        (["+x", "é"], "a+x É +x", "+x|é"),
    ],
)
def test_any_vocabulary_is_found_term_by_term(spark, names, text, want):
    """One pass, single tests and the join with a table of terms agree, whatever signs the terms hold."""
    patterns = {n: re.escape(n.lower()) for n in names}
    plain = sorted(n for n, p in patterns.items() if re.search((r"(?<=\w)" if n[0] == "+" else r"(?<!\w)") + p + r"(?!\w)", text.lower()))
    assert "|".join(plain) == want
    df = spark.createDataFrame([(1, text)], "k long, t string")
    assert df.select(F.array_join(skills.extract_skills(F.col("t"), names, "word"), "|")).first()[0] == want
    terms = spark.createDataFrame([(n,) for n in [*names, names[0], None, "++"]], "terme string")
    assert "|".join(sorted(r["terme"] for r in find_terms(df, "k", "t", terms).collect())) == want


def test_terms_of_a_table_are_found_as_by_single_tests(spark, monkeypatch):
    rng = random.Random(8)
    words = ["a", "b1", "Été", "c++", "x.y", "z", "-", "#", "\n", "日本"]
    texts = [(i, rng.choice([" ", ""]).join(rng.choice(words) + rng.choice(["", " ", ", "]) for _ in range(rng.randrange(0, 40)))) for i in range(150)]
    texts += [(150, None), (151, ""), (152, "a " * 20_000 + "x.y")]
    names = sorted({(rng.choice(["", "", "+", ".", "#"]) + " ".join(rng.choice(["a", "b1", "été", "z", "x.y", "日本"]) for _ in range(rng.randrange(1, 4))) + rng.choice(["", "", "++", "#"])) for _ in range(120)})
    df, terms = spark.createDataFrame(texts, "k long, t string"), spark.createDataFrame([(n,) for n in names], "nom string")
    want = set()
    for k, text in texts:
        for n in names:
            begin = r"(?<=\w)" if n[0] == "+" else r"(?<!\w)"
            if re.search(begin + re.escape(n.lower()) + r"(?!\w)", (text or "").lower()):
                want.add((k, n))
    for rows in (1_000, 0):  # broadcast and shuffled
        monkeypatch.setattr(terms_module, "BROADCAST_ROWS", rows)
        assert {tuple(r) for r in find_terms(df, "k", "t", terms, "nom").collect()} == want
    assert len(want) > 300 and find_terms(df, "k", "t", terms.limit(0), "nom").count() == 0


def test_terms_of_a_text_of_many_words(spark):
    """Time grows with the words of a text, not with their square."""
    text = " ".join(f"w{i}" for i in range(100_000)) + " c++"
    df = spark.createDataFrame([(1, text)], "k long, t string")
    terms = spark.createDataFrame([("w7",), ("w8 w9",), ("C++",), ("w99999",), ("w",)], "terme string")
    begun = time.monotonic()
    assert {r["terme"] for r in find_terms(df, "k", "t", terms).collect()} == {"w7", "w8 w9", "C++", "w99999"}
    assert time.monotonic() - begun < 30


def test_only_runs_of_sizes_with_many_terms_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(terms_module, "BROADCAST_ROWS", 10)
    texts = [(i, " ".join(f"w{(i + n) % 90}" for n in range(20)) + " C++") for i in range(60)]
    terms = spark.createDataFrame([(f"w{n}",) for n in range(80)] + [("w1 w2",), ("c++",)], "terme string")
    want = {(i, t) for i, text in texts for t in [f"w{n}" for n in range(80)] if t in text.split()}
    want |= {(i, "w1 w2") for i, text in texts if "w1 w2 " in text} | {(i, "c++") for i, _ in texts}
    for rows in (texts, texts + texts[:7] + [(None, "w1 w2"), (None, "w2")]):
        found = find_terms(spark.createDataFrame(rows, "k long, t string"), "k", "t", terms)
        more = {(None, "w1 w2"), (None, "w1"), (None, "w2")} if len(rows) > 60 else set()
        assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, want | more))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(size" in plan and "BroadcastHashJoin [size" in plan
        first = plan.split("== Initial Plan ==")[-1]
        assert "ShuffledHashJoin [size" in first and "SortMergeJoin" not in first
        # Nothing found without signs is moved by its row.
        assert plan.split("== Initial Plan ==")[0].count("hashpartitioning(k") <= 1


def test_white_space_is_that_of_unicode(spark):
    """Trimmed and squeezed as by the pattern ``\\s`` with Unicode classes, for every sign of the basic plane."""
    signs = spark.range(1, 0xD800).selectExpr("decode(unhex(lpad(hex(id), 4, '0')), 'UTF-16BE') AS c")
    df = signs.selectExpr("c || ' ' || c || 'a b' || c || c || 'd ' || c || ' ' AS s")
    same = (text.strip(F.col("s")) == F.regexp_replace("s", r"(?U)^\s+|\s+$", "")) & (text.squeeze(F.col("s")) == F.regexp_replace("s", r"(?U)\s+", " "))
    assert df.count() > 55_000 and df.filter(~same).count() == 0


def test_patterns_only_run_over_texts_that_hold_their_letters(spark):
    found = [text.required(p) for p in (r"scikit[-\s]?learn", r"ci/?cd", r"c\+\+", r"a|b", r"(ab)?c", r"(\d{4,5})\s*€?\s*/\s*mois", r"abc{0,2}")]
    assert found == ["scikit", "ci", "c", "", "", "mois", "ab"]
    df = spark.createDataFrame([("c5+ ans",), ("5+ ans",), ("x+5 ans",), ("+5 ans",), ("scikit learnt",), ("(Scikit-Learn)",), (None,)], "s string")
    rows = df.select(text.holds(F.lower("s"), r"5\+\s*ans"), text.holds(F.lower("s"), r"\+5 ans"), text.holds(F.lower("s"), r"scikit[-\s]?learn")).collect()
    no = (False, False, False)
    assert [tuple(r) for r in rows] == [no, (True, False, False), (False, True, False), no, no, (False, False, True), (None, None, None)]
    shown = df.select(salary.salary_from_text(F.col("s"), "welcometothejungle"))._jdf.queryExecution().executedPlan().toString()
    assert "Contains(" in shown or "contains(" in shown.lower()


def test_amounts_are_looked_for_where_all_their_letters_are(spark):
    assert text.runs(r"(\d{4,5})\s*€?\s*/\s*mois") == ["mois", "/"] and text.runs(r"a|b") == text.runs(r"(ab)?c") == []
    rng = random.Random(17)
    parts = ["3000", "45", "320", "45000", " € ", "\xa0", "k€", " k", "/ mois", "/an", "par an", " par mois", "tjm : ", "salaire :", " € brut", "€/jour", "à partir de ", " R "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(7))) for _ in range(2000)]
    df = spark.createDataFrame([(t,) for t in [*texts, "CDD 6 mois, 3000", "2500 € / mois"]], "s string")
    for rules in (salary.V.SALARY_TEXT_F, salary.V.SALARY_TEXT_W):
        got = df.select("s", salary.first_amount(F.col("s"), rules)).collect()
        assert sum(v is not None for _, v in got) > 100
        for s, value in got:
            found = [(m, unit) for p, unit in rules if (m := re.search(p, s))]
            by_unit = {"month": lambda n: n, "year": lambda n: n // 12, "kyear": lambda n: n * 1000 // 12, "day": lambda n: n * 20}
            assert value == (by_unit[found[0][1]](int(found[0][0][1])) if found else None), s


def test_words_and_search_texts_of_every_sign(spark):
    """Plain words and search texts come out as by the plain patterns, for every sign of the basic plane and beside it."""
    signs = spark.range(1, 0xD800).selectExpr("decode(unhex(lpad(hex(id), 4, '0')), 'UTF-16BE') AS c")
    df = signs.selectExpr("explode(array('r' || c || 'sql', 'sql' || c, c || 'sql x', c || 'r sqls')) AS s")
    lower = F.lower("s")
    for body in ("r", "sql"):
        assert df.filter(text.holds(lower, body) != lower.rlike(text.whole_words(body))).count() == 0
    cleaned = text.search_text([F.col("s")], F.array().cast("array<string>"))
    assert df.filter(cleaned != F.regexp_replace(lower, text.unicode(rf"[^a-z{text.WORD}\s]"), " ")).count() == 0
