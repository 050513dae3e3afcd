"""Offers, candidates and their skills derived from the given tables, the same way in Spark and in DuckDB.

The given text is invented prose without job words, so the job offers are derived from every row of ``orders`` (and
the candidates from every row of ``customer``). Each column is one SQL expression that both engines read alike.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offermart.session import shared_dir

RUN_AT = dt.datetime(2024, 2, 1, 6, 0, 0)

_TEXT = """
'Poste' || CASE o_custkey % 6 WHEN 0 THEN ' confirmé.' WHEN 1 THEN ' débutant.' WHEN 2 THEN ' senior, 5+ ans.'
  WHEN 3 THEN ' de manager.' WHEN 4 THEN ' sans expérience.' ELSE '.' END
|| CASE o_orderkey % 8 WHEN 1 THEN ' Contrat permanent' WHEN 2 THEN ' en freelance' WHEN 3 THEN ' stage de fin'
  WHEN 4 THEN ' CDD 6 mois' ELSE '' END
|| CASE WHEN o_orderkey % 2 = 0 THEN ' Python, SQL.' ELSE '' END
|| CASE WHEN o_orderkey % 5 = 0 THEN ' Spark/Kafka et Power BI' ELSE '' END
|| CASE WHEN o_custkey % 7 = 0 THEN ' Scikit-learn + CI/CD + R' ELSE '' END
|| CASE WHEN o_custkey % 9 = 0 THEN ' Données NoSQL MongoDB, AWS' ELSE '' END
|| CASE WHEN o_orderkey % 6 = 0 THEN ' Salaire : ' || CAST(2000 + o_custkey % 3000 AS STRING) || ' € / mois'
  WHEN o_orderkey % 6 = 1 THEN ' ' || CAST(30 + o_custkey % 60 AS STRING) || ' k€ brut'
  WHEN o_orderkey % 6 = 2 THEN ' TJM : ' || CAST(300 + o_custkey % 500 AS STRING)
  WHEN o_orderkey % 6 = 3 THEN ' ' || CAST(30000 + o_custkey % 50000 AS STRING) || ' € par an' ELSE '' END
|| CASE WHEN o_orderkey % 4 = 0 THEN repeat(' mission longue', 40) ELSE '' END
"""
_ID = (
    "'o_' || CAST(CASE WHEN o_orderkey % 25 = 7 THEN o_orderkey - 7 WHEN o_orderkey % 25 = 9 THEN o_orderkey - 9 "
    "ELSE o_orderkey END AS STRING)"
)
_TITLE = (
    "CASE o_custkey % 5 WHEN 0 THEN 'Data Engineer (H/F)' WHEN 1 THEN 'Data Scientist senior (F/H)' "
    "WHEN 2 THEN 'data analyst junior - (H/F)' WHEN 3 THEN 'ML Engineer (CDI)' ELSE 'Data Architect 45 k€' END"
)
_DATE = "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderdate AS STRING) END"

OFFERS: dict[str, str] = {
    "id": _ID,
    "titre": _TITLE,
    "entreprise": "CASE WHEN o_custkey % 11 <> 0 THEN c_name || CASE o_custkey % 4 WHEN 0 THEN ' SAS' "
    "WHEN 1 THEN ' (Groupe)' ELSE '' END END",
    "lieu": "CASE WHEN o_custkey % 13 = 0 THEN 'France' WHEN o_custkey % 13 = 1 THEN 'Télétravail' "
    "WHEN o_custkey % 13 = 2 THEN '75 - ' || n_name ELSE n_name || ' 75001, ' || r_name END",
    "description": f"CASE WHEN o_orderkey % 17 = 3 THEN '' ELSE {_TEXT} END",
    "description_snippet": f"substr({_TEXT}, 1, 300)",
    "salaire_min": "CASE WHEN o_orderkey % 10 < 4 THEN CAST(FLOOR(o_totalprice / 10) AS INT) END",
    "salaire_max": "CASE WHEN o_orderkey % 10 IN (3, 4, 5) THEN CAST(FLOOR(o_totalprice / 8) AS INT) END",
    "type_contrat": "CASE WHEN o_orderpriority LIKE '1%' THEN 'CDI' WHEN o_orderpriority LIKE '2%' THEN 'cdd' "
    "WHEN o_orderpriority LIKE '3%' THEN 'MIS' WHEN o_orderpriority LIKE '4%' THEN 'APPRENTISSAGE' ELSE '' END",
    "date_publication": _DATE,
    "url": f"'https://x/' || {_ID}",
    "source": "CASE o_orderkey % 3 WHEN 0 THEN 'adzuna' WHEN 1 THEN 'france_travail' ELSE 'welcometothejungle' END",
    "date_scraping": _DATE,
    "query_recherche": "CASE o_custkey % 5 WHEN 0 THEN 'Data Engineer' WHEN 1 THEN 'Data Scientist' ELSE 'Data' END",
    # Input order: sources are loaded one after the other.
    "ord": "CAST(o_orderkey % 3 AS BIGINT) * 1000000000000 + o_orderkey",
}

CANDIDATES: dict[str, str] = {
    "id_utilisateur": "c_custkey",
    "ville_souhaitee": "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE n_name END",
    "contrat_souhaite": "CASE c_custkey % 3 WHEN 0 THEN 'CDD' WHEN 1 THEN NULL ELSE 'CDI' END",
}

# Every tenth customer has no skills.
CANDIDATE_SKILLS = """
SELECT c_custkey AS id_utilisateur, v.nom AS nom_competence,
       CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CAST((c_custkey % 9) + v.k AS DOUBLE) / 2 END AS annee_experience
FROM {customer} JOIN (VALUES (0,'python'),(1,'sql'),(2,'spark'),(3,'kafka'),(4,'powerbi'),(5,'scikit-learn'))
     AS v(k, nom) ON (c_custkey + v.k) % 3 = 0
WHERE c_custkey % 10 <> 0
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt by the hash of ``key``: a given table may be one file, whose rows would all be worked on by one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def _places(spark: SparkSession, sf_dir: str, customers: DataFrame) -> DataFrame:
    """Customers with the names of nation (25 rows) and region (5 rows), whose sizes never grow."""
    nation = F.broadcast(table(spark, sf_dir, "nation"))
    region = F.broadcast(table(spark, sf_dir, "region"))
    return customers.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _places(spark, sf_dir, table(spark, sf_dir, "customer"))
    return table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))


def offers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spread(_orders(spark, sf_dir), "o_orderkey")
    return rows.select(*[F.expr(sql).alias(name) for name, sql in OFFERS.items()])


def offers_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same offers sorted by ``ord``: the short rows of the order are sorted, the texts are made afterwards."""
    rows = _orders(spark, sf_dir).orderBy(F.expr(OFFERS["ord"]))
    return rows.select(*[F.expr(sql).alias(name) for name, sql in OFFERS.items()])


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _places(spark, sf_dir, table(spark, sf_dir, "customer"))
    return rows.select(*[F.expr(sql).alias(name) for name, sql in CANDIDATES.items()])


def candidate_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(CANDIDATE_SKILLS, customer=table(spark, sf_dir, "customer"))


def _select(columns: dict[str, str]) -> str:
    return "SELECT " + ",\n ".join(f"{sql} AS {name}" for name, sql in columns.items())


OFFERS_CTE = (
    f"offers_raw AS ({_select(OFFERS)}\nFROM orders JOIN customer ON o_custkey = c_custkey "
    "JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"
)
CANDIDATES_CTE = (
    f"candidates AS ({_select(CANDIDATES)}\nFROM customer JOIN nation ON c_nationkey = n_nationkey),\n"
    f"candidate_skills AS ({CANDIDATE_SKILLS.replace('{customer}', 'customer')})"
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL that must give the same rows."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return fn

    return register


_STORED: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """Path of a table that is written once per application, in the shared folder, and read by later queries."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        path = f"{shared_dir(spark)}/offermart-{key[0]}-{uuid.uuid4().hex[:8]}/{name}"
        write(path)
        _STORED[key] = path
    return _STORED[key]
