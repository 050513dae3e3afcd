"""Word lists, lookup tables and patterns that results depend on. No logic here."""

NON_SPECIFIE = "Non spécifié"

A = "adzuna"
F = "france_travail"
W = "welcometothejungle"
SOURCES = (A, F, W)
ID_PREFIX = {A: "adzuna_", F: "ft_", W: "jungle_"}

# ---------------------------------------------------------------------------------------------------------------
# Skills: display name -> pattern of the whole word, searched in lower-cased text
# ---------------------------------------------------------------------------------------------------------------
SKILLS_ETL_A = {
    "Python": "python",
    "Java": "java",
    "Scala": "scala",
    "SQL": "sql",
    "NoSQL": "nosql",
    "Spark": "spark",
    "Hadoop": "hadoop",
    "Kafka": "kafka",
    "Airflow": "airflow",
    "TensorFlow": "tensorflow",
    "PyTorch": "pytorch",
    "Scikit-learn": r"scikit[-\s]?learn",
    "Tableau": "tableau",
    "Power BI": r"power\s*bi",
    "AWS": "aws",
    "Azure": "azure",
    "GCP": "gcp",
    "Docker": "docker",
    "Kubernetes": "kubernetes",
    "Git": "git",
    "PostgreSQL": "postgresql",
    "MySQL": "mysql",
    "MongoDB": "mongodb",
}

SKILLS_ETL_FW = {
    "Python": "python",
    "SQL": "sql",
    "Spark": "spark",
    "AWS": "aws",
    "Azure": "azure",
    "GCP": "gcp",
    "Docker": "docker",
    "Kubernetes": "kubernetes",
    "TensorFlow": "tensorflow",
    "PyTorch": "pytorch",
    "Scikit-learn": "scikit-?learn",
    "Pandas": "pandas",
    "NumPy": "numpy",
    "Power BI": r"power\s*bi",
    "Tableau": "tableau",
    "Airflow": "airflow",
    "Kafka": "kafka",
    "Hadoop": "hadoop",
    "Java": "java",
    "Scala": "scala",
    "R": "r",
    "Git": "git",
    "CI/CD": "ci/?cd",
}

SKILLS_COLLECTOR = {
    **SKILLS_ETL_A,
    "R": "r",
    "Flink": "flink",
    "XGBoost": "xgboost",
    "LightGBM": "lightgbm",
    "Looker": "looker",
    "Qlik": "qlik",
    "Superset": "superset",
    "Databricks": "databricks",
    "Snowflake": "snowflake",
    "BigQuery": "bigquery",
    "Terraform": "terraform",
    "Elasticsearch": "elasticsearch",
    "dbt": "dbt",
    "MLflow": "mlflow",
    "FastAPI": "fastapi",
}

# Plain substrings, not whole words.
SKILLS_COLLECTOR_A = [name for name in SKILLS_COLLECTOR if name not in ("dbt", "MLflow", "FastAPI")]

SKILLS_CV = [
    "python", "sql", "spark", "airflow", "docker", "kubernetes", "aws", "azure", "tensorflow", "pytorch", "pandas",
    "numpy", "kafka", "flink", "scala", "java", "databricks", "dbt", "looker", "gcp", "hadoop", "scikit-learn",
    "powerbi", "tableau", "mongodb", "postgresql", "mysql", "redis",
]

# ---------------------------------------------------------------------------------------------------------------
# Contracts: upper-case key -> label
# ---------------------------------------------------------------------------------------------------------------
CONTRACTS_A = {
    "CDI": "CDI", "CDD": "CDD", "FREELANCE": "Freelance", "STAGE": "Stage", "ALTERNANCE": "Alternance",
    "INTERIM": "Intérim",
}
CONTRACTS_F = {
    "CDI": "CDI", "CDD": "CDD", "INTERIM": "Intérim", "MIS": "Intérim", "FREELANCE": "Freelance",
    "LIB": "Freelance", "STAGE": "Stage", "ALTERNANCE": "Alternance", "APPRENTISSAGE": "Alternance",
}
CONTRACTS_W = {
    "CDI": "CDI", "CDD": "CDD", "STAGE": "Stage", "ALTERNANCE": "Alternance", "APPRENTISSAGE": "Alternance",
    "FREELANCE": "Freelance", "INTERIM": "Intérim", "VIE": "VIE",
}
# Labels the F collector already emits; the F table above does not know them.
CONTRACTS_F_EMITTED = {"INTÉRIM": "Intérim", "SAISONNIER": "Saisonnier"}
CONTRACT_CODES_F = {
    "CDI": "CDI", "CDD": "CDD", "MIS": "Intérim", "SAI": "Saisonnier", "LIB": "Freelance", "CCE": "Freelance",
}
# Ordered; first hit wins.
CONTRACT_TEXT_A = [
    ("CDI", r"\bCDI\b|\bpermanent\b"),
    ("CDD", r"\bCDD\b|\bcontract\b"),
    ("Freelance", r"\bfreelance\b|\bindépendant\b"),
    ("Stage", r"\bstage\b|\balternance\b|\binternship\b"),
]
CONTRACT_CARD_W = ["CDI", "CDD", "Freelance", "Stage", "Alternance", "Intérim", "VIE"]

# ---------------------------------------------------------------------------------------------------------------
# Experience: ordered levels, whole words, any case
# ---------------------------------------------------------------------------------------------------------------
EXPERIENCE_A = [
    ("Entry", r"\bjunior\b|\bdébutant\b|\bentry\b"),
    ("Mid", r"\bconfirmé\b|\b2[-–]5 ans\b|\bmid\b"),
    ("Senior", r"\bsenior\b|\b5\+\s*ans\b"),
    ("Lead", r"\blead\b|\bmanager\b|\bprincipal\b"),
]
EXPERIENCE_F = [
    ("Entry", r"\bjunior\b|\bdébutant\b|\bentry\b|\bsans expérience\b"),
    ("Mid", r"\bconfirmé\b|\b2[-–]5 ans\b|\bmid\b|\b2 ans\b|\b3 ans\b"),
    ("Senior", r"\bsenior\b|\b5\+\s*ans\b|\bexpérimenté\b"),
    ("Lead", r"\blead\b|\bmanager\b|\bprincipal\b|\bresponsable\b"),
]
EXPERIENCE_W = [
    ("Entry", r"\bjunior\b|\bdébutant\b|\bentry\b|\bsans expérience\b|\b0[-–]2 ans\b"),
    ("Mid", r"\bconfirmé\b|\b2[-–]5 ans\b|\bmid\b|\b2 ans\b|\b3 ans\b"),
    ("Senior", r"\bsenior\b|\b5\+\s*ans\b|\bexpérimenté\b|\b\+5 ans\b"),
    ("Lead", r"\blead\b|\bmanager\b|\bprincipal\b|\bresponsable\b"),
]

# ---------------------------------------------------------------------------------------------------------------
# Salaries: ordered (pattern, unit of the number); first hit wins. A range such as "3000-4000 €/mois" is caught by
# the single-value pattern, which reads its upper end.
# ---------------------------------------------------------------------------------------------------------------
SALARY_TEXT_F = [
    (r"(\d{4,5})\s*€?\s*/\s*mois", "month"),
    (r"(\d{4,5})\s*€?\s*par\s*mois", "month"),
    (r"(\d{5,6})\s*€?\s*/\s*an", "year"),
    (r"(\d{5,6})\s*€?\s*par\s*an", "year"),
    (r"(\d{2,3})\s*k\s*€?\s*/\s*an", "kyear"),
    (r"(\d{2,3})\s*k€", "kyear"),
    (r"salaire\s*:\s*(\d{4,5})\s*€", "month"),
    (r"(\d{4,5})\s*€\s*brut\s*/\s*mois", "month"),
    (r"tjm\s*:\s*(\d{3,5})", "day"),
    (r"(\d{3,5})\s*€\s*/\s*jour", "day"),
    (r"à\s*partir\s*de\s*(\d{4,5})\s*€", "month"),
]
SALARY_TEXT_W = [
    (r"(\d{4,5})\s*€?\s*/\s*mois", "month"),
    (r"(\d{4,5})\s*€?\s*par\s*mois", "month"),
    (r"(\d{5,6})\s*€?\s*/\s*an", "year"),
    (r"(\d{5,6})\s*€?\s*par\s*an", "year"),
    (r"(\d{2,3})\s*k\s*€?\s*/\s*an", "kyear"),
    (r"(\d{2,3})\s*k€", "kyear"),
    (r"tjm\s*:\s*(\d{3,5})", "day"),
    (r"(\d{3,5})\s*€\s*/\s*jour", "day"),
    (r"salaire\s*:\s*(\d{4,5})\s*€", "month"),
    (r"(\d{4,5})\s*€\s*brut", "month"),
]
SALARY_TITLE_W = [
    (r"(\d{4,5})\s*€", "year"),
    (r"(\d{2,3})\s*k\s*€", "kyear"),
    (r"(\d{2,3})\s*k\s*/\s*an", "kyear"),
]
# Bounds printed on an offer page: (pattern, holds an upper bound)
SALARY_PAGE_W = [
    (r"(\d[\d\s]+)\s*€?\s*[-–]\s*(\d[\d\s]+)\s*€", True),
    (r"(\d+)[kK]\s*€?\s*[-–]\s*(\d+)[kK]", True),
    (r"(\d[\d\s]+)\s*€\s*/\s*an", False),
]

# ---------------------------------------------------------------------------------------------------------------
# Cleaning patterns
# ---------------------------------------------------------------------------------------------------------------
TITLE_GENDER = r"\s*\([H/Fh/f]+\)\s*$"
TITLE_GENDER_SPACED = r"\s*\([H/Fh/f\s/]+\s*\)\s*$"
TITLE_CDI = r"\s*\(CDI\)\s*$"
TITLE_DASH_GENDER = r"\s*-\s*\([H/Fh/f]+\s*\)\s*$"
TITLE_AMOUNT = r"\s*[\d.,]+\s*[kK]?\s*€\s*"
POSTCODE = r"\d{5}"
DEPARTMENT_PREFIX = r"^[0-9]{2,3}\s*-\s*"
BRACKETED_NUMBER = r"\(\d+\)"
COMPANY_BRACKETS = r"\s*\(.*?\)\s*$"
COMPANY_SAS = r"\s+S\.?A\.?S\.?$"
COMPANY_SA = r"\s+S\.?A\.?$"

# ---------------------------------------------------------------------------------------------------------------
# Saved pages
# ---------------------------------------------------------------------------------------------------------------
BASE_URL_W = "https://www.welcometothejungle.com"
LINK_LABEL_PREFIX = r"^Consultez l'offre\s*"

# ---------------------------------------------------------------------------------------------------------------
# Assistant: ordered intents and their keywords (substrings of the lower-cased message), ordered roles, answers
# ---------------------------------------------------------------------------------------------------------------
INTENTS = [
    ("salaire", ["salaire", "rémunération", "combien", "paye", "rémunéré"]),
    ("competences", ["compétence", "skill", "formation", "apprendre"]),
    ("offres", ["offre", "poste", "job", "emploi", "recrute"]),
    ("evolution", ["évolution", "carrière", "progression", "futur"]),
    ("cv", ["cv", "curriculum", "candidature", "postuler"]),
]
ROLES = ["data scientist", "data engineer", "data analyst", "ml engineer", "data architect"]

ANSWER_SALARY = (
    "Le salaire moyen pour un poste {role} est d'environ {avg}€/mois. Les offres varient entre {min}€ et {max}€."
)
ANSWER_SKILLS = (
    "🔧 **Compétences les plus demandées :**\n\n{skills}\n\nSouhaitez-vous des informations sur des formations "
    "spécifiques pour ces compétences ?"
)
ANSWER_OFFERS = (
    "📊 Il y a actuellement **{total} offres Data en France**. \n\nAccédez à la page 'Offres' pour les consulter en "
    "détail et filtrer par compétences, ville ou type de contrat."
)
ANSWER_GROWTH = (
    "📈 Le marché Data est en forte croissance (**+{growth}% cette année**). Les rôles comme **Data Engineer**, "
    "**MLOps** et **Data Scientist** sont particulièrement recherchés. Souhaitez-vous des conseils pour évoluer vers "
    "ces métiers ?"
)
ANSWER_CV = (
    "📄 Pour optimiser votre CV Data :\n\n1. Mettez en avant vos compétences techniques (Python, SQL, Spark, Cloud)\n"
    "2. Détaillez vos projets concrets avec des résultats quantifiables\n3. Mentionnez vos certifications (AWS, "
    "Databricks, etc.)\n\n**Notre IA peut analyser votre CV gratuitement !** Uploadez-le dans la section 'Mon CV'."
)
ANSWER_DEFAULT = (
    "Je suis votre assistant IA pour le marché Data. Je peux vous renseigner sur :\n\n• 💰 **Salaire** : salaires "
    "moyens par poste\n• 🔧 **Compétences** : les skills les plus demandés\n• 📊 **Offres** : nombre d'offres "
    "disponibles\n• 📈 **Évolution** : tendances du marché Data\n• 📄 **CV** : conseils pour optimiser votre CV\n\n"
    "Que souhaitez-vous savoir ?"
)

# ---------------------------------------------------------------------------------------------------------------
# Matching
# ---------------------------------------------------------------------------------------------------------------
WEIGHT_TEXT = 0.50
WEIGHT_SKILLS = 0.35
WEIGHT_FILTERS = 0.15
DEFAULT_CITY = "Paris"
DEFAULT_CONTRACT = "CDI"
