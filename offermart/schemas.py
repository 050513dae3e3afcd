"""One explicit schema per layer; nothing is inferred."""

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "boolean": T.BooleanType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(5,2)": T.DecimalType(5, 2),
    "decimal(3,1)": T.DecimalType(3, 1),
    "array<string>": T.ArrayType(T.StringType()),
}


def fields(text: str, **nested: T.DataType) -> T.StructType:
    """Schema of ``name type`` pairs; works before a session exists. Types not listed above come by name."""
    pairs = [p.split() for p in text.split(", ")]
    return T.StructType([T.StructField(name, nested.get(name) or _TYPES[kind]) for name, kind in pairs])


RAW_A = fields(
    "id string, title string, description string, company struct, location struct, salary_min double, "
    "salary_max double, redirect_url string, created string",
    company=fields("display_name string"),
    location=fields("display_name string"),
)

RAW_F = fields(
    "id string, intitule string, description string, entreprise struct, lieuTravail struct, salaire struct, "
    "competences array, typeContrat string, dateCreation string, origineOffre struct",
    entreprise=fields("nom string"),
    lieuTravail=fields("libelle string"),
    salaire=fields("libelle string"),
    competences=T.ArrayType(fields("libelle string")),
    origineOffre=fields("urlOrigine string"),
)

PAGE = fields("page_id long, url string, html string")

BRONZE = fields(
    "id string, titre string, entreprise string, lieu string, description string, description_snippet string, "
    "competences array<string>, salaire_min int, salaire_max int, devise_salaire string, type_contrat string, "
    "niveau_experience string, date_publication string, url string, source string, date_scraping string, "
    "statut string, query_recherche string"
)

SILVER = fields(
    "id string, titre_original string, titre_clean string, entreprise string, lieu_original string, ville string, "
    "description_clean string, description_length int, type_contrat_original string, type_contrat string, "
    "salaire_mensuel int, date_publication timestamp_ntz, date_scraping timestamp_ntz, date_nettoyage timestamp_ntz, "
    "annee int, mois int, jour int, source string, query_recherche string, url string"
)

GOLD = T.StructType(
    SILVER.fields
    + fields(
        "competences array<string>, nb_competences int, score_qualite int, score_qualite_pct double, "
        "recherche_text string"
    ).fields
)

# Star schema
ENTREPRISES = fields("id_entreprise int, nom string")
COMPETENCES = fields("id_competence int, nom string")
OFFRES = fields(
    "id_offre string, id_entreprise int, source string, titre_original string, titre_clean string, ville string, "
    "lieu_original string, type_contrat string, type_contrat_original string, salaire_mensuel int, "
    "description_clean string, description_length int, score_qualite int, score_qualite_pct decimal(5,2), "
    "recherche_text string, date_publication timestamp_ntz, date_scraping timestamp_ntz, date_nettoyage timestamp_ntz, "
    "annee int, mois int, jour int, url string, query_recherche string"
)
OFFRE_COMPETENCE = fields("id_offre string, id_competence int")

# Greatest text lengths the warehouse accepts (columns not named here are unbounded text).
MAX_LENGTHS = {
    "id_offre": 255,
    "source": 50,
    "ville": 255,
    "lieu_original": 500,
    "type_contrat": 50,
    "type_contrat_original": 100,
    "query_recherche": 255,
}
MAX_COMPANY_LENGTH = 200
MAX_SKILL_LENGTH = 100

# Candidate side
CANDIDATS = fields("id_utilisateur long, ville_souhaitee string, contrat_souhaite string")
COMPETENCES_UTILISATEUR = fields(
    "id_utilisateur long, nom_competence string, niveau string, annee_experience decimal(3,1), "
    "source_detection string, date_ajout timestamp_ntz"
)
RECOMMANDATIONS = fields(
    "id_utilisateur long, id_offre string, source string, score_recommandation decimal(5,2), "
    "date_recommandation timestamp_ntz, est_consulte boolean, est_sauvegarde boolean"
)
ALERTES = fields(
    "id_alerte int, id_utilisateur long, nom_alerte string, type_alerte string, valeur_alerte string, "
    "est_active boolean, frequence string, derniere_envoi timestamp_ntz, prochain_envoi timestamp_ntz, created_at timestamp_ntz"
)
HISTORIQUE_RECHERCHES = fields(
    "id_recherche int, id_utilisateur long, mots_cles string, filtres string, nombre_resultats int, "
    "date_recherche timestamp_ntz"
)

RATINGS = fields("user_id int, offre_id int, score float")
