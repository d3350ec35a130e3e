"""Table contracts: the six source tables, their keys, defaults and rules.

Types follow the relational definition: ``VARCHAR`` -> string, ``SMALLINT``
-> short, ``INTEGER`` -> int, ``DECIMAL(10,2)`` -> decimal(10,2), ``DATE`` ->
date, ``SERIAL`` -> long, ``TIMESTAMP`` (no time zone) -> timestamp_ntz.
Every fact carries ``client_id``, so each reduces to one row per client and
the per-client results join on that one key.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)


def _f(name: str, dtype: T.DataType, nullable: bool = True) -> T.StructField:
    return T.StructField(name, dtype, nullable)


@dataclass(frozen=True)
class TableContract:
    name: str
    schema: T.StructType
    primary_key: str
    not_null: tuple[str, ...] = ()
    # column -> SQL default literal (None = CURRENT_TIMESTAMP)
    defaults: dict[str, object] = field(default_factory=dict)
    # column -> (parent table, parent key)
    foreign_keys: dict[str, tuple[str, str]] = field(default_factory=dict)
    # column -> declared VARCHAR length
    max_length: dict[str, int] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]


# --- fixed values: tables, columns, types, keys, defaults and lengths ------
# Keys are typed by the caller's data: the published tables declare string ids,
# the driver test tables carry bigint ids.  ``key_type`` picks one.
def contracts(key_type: T.DataType = T.StringType()) -> dict[str, TableContract]:
    clients = TableContract(
        "clients",
        T.StructType([
            _f("client_id", key_type, False),
            _f("date_inscription", T.DateType(), False),
            _f("genre", T.StringType()),
            _f("senior_citizen", T.ShortType()),
            _f("partenaire", T.StringType()),
            _f("personnes_a_charge", T.StringType()),
            _f("canal_acquisition", T.StringType()),
            _f("region", T.StringType()),
            _f("created_at", T.TimestampNTZType()),
        ]),
        primary_key="client_id",
        not_null=("client_id", "date_inscription"),
        defaults={"senior_citizen": 0, "created_at": None},
        max_length={"client_id": 20, "genre": 10, "partenaire": 3, "personnes_a_charge": 3,
                    "canal_acquisition": 30, "region": 50},
    )
    produits = TableContract(
        "produits",
        T.StructType([
            _f("produit_id", key_type, False),
            _f("nom", T.StringType()),
            _f("categorie", T.StringType()),
            _f("tarif_base", MONEY),
        ]),
        primary_key="produit_id",
        not_null=("produit_id",),
        max_length={"produit_id": 10, "nom": 100, "categorie": 20},
    )
    abonnements = TableContract(
        "abonnements",
        T.StructType([
            _f("abonnement_id", T.LongType(), False),
            _f("client_id", key_type),
            _f("produit_id", key_type),
            _f("date_debut", T.DateType(), False),
            _f("date_fin", T.DateType()),
            _f("tarif_mensuel", MONEY),
            _f("type_contrat", T.StringType()),
            _f("facturation_sans_papier", T.StringType()),
            _f("mode_paiement", T.StringType()),
            _f("statut", T.StringType()),
            _f("created_at", T.TimestampNTZType()),
        ]),
        primary_key="abonnement_id",
        not_null=("abonnement_id", "date_debut"),
        defaults={"statut": "actif", "created_at": None},
        foreign_keys={"client_id": ("clients", "client_id"), "produit_id": ("produits", "produit_id")},
        max_length={"client_id": 20, "produit_id": 10, "type_contrat": 20,
                    "facturation_sans_papier": 3, "mode_paiement": 40, "statut": 20},
    )
    facturation = TableContract(
        "facturation",
        T.StructType([
            _f("facture_id", T.LongType(), False),
            _f("client_id", key_type),
            _f("date_facture", T.DateType(), False),
            _f("montant", MONEY),
            _f("paye_a_temps", T.ShortType()),
            _f("date_paiement", T.DateType()),
            _f("created_at", T.TimestampNTZType()),
        ]),
        primary_key="facture_id",
        not_null=("facture_id", "date_facture"),
        defaults={"created_at": None},
        foreign_keys={"client_id": ("clients", "client_id")},
        max_length={"client_id": 20},
    )
    interactions = TableContract(
        "interactions_support",
        T.StructType([
            _f("interaction_id", T.LongType(), False),
            _f("client_id", key_type),
            _f("date_interaction", T.DateType(), False),
            _f("type_interaction", T.StringType()),
            _f("theme", T.StringType()),
            _f("resolution_satisfaisante", T.ShortType()),
            _f("created_at", T.TimestampNTZType()),
        ]),
        primary_key="interaction_id",
        not_null=("interaction_id", "date_interaction"),
        defaults={"created_at": None},
        foreign_keys={"client_id": ("clients", "client_id")},
        max_length={"client_id": 20, "type_interaction": 20, "theme": 50},
    )
    usage = TableContract(
        "usage_mensuel",
        T.StructType([
            _f("usage_id", T.LongType(), False),
            _f("client_id", key_type),
            _f("mois", T.DateType(), False),
            _f("nb_connexions", T.IntegerType()),
            _f("volume_data_go", MONEY),
            _f("duree_appels_min", T.IntegerType()),
            _f("created_at", T.TimestampNTZType()),
        ]),
        primary_key="usage_id",
        not_null=("usage_id", "mois"),
        defaults={"nb_connexions": 0, "volume_data_go": 0, "duree_appels_min": 0, "created_at": None},
        foreign_keys={"client_id": ("clients", "client_id")},
        max_length={"client_id": 20},
    )
    return {c.name: c for c in (clients, produits, abonnements, facturation, interactions, usage)}


TABLES = ("clients", "produits", "abonnements", "facturation", "interactions_support", "usage_mensuel")

# --- fixed values: allowed value sets as found in the reference data -------
# (the DDL comments say Oui/Non, the generated data holds Yes/No; domain
# checks take the set as an argument, these are the defaults)
DOMAINS: dict[tuple[str, str], tuple] = {
    ("clients", "genre"): ("Male", "Female"),
    ("clients", "senior_citizen"): (0, 1),
    ("clients", "partenaire"): ("Yes", "No"),
    ("clients", "personnes_a_charge"): ("Yes", "No"),
    ("clients", "canal_acquisition"): ("Web", "Télévente", "Magasin", "Partenariat"),
    ("clients", "region"): ("Île-de-France", "Provence", "Nord", "Occitanie", "Bretagne",
                            "Auvergne-Rhône-Alpes"),
    ("produits", "categorie"): ("Internet", "Mobile", "Bundle"),
    ("abonnements", "type_contrat"): ("Mensuel", "1_an", "2_ans"),
    ("abonnements", "facturation_sans_papier"): ("Yes", "No"),
    ("abonnements", "mode_paiement"): ("CB", "Virement", "Prélèvement", "Chèque"),
    ("abonnements", "statut"): ("actif", "résilié"),
    ("facturation", "paye_a_temps"): (0, 1),
    ("interactions_support", "type_interaction"): ("appel", "ticket", "chat"),
    ("interactions_support", "theme"): ("technique", "facturation", "résiliation"),
    ("interactions_support", "resolution_satisfaisante"): (0, 1),
}

# --- fixed values: status / theme literals the feature query compares to --
STATUS_ACTIVE = "actif"
STATUS_CANCELLED = "résilié"
THEME_CANCELLATION = "résiliation"

# --- fixed values: output column lists -------------------------------------
# SQL profile (24 columns, in query order)
FEATURE_COLUMNS = (
    "client_id", "date_inscription", "genre", "senior_citizen", "partenaire", "personnes_a_charge",
    "canal_acquisition", "region", "tenure_mois", "type_contrat", "charges_mensuelles",
    "categorie_produit", "nb_factures", "total_charges", "nb_retards_paiement",
    "ratio_retards_paiement", "nb_interactions_support", "nb_contacts_resiliation",
    "taux_resolution_support", "total_connexions_12_mois", "connexions_moy_3derniers_mois",
    "connexions_moy_3mois_avant", "evolution_connexions_ratio", "churn",
)
# export profile (25 columns, in export order)
EXPORT_COLUMNS = (
    "client_id", "date_inscription", "genre", "senior_citizen", "partenaire", "personnes_a_charge",
    "canal_acquisition", "region", "tenure_mois", "type_contrat", "charges_mensuelles", "categorie_produit",
    "nb_factures", "total_charges", "nb_retards_paiement", "ratio_retards_paiement",
    "nb_interactions_support", "nb_contacts_resiliation", "taux_resolution_support",
    "total_connexions_12_mois", "connexions_moy_3derniers_mois", "connexions_moy_3mois_avant",
    "total_volume_go_12_mois", "evolution_connexions_ratio", "churn",
)
# model frame: target and the columns left out of the feature vector
TARGET = "churn"
NON_FEATURE_COLUMNS = ("churn", "client_id", "date_inscription")


def export_schema(key_type: T.DataType = T.StringType()) -> T.StructType:
    """Types of the 25-column export, for reading an exported CSV back without inference."""
    types = {
        "client_id": key_type, "date_inscription": T.DateType(), "senior_citizen": T.ShortType(),
        "tenure_mois": T.IntegerType(), "charges_mensuelles": MONEY, "nb_factures": T.LongType(),
        "total_charges": T.DecimalType(20, 2), "nb_retards_paiement": T.LongType(),
        "ratio_retards_paiement": T.DoubleType(), "nb_interactions_support": T.LongType(),
        "nb_contacts_resiliation": T.LongType(), "taux_resolution_support": T.DoubleType(),
        "total_connexions_12_mois": T.LongType(), "connexions_moy_3derniers_mois": T.DoubleType(),
        "connexions_moy_3mois_avant": T.DoubleType(), "total_volume_go_12_mois": T.DecimalType(20, 2),
        "evolution_connexions_ratio": T.DoubleType(), "churn": T.IntegerType(),
    }
    return T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in EXPORT_COLUMNS])
