"""Column layouts of the staging tables, the star tables and the source systems."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(ddl: str) -> T.StructType:
    return T.StructType([
        T.StructField(name, {"long": T.LongType(), "double": T.DoubleType(), "string": T.StringType(),
                             "timestamp": T.TimestampType()}[kind])
        for name, kind in (item.split() for item in ddl.split(","))
    ])


# fixed values: table layouts
KLANT = "klantnr long, naam string, adres string, woonplaats string, geslacht string, geboortedatum string"
LEVERANCIER = "leveranciernr long, naam string, adres string, woonplaats string"
FABRIKANT = "fabrikantnr long, naam string, adres string, plaats string"
ACCESSOIRE = "accessoirenr long, naam string, standaardprijs double, inkoopprijs double, soort string, leverancier long"
FIETS = (
    "fietsnr long, soort string, merk string, type string, standaardprijs double, inkoopprijs double, "
    "kleur string, fabrikant long"
)
FILIAAL = "filiaalnr long, naam string, adres string, provincie string"
MONTEUR = "monteurnr long, naam string, woonplaats string, uurloon double, filiaal long"

STAGING: dict[str, T.StructType] = {
    name: _schema(ddl)
    for name, ddl in {
        "Accessoire_Verkoop_Klant": KLANT,
        "Accessoire_Verkoop_Leverancier": LEVERANCIER,
        "Accessoire_Verkoop_Accessoire": ACCESSOIRE,
        "Accessoire_Verkoop_Filiaal": FILIAAL,
        "Accessoire_Verkoop_Monteur": MONTEUR,
        "Accessoire_Verkoop": "accessoire_verkoopnr long, datum string, aantal long, verkoopprijs double, "
        "klant long, accessoire long, monteur long",
        "Fiets_Verkoop_Klant": KLANT,
        "Fiets_Verkoop_Fabrikant": FABRIKANT,
        "Fiets_Verkoop_Fiets": FIETS,
        "Fiets_Verkoop_Filiaal": FILIAAL,
        "Fiets_Verkoop_Monteur": MONTEUR,
        "Fiets_Verkoop": "fiets_verkoopnr long, datum string, aantal long, verkoopprijs double, "
        "klant long, fiets long, monteur long",
        "Onderhoud_Fabrikant": FABRIKANT,
        "Onderhoud_Filiaal": FILIAAL,
        "Onderhoud_Fiets": FIETS,
        "Onderhoud_Monteur": MONTEUR,
        "Onderhoud": "onderhoudnr long, datum string, starttijd string, eindtijd string, fiets long, monteur long",
        "Accessoire_Inkoop_Leverancier": LEVERANCIER,
        "Accessoire_Inkoop_Accessoire": ACCESSOIRE,
        "Accessoire_Inkoop": "inkoopnr long, inkoopmaand long, inkoopjaar long, aantal long, accessoire long",
        "Fiets_Inkoop_Fabrikant": FABRIKANT,
        "Fiets_Inkoop_Fiets": FIETS,
        "Fiets_Inkoop": "inkoopnr long, inkoopmaand long, inkoopjaar long, aantal long, fiets long",
    }.items()
}

# fixed values: source system -> (source table, staging table), parents before children
SOURCES: dict[str, list[tuple[str, str]]] = {
    "Onderhoud": [
        ("Fabrikant", "Onderhoud_Fabrikant"), ("Filiaal", "Onderhoud_Filiaal"), ("Fiets", "Onderhoud_Fiets"),
        ("Monteur", "Onderhoud_Monteur"), ("Onderhoud", "Onderhoud"),
    ],
    "Accessoire_Inkoop": [
        ("Leverancier", "Accessoire_Inkoop_Leverancier"), ("Accessoire", "Accessoire_Inkoop_Accessoire"),
        ("Accessoire_Inkoop", "Accessoire_Inkoop"),
    ],
    "Fiets_Inkoop": [
        ("Fabrikant", "Fiets_Inkoop_Fabrikant"), ("Fiets", "Fiets_Inkoop_Fiets"), ("Fiets_Inkoop", "Fiets_Inkoop"),
    ],
    "Accessoire_Verkoop": [
        ("Klant", "Accessoire_Verkoop_Klant"), ("Leverancier", "Accessoire_Verkoop_Leverancier"),
        ("Accessoire", "Accessoire_Verkoop_Accessoire"), ("Filiaal", "Accessoire_Verkoop_Filiaal"),
        ("Monteur", "Accessoire_Verkoop_Monteur"), ("Accessoire_Verkoop", "Accessoire_Verkoop"),
    ],
    "Fiets_Verkoop": [
        ("Klant", "Fiets_Verkoop_Klant"), ("Fabrikant", "Fiets_Verkoop_Fabrikant"), ("Fiets", "Fiets_Verkoop_Fiets"),
        ("Filiaal", "Fiets_Verkoop_Filiaal"), ("Monteur", "Fiets_Verkoop_Monteur"), ("Fiets_Verkoop", "Fiets_Verkoop"),
    ],
}

# fixed values: shared staging table -> (key, source systems in order of precedence)
UNIFIED_SOURCES: dict[str, tuple[str, list[str]]] = {
    "Filiaal": ("filiaalnr", ["Accessoire_Verkoop", "Fiets_Verkoop", "Onderhoud"]),
    "Klant": ("klantnr", ["Accessoire_Verkoop", "Fiets_Verkoop"]),
    "Leverancier": ("leveranciernr", ["Accessoire_Verkoop"]),
    "Fabrikant": ("fabrikantnr", ["Fiets_Verkoop", "Onderhoud"]),
    "Monteur": ("monteurnr", ["Accessoire_Verkoop", "Fiets_Verkoop", "Onderhoud"]),
    "Accessoire": ("accessoirenr", ["Accessoire_Verkoop"]),
    "Fiets": ("fietsnr", ["Fiets_Verkoop", "Onderhoud"]),
    "Accessoire_Verkoop": ("accessoire_verkoopnr", ["Accessoire_Verkoop"]),
    "Fiets_Verkoop": ("fiets_verkoopnr", ["Fiets_Verkoop"]),
    "Accessoire_Inkoop": ("inkoopnr", ["Accessoire_Inkoop"]),
    "Fiets_Inkoop": ("inkoopnr", ["Fiets_Inkoop"]),
    "Onderhoud": ("onderhoudnr", ["Onderhoud"]),
}

UNIFIED: dict[str, T.StructType] = {
    name: STAGING[dict(SOURCES[systems[0]])[name]] for name, (_, systems) in UNIFIED_SOURCES.items()
}

STAR: dict[str, T.StructType] = {
    name: _schema(ddl)
    for name, ddl in {
        "Klant": "klant_key long, business_key string, source_id long, klantnr long, naam string, woonplaats string, "
        "adres string, geslacht string, geboortedatum string",
        "Product": "product_key long, business_key string, productnr long, product_type string, soort string, "
        "merk string, type string, kleur string, fabrikant string",
        "Leverancier": "lev_key long, business_key string, leveranciernr long, naam string, adres string, "
        "woonplaats string",
        "Monteur": "monteur_key long, business_key string, monteurnr long, naam string, woonplaats string, "
        "uurloon double, begin_tijd timestamp, eind_tijd timestamp",
        "Filiaal": "filiaal_key long, business_key string, filiaalnr long, naam string, adres string, "
        "provincie string, begin_tijd timestamp, eind_tijd timestamp",
        "Datum": "datum_key long, datum string, dag long, maand long, kwartaal long, jaar long",
        "InkoopPeriode": "periode_key long, inkoopmaand long, inkoopjaar long",
        "Verkoop": "verkoop_key long, source_id long, verkoopnr long, klant_key long, monteur_key long, "
        "product_key long, filiaal_key long, datum_key long, verkoopprijs double, aantal long",
        "Onderhoud": "onderhoud_key long, onderhoudnr long, product_key long, monteur_key long, filiaal_key long, "
        "datum string, starttijd string, eindtijd string, uurloon double",
        "Inkoop": "inkoop_key long, source_id long, inkoopnr long, product_key long, periode_key long, lev_key long, "
        "aantal long, inkoopprijs double",
    }.items()
}

# facts by bands of the number that identifies a row: an increment reads only the bands of its own numbers, and a
# corrected date, which a folder by month would lose sight of, still meets the row it belongs to
STAR_BANDS: dict[str, tuple[str, int]] = {
    "Verkoop": ("verkoopnr", 10_000_000), "Onderhoud": ("onderhoudnr", 10_000_000), "Inkoop": ("inkoopnr", 10_000_000),
}
