"""A small shop: source systems as lists of rows, written as Parquet folders."""

from __future__ import annotations

import copy

from pyspark.sql import SparkSession

from starling.schemas import SOURCES, STAGING

SHOP: dict[str, dict[str, list[tuple]]] = {
    "Fiets_Verkoop": {
        "Klant": [(1, "Jan Jansen", "Laan 1", "Delft", "M", "1990-01-01"), (2, None, "Laan 2", "Delft", "V", "1991-02-02")],
        "Fabrikant": [(1, "Maker A", "Weg 1", "Gouda")],
        "Fiets": [(1, "stad", "A", "t1", 500.0, 300.0, "rood", 1), (2, "race", "A", "t2", 900.0, 600.0, "blauw", 1)],
        "Filiaal": [(1, "Noord", "Plein 1", "ZH"), (2, "Zuid", "Plein 2", "NH")],
        "Monteur": [(1, "Tom", "Delft", 19.5, 1), (2, "Els", "Gouda", 20.0, 2)],
        "Fiets_Verkoop": [
            (1, "2023-05-01", 1, 500.0, 1, 1, 1), (2, "2023-05-01", 2, 900.0, 2, 2, 2),
            (3, "bad", 1, 500.0, 1, 1, 1),       # no date: rejected
            (4, "2023-06-01", 1, 500.0, 1, 1, 99),  # unknown worker: dropped before counting
            (5, "2023-06-02", 1, 500.0, 1, 77, 1),  # unknown product: rejected
        ],
    },
    "Accessoire_Verkoop": {
        "Klant": [(1, "Jan Jansen", "Laan 1", "Delft", "M", "1990-01-01"), (3, "Piet", "Laan 3", "Delft", "M", None)],
        "Leverancier": [(1, "Lev A", "Kade 1", "Delft")],
        "Accessoire": [(1, "Bel", 10.0, 5.0, "bel", 1)],
        "Filiaal": [(1, "Noord", "Plein 1", "ZH")],
        "Monteur": [(1, "Tom", "Delft", 19.5, 1)],
        "Accessoire_Verkoop": [(1, "2023-05-01 10:30:00", 3, 10.0, 1, 1, 1), (2, "2023-07-01", 1, 10.0, 3, 1, 1)],
    },
    "Onderhoud": {
        "Fabrikant": [(1, "Maker A", "Weg 1", "Gouda")],
        "Filiaal": [(1, "Noord", "Plein 1", "ZH")],
        "Fiets": [(1, "stad", "A", "t1", 500.0, 300.0, "rood", 1), (9, "oud", "B", "t9", 1.0, 1.0, "grijs", 1)],
        "Monteur": [(1, "Tom", "Delft", 19.5, 1)],
        "Onderhoud": [(1, "2023-05-02", "09:00", "10:30", 1, 1), (2, "2023-05-03", "09:00:00", "09:15:00", 9, 1)],
    },
    "Accessoire_Inkoop": {
        "Leverancier": [(1, "Lev A", "Kade 1", "Delft")],
        "Accessoire": [(1, "Bel", 10.0, 5.0, "bel", 1)],
        "Accessoire_Inkoop": [(1, 1, 2023, 10, 1), (2, 2, 2023, 5, 1)],
    },
    "Fiets_Inkoop": {
        "Fabrikant": [(1, "Maker A", "Weg 1", "Gouda")],
        "Fiets": [(1, "stad", "A", "t1", 500.0, 300.0, "rood", 1)],
        "Fiets_Inkoop": [(1, 1, 2023, 4, 1)],
    },
}


def shop() -> dict[str, dict[str, list[tuple]]]:
    return copy.deepcopy(SHOP)


def write_shop(spark: SparkSession, data: dict, root: str) -> dict[str, str]:
    folders = {}
    for source, tables in SOURCES.items():
        if source not in data:
            continue
        folders[source] = f"{root}/{source}"
        for name, target in tables:
            if name in data[source]:
                frame = spark.createDataFrame(data[source][name], STAGING[target])
                frame.coalesce(1).write.mode("overwrite").parquet(f"{folders[source]}/{name}.parquet")
    return folders
