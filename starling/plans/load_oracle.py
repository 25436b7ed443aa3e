"""What two runs of the loads leave behind, as plain SQL over the sample tables."""

from __future__ import annotations

from starling.plans.oracle import BIRTH

LOADS = f"""per_order AS (
  SELECT l_orderkey, min(l_partkey) AS sold, max(l_partkey) AS bought, min(l_suppkey) AS worker,
    CAST(sum(l_quantity) AS BIGINT) AS aantal, max(l_shipdate) AS last FROM lineitem GROUP BY 1),
sources AS (
  SELECT *, coalesce(o_orderstatus = 'O', false) AS own, coalesce(o_orderdate < DATE '1998-01-01', false) AS early
  FROM orders JOIN per_order ON o_orderkey = l_orderkey),
buyers AS (
  SELECT c_custkey, c_acctbal, coalesce(c_name, 'None') || '_' || coalesce({BIRTH}, 'None') AS klant,
    coalesce(c_mktsegment, '') IN ('AUTOMOBILE','BUILDING','FURNITURE') AS in_first,
    coalesce(c_mktsegment, '') NOT IN ('AUTOMOBILE','BUILDING') AS in_second,
    CASE WHEN coalesce(c_mktsegment, '') IN ('AUTOMOBILE','BUILDING','FURNITURE') THEN 'City ' ELSE 'Town ' END
      || CAST(c_nationkey AS VARCHAR) AS woonplaats FROM customer),
workers AS (
  SELECT s_suppkey, s_name || '_' || n_name AS monteur, n_name AS filiaal, s_acctbal AS wage,
    CASE WHEN s_acctbal > 5000 THEN s_acctbal - 100 ELSE s_acctbal END AS early_wage
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
sales AS (
  SELECT CASE WHEN own THEN 1 ELSE 2 END AS source_id, o_orderkey AS verkoopnr, early,
    CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS datum_key, o_totalprice AS verkoopprijs, aantal, klant, woonplaats,
    CASE WHEN own THEN 'fiets_' ELSE 'accessoire_' END || CAST(sold AS VARCHAR) AS product, filiaal, monteur,
    round(CASE WHEN early THEN early_wage ELSE wage END, 2) AS uurloon
  FROM sources JOIN buyers ON o_custkey = c_custkey AND CASE WHEN own THEN in_first ELSE in_second END
    JOIN workers ON worker = s_suppkey JOIN part ON sold = p_partkey WHERE o_orderdate IS NOT NULL),
purchases AS (
  SELECT CASE WHEN own THEN 2 ELSE 1 END AS source_id, o_orderkey AS inkoopnr, early, aantal, p_retailprice AS inkoopprijs,
    CASE WHEN own THEN 'fiets_' ELSE 'accessoire_' END || CAST(bought AS VARCHAR) AS product,
    s_name || '_Street ' || CAST(s_nationkey AS VARCHAR) AS leverancier,
    CAST(month(last) AS BIGINT) AS inkoopmaand, CAST(year(last) AS BIGINT) AS inkoopjaar
  FROM sources JOIN part ON bought = p_partkey JOIN supplier ON p_size = s_suppkey),
visits AS (
  SELECT event_id AS onderhoudnr, coalesce(event_type <> 'error', true) AS early, strftime(ts, '%Y-%m-%d') AS datum,
    strftime(ts, '%H:%M:%S') AS starttijd, strftime(ts + to_seconds(CAST(floor(value) AS BIGINT)), '%H:%M:%S') AS eindtijd,
    'fiets_' || CAST(user_id AS VARCHAR) AS product, filiaal, monteur,
    round(CASE WHEN coalesce(event_type <> 'error', true) THEN early_wage ELSE wage END, 2) AS uurloon
  FROM events JOIN workers ON user_id = s_suppkey JOIN part ON user_id = p_partkey),
days AS (
  SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, early FROM sources WHERE o_orderdate IS NOT NULL
  UNION ALL SELECT strftime(ts, '%Y-%m-%d'), coalesce(event_type <> 'error', true) FROM events WHERE ts IS NOT NULL),
runs AS (SELECT '20240101_000000' AS run_id, true AS first UNION ALL SELECT '20240102_000000', false)"""


def _added(tabel: str, rows: str, number: str = "count(*)") -> str:
    """Counters of a table that only ever grows."""
    return f"""SELECT '{tabel}' AS tabel, (SELECT {number} FROM {rows} WHERE early) AS one, (SELECT {number} FROM {rows}) AS two,
      0 AS changed"""


def _kept(tabel: str, number: str, changed: str = "0", versions: bool = False) -> str:
    """Counters of a dimension that both runs find complete."""
    return f"SELECT '{tabel}', ({number}), ({number}) + {f'({changed})' if versions else 0}, ({changed})"


STEPS = " UNION ALL ".join([
    _added("Verkoop", "sales"), _added("Inkoop", "purchases"), _added("Onderhoud", "visits"),
    _added("Datum", "days", "count(DISTINCT day)"),
    _added("InkoopPeriode", "sources", "count(DISTINCT (year(last), month(last)))"),
    _kept("Klant", "SELECT count(DISTINCT klant) FROM buyers", "SELECT count(DISTINCT klant) FROM buyers WHERE c_acctbal > 8000"),
    _kept("Product", "SELECT 2 * count(*) FROM part"), _kept("Leverancier", "SELECT count(*) FROM supplier"),
    _kept("Monteur", "SELECT count(*) FROM workers", "SELECT count(*) FROM workers WHERE wage > 5000", versions=True),
    _kept("Filiaal", "SELECT count(*) FROM nation JOIN region ON n_regionkey = r_regionkey"),
])


def _staged(number: str, early: str | None, *targets: str) -> list[str]:
    return [f"SELECT '{t}' AS doel_tabel, ({number}) AS two, ({early or number}) AS one" for t in targets]


def _arriving(rows: str, target: str, where: str = "true") -> list[str]:
    number = f"SELECT count(*) FROM {rows} WHERE {where}"
    return _staged(number, f"{number} AND early", target)


STAGED = " UNION ALL ".join([
    *_staged("SELECT count(*) FROM buyers WHERE in_first", None, "Fiets_Verkoop_Klant"),
    *_staged("SELECT count(*) FROM buyers WHERE in_second", None, "Accessoire_Verkoop_Klant"),
    *_staged("SELECT count(*) FROM supplier", None, "Fiets_Verkoop_Fabrikant", "Onderhoud_Fabrikant", "Fiets_Inkoop_Fabrikant",
             "Accessoire_Verkoop_Leverancier", "Accessoire_Inkoop_Leverancier"),
    *_staged("SELECT count(*) FROM part", None, "Fiets_Verkoop_Fiets", "Onderhoud_Fiets", "Fiets_Inkoop_Fiets",
             "Accessoire_Verkoop_Accessoire", "Accessoire_Inkoop_Accessoire"),
    *_staged("SELECT count(*) FROM nation JOIN region ON n_regionkey = r_regionkey", None, "Fiets_Verkoop_Filiaal",
             "Accessoire_Verkoop_Filiaal", "Onderhoud_Filiaal"),
    *_staged("SELECT count(*) FROM workers", None, "Fiets_Verkoop_Monteur", "Accessoire_Verkoop_Monteur", "Onderhoud_Monteur"),
    *_arriving("sources", "Fiets_Verkoop", "own"), *_arriving("sources", "Accessoire_Verkoop", "NOT own"),
    *_arriving("sources", "Fiets_Inkoop", "own"), *_arriving("sources", "Accessoire_Inkoop", "NOT own"),
    *_staged("SELECT count(*) FROM events", "SELECT count(*) FROM events WHERE coalesce(event_type <> 'error', true)", "Onderhoud"),
])

KEYED = ", ".join(
    f"(CASE WHEN own THEN 'FIETS_VERKOOP_' ELSE 'ACCESSOIRE_VERKOOP_' END || CAST({number} AS VARCHAR)) AS {name}"
    for number, name in (("c_custkey", "klant"), ("sold", "product"), ("s_suppkey", "monteur"), ("s_nationkey", "filiaal"))
)

LOAD_ORACLES: dict[str, str] = {
    "star_refresh_sales": f"WITH {LOADS} SELECT * EXCLUDE (early) FROM sales",
    "star_source_sales": f"""WITH {LOADS} SELECT CASE WHEN own THEN 1 ELSE 2 END AS source_id, o_orderkey AS verkoopnr,
          CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS datum_key, {KEYED}
        FROM sources JOIN buyers ON o_custkey = c_custkey AND CASE WHEN own THEN in_first ELSE in_second END
          JOIN supplier ON worker = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
          JOIN part ON sold = p_partkey WHERE o_orderdate IS NOT NULL""",
    "star_refresh_log": f"""WITH {LOADS}, steps AS ({STEPS}), series(run_id, step) AS (
          VALUES ('20240101_000000', 1), ('20240102_000000', 2), ('20240103_000000', 3))
        SELECT run_id, tabel, 'OK' AS status, CASE WHEN step < 3 THEN one ELSE two - one END AS aantal_insert,
          CASE WHEN step < 3 THEN 0 ELSE changed END AS aantal_update, CASE WHEN step < 3 THEN one ELSE two END AS aantal_dwh_na
        FROM steps, series""",
    "star_failed_log": f"""WITH {LOADS}, steps AS ({STEPS}), fates AS (
          SELECT *, CASE tabel WHEN 'Klant' THEN 'ERROR' WHEN 'Verkoop' THEN 'SKIPPED' ELSE 'OK' END AS status,
            CASE WHEN tabel = 'Monteur' THEN one ELSE two END AS n FROM steps)
        SELECT '20240101_000000' AS run_id, tabel, status, CASE WHEN status = 'OK' THEN n ELSE 0 END AS aantal_insert,
          0 AS aantal_update, CASE WHEN status = 'OK' THEN n ELSE 0 END AS aantal_dwh_na FROM fates""",
    "star_sales": f"WITH {LOADS} SELECT * EXCLUDE (early) FROM sales",
    "star_purchase": f"WITH {LOADS} SELECT * EXCLUDE (early) FROM purchases",
    "star_maintenance": f"WITH {LOADS} SELECT * EXCLUDE (early) FROM visits",
    "star_workers": f"""WITH {LOADS} SELECT monteur AS business_key, round(early_wage, 2) AS uurloon,
          TIMESTAMP '2024-01-01 00:00:00' AS begin_tijd,
          CASE WHEN wage > 5000 THEN TIMESTAMP '2024-01-02 00:00:00' END AS eind_tijd, NOT coalesce(wage > 5000, false) AS open
        FROM workers UNION ALL
        SELECT monteur, round(wage, 2), TIMESTAMP '2024-01-02 00:00:00', NULL, true FROM workers WHERE wage > 5000""",
    "star_log": f"""WITH {LOADS}, steps AS ({STEPS})
        SELECT run_id, tabel, 'OK' AS status, CASE WHEN first THEN one ELSE two - one END AS aantal_insert,
          CASE WHEN first THEN 0 ELSE changed END AS aantal_update, CASE WHEN first THEN one ELSE two END AS aantal_dwh_na
        FROM steps, runs""",
    "staging_log": f"""WITH {LOADS}, staged AS ({STAGED})
        SELECT run_id, doel_tabel, 'OK' AS status, CASE WHEN first THEN one ELSE two END AS aantal_bron,
          CASE WHEN first THEN one ELSE two END AS aantal_doel_na FROM staged, runs""",
}

_stamp = "strftime(strptime(run_id, '%Y%m%d_%H%M%S'), '%Y-%m-%d %H:%M:%S') AS timestamp"
LOAD_ORACLES["mixed_logs"] = f"""
SELECT 15 AS layout, {_stamp}, tabel, status, aantal_dwh_na AS aantal, CAST(NULL AS VARCHAR) AS melding FROM ({LOAD_ORACLES['star_log']})
UNION ALL SELECT 7, {_stamp}, tabel, status, aantal_dwh_na, tabel || ' is "checked",' || chr(10) || 'and once more' FROM ({LOAD_ORACLES['star_log']})
UNION ALL SELECT 14, {_stamp}, doel_tabel, status, aantal_doel_na, NULL FROM ({LOAD_ORACLES['staging_log']})"""
