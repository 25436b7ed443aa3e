"""The same questions as plain SQL over the sample tables, for checking."""

from __future__ import annotations

BIRTH = "CASE WHEN c_acctbal >= 0 THEN CAST(c_nationkey + 1950 AS VARCHAR) || '-01-01' END"
LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate"


def _klant(number: int, served: str, town: str) -> str:
    return f"""SELECT {number} AS source_id, c_custkey AS klantnr, c_name AS naam,
      '{town} ' || CAST(c_nationkey AS VARCHAR) AS woonplaats, c_mktsegment AS adres,
      {BIRTH} AS geboortedatum,
      coalesce(c_name, 'None') || '_' || coalesce({BIRTH}, 'None') AS business_key
    FROM customer WHERE {served}"""


KLANT = f"""branches AS (
  {_klant(1, "c_mktsegment IN ('AUTOMOBILE','BUILDING','FURNITURE')", "City")}
  UNION ALL
  {_klant(2, "coalesce(c_mktsegment, '') NOT IN ('AUTOMOBILE','BUILDING')", "Town")}),
incoming AS (
  SELECT * EXCLUDE rn FROM (
    SELECT *, row_number() OVER (PARTITION BY business_key ORDER BY source_id, klantnr) AS rn FROM branches)
  WHERE rn = 1),
stored AS (
  SELECT c_custkey + 1 AS klant_key, coalesce(c_name, 'None') || '_' || coalesce({BIRTH}, 'None') AS business_key,
    c_custkey AS klantnr, c_name AS naam,
    CASE WHEN c_acctbal > 8000 THEN 'Old ' WHEN c_mktsegment = 'MACHINERY' THEN 'Town ' ELSE 'City ' END
      || CAST(c_nationkey AS VARCHAR) AS woonplaats,
    c_mktsegment AS adres
  FROM customer WHERE c_mktsegment IN ('AUTOMOBILE','BUILDING','MACHINERY')),
fresh AS (
  SELECT (SELECT coalesce(max(klant_key), 0) FROM stored)
      + row_number() OVER (ORDER BY substr(md5(business_key), 1, 3), business_key) AS klant_key,
    business_key, klantnr, naam, woonplaats, adres
  FROM incoming WHERE business_key NOT IN (SELECT business_key FROM stored)),
consolidated AS (
  SELECT klantnr, naam, woonplaats, source_id AS bron FROM branches b
  WHERE klantnr NOT IN (SELECT klantnr FROM stored)
    AND NOT EXISTS (SELECT 1 FROM branches e WHERE e.klantnr = b.klantnr AND e.source_id < b.source_id))"""

FILIAAL = """filiaal AS (
  SELECT n_nationkey AS filiaalnr, n_name AS adres, r_name AS provincie, n_name AS business_key
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

MONTEUR = """monteur AS (
  SELECT s_suppkey AS monteurnr, s_name AS naam, n_name AS woonplaats, s_acctbal AS uurloon, n_regionkey AS regio,
    s_name || '_' || n_name AS business_key
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
history AS (
  SELECT monteurnr * 2 + 2 AS monteur_key, business_key, monteurnr, naam, woonplaats,
    CASE WHEN uurloon > 5000 THEN uurloon - 100 ELSE uurloon END AS uurloon,
    TIMESTAMP '2020-01-01 00:00:00' AS begin_tijd, CAST(NULL AS TIMESTAMP) AS eind_tijd
  FROM monteur WHERE regio <> 0
  UNION ALL
  SELECT monteurnr * 2 + 1, business_key, monteurnr, naam, woonplaats, uurloon - 50,
    TIMESTAMP '2019-01-01 00:00:00', TIMESTAMP '2020-01-01 00:00:00'
  FROM monteur WHERE regio <> 0 AND uurloon < 2000),
opened AS (
  SELECT (SELECT max(monteur_key) FROM history)
      + row_number() OVER (ORDER BY substr(md5(business_key), 1, 3), business_key) AS monteur_key,
    business_key, monteurnr, naam, woonplaats, uurloon
  FROM monteur m WHERE NOT EXISTS (
    SELECT 1 FROM history h WHERE h.eind_tijd IS NULL AND h.business_key = m.business_key
      AND h.uurloon = m.uurloon))"""

SALES = f"""{MONTEUR}, {FILIAAL},
sales AS (
  SELECT CAST(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 2 END AS BIGINT) AS source_id, {LINE},
    c_custkey + 1 AS klant_key,
    CASE WHEN m.uurloon >= 0 THEN m.monteurnr + 1 END AS monteur_key,
    l_partkey * 2 + CASE WHEN l_linestatus = 'O' THEN 1 ELSE 2 END AS product_key,
    CAST(f.filiaalnr + 1 AS BIGINT) AS filiaal_key,
    CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS datum_key,
    l_extendedprice / l_quantity AS verkoopprijs, CAST(l_quantity AS BIGINT) AS aantal
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN monteur m ON l_suppkey = m.monteurnr JOIN filiaal f ON m.woonplaats = f.adres)"""

PERIODS = """stored_periods AS (
  SELECT DISTINCT CAST(month(l_shipdate) AS BIGINT) AS periode_key, CAST(month(l_shipdate) AS BIGINT) AS inkoopmaand,
    CAST(1995 AS BIGINT) AS inkoopjaar FROM lineitem WHERE year(l_shipdate) = 1995),
periods AS (
  SELECT * FROM stored_periods
  UNION ALL
  SELECT (SELECT max(periode_key) FROM stored_periods) + row_number() OVER (ORDER BY inkoopjaar, inkoopmaand),
    inkoopmaand, inkoopjaar
  FROM (SELECT DISTINCT CAST(month(l_shipdate) AS BIGINT) AS inkoopmaand, CAST(year(l_shipdate) AS BIGINT) AS inkoopjaar
        FROM lineitem WHERE year(l_shipdate) <> 1995))"""

PURCHASES = f"""{PERIODS},
purchases AS (
  SELECT CAST(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 2 END AS BIGINT) AS source_id, {LINE},
    l_partkey * 2 + CASE WHEN l_linestatus = 'O' THEN 1 ELSE 2 END AS product_key,
    periode_key, s_suppkey + 1 AS lev_key, CAST(l_quantity AS BIGINT) AS aantal, p_retailprice AS inkoopprijs
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN periods ON inkoopmaand = month(l_shipdate) AND inkoopjaar = year(l_shipdate)
  WHERE s_acctbal >= 0)"""

VISITS = f"""{MONTEUR}, {FILIAAL},
visits AS (
  SELECT event_id AS onderhoudnr, user_id * 2 + 1 AS product_key,
    CASE WHEN uurloon >= 0 THEN monteurnr + 1 END AS monteur_key, CAST(filiaalnr + 1 AS BIGINT) AS filiaal_key,
    strftime(ts, '%Y-%m-%d') AS datum, strftime(ts, '%H:%M:%S') AS starttijd,
    strftime(ts + to_seconds(CAST(floor(value) AS BIGINT)), '%H:%M:%S') AS eindtijd, uurloon,
    'fiets_' || CAST(user_id AS VARCHAR) AS product_bk, m.business_key AS monteur_bk, f.business_key AS filiaal_bk
  FROM events JOIN monteur m ON user_id = monteurnr JOIN filiaal f ON m.woonplaats = f.adres
  JOIN part ON user_id = p_partkey)"""


def _split(name: str) -> str:
    step = lambda s: f"(({s}) * ({s}) + ({s}) * 48271 + 11) % 2147483647"
    return f"""mixed AS (SELECT *, {step("s1")} AS s2 FROM (SELECT *, {step("s0")} AS s1 FROM (
      SELECT *, (42 + {name}) % 2147483647 AS s0 FROM source)))"""


LINES = f"""source AS (
  SELECT {LINE}, CASE WHEN l_discount < 0.09 THEN l_quantity END AS quantity,
    CASE WHEN l_tax < 0.07 THEN l_returnflag END AS flag, l_extendedprice, l_tax FROM lineitem),
{_split("l_orderkey")},
train AS (SELECT * FROM mixed WHERE s2 % 100 >= 20)"""

BINARY = """counts AS (
  SELECT count(*) FILTER (y = 1 AND p = 1) AS tp, count(*) FILTER (y = 0 AND p = 1) AS fp,
    count(*) FILTER (y = 1 AND p = 0) AS fn, count(*) FILTER (y = 0 AND p = 0) AS tn
  FROM (SELECT CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS y,
    CASE WHEN l_shipdate >= TIMESTAMP '1998-06-01' THEN 1 ELSE 0 END AS p FROM lineitem))"""

FLAGS = """flags AS (
  SELECT l_returnflag AS y,
    CASE WHEN l_quantity < 15 THEN 'A' WHEN l_quantity < 30 THEN 'N' ELSE 'R' END AS p FROM lineitem)"""


def _silhouette(distance: str) -> str:
    return f"""vectors AS (SELECT vec_id AS id, label AS cluster, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
pairs AS (
  SELECT a.id, a.cluster, b.cluster AS other, sum({distance}) AS total, count(*) AS n
  FROM vectors a CROSS JOIN vectors b GROUP BY 1, 2, 3),
means AS (
  SELECT id, cluster, max(n) FILTER (cluster = other) AS size,
    max(total / greatest(n - 1, 1)) FILTER (cluster = other) AS a, min(total / n) FILTER (cluster <> other) AS b
  FROM pairs GROUP BY 1, 2),
scored AS (
  SELECT id, cluster,
    CASE WHEN size = 1 THEN 0.0 ELSE coalesce((b - a) / nullif(greatest(a, b), 0), 0.0) END AS silhouette FROM means)"""


PLAIN = _silhouette("list_distance(a.x, b.x)")
SQUARED = _silhouette("list_distance(a.x, b.x) * list_distance(a.x, b.x)")

ADDRESS2 = "CASE WHEN c_acctbal >= 0 THEN c_mktsegment END"

ORACLES: dict[str, str] = {
    "q_e01": "SELECT p_partkey, p_retailprice FROM part WHERE p_retailprice > 920 AND p_retailprice < 950",
    "q_e02": "SELECT p_partkey, p_size FROM part WHERE p_size < 10 OR p_size > 40",
    "q_e03": "SELECT n_name FROM nation WHERE n_regionkey = 2 ORDER BY n_name",
    "q_e04": "SELECT DISTINCT o_orderdate FROM orders WHERE o_totalprice > 440000",
    "q_e05": f"SELECT c_name, c_nationkey FROM customer WHERE {ADDRESS2} IS NOT NULL AND nullif(c_nationkey, 0) IS NOT NULL",
    "q_e06": "SELECT n_name FROM nation WHERE n_regionkey IN (1, 2) ORDER BY n_name",
    "q_e07": "SELECT p_name, p_type, p_brand FROM part WHERE p_name LIKE 'b%' AND nullif(p_type, 'PROMO') IS NOT NULL",
    "q_e08": "SELECT sum(l_quantity) AS total_returned FROM lineitem WHERE l_returnflag = 'R'",
    "q_e09": "SELECT count(DISTINCT n_regionkey) AS regions FROM supplier JOIN nation ON s_nationkey = n_nationkey",
    "q_e10": "SELECT min(p_size / 100) AS lowest, max(p_size / 100) AS highest, round(avg(p_size / 100), 2) AS average FROM part",
    "q_e11": f"SELECT count(*) AS without_second_address FROM customer WHERE {ADDRESS2} IS NULL",
    "q_e12": """SELECT round(avg(p_retailprice), 6) AS average_cost FROM lineitem JOIN part ON l_partkey = p_partkey
        WHERE l_extendedprice / l_quantity < 1.5 * p_retailprice""",
    "q_e13": "SELECT c_mktsegment, count(*) AS employees FROM customer GROUP BY 1",
    "q_e14": """SELECT c_nationkey, count(*) AS employees FROM customer GROUP BY 1
        HAVING count(*) > (SELECT count(*) / 25 FROM customer)""",
    "q_e15": "SELECT c_name, c_mktsegment FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name = 'NATION_7'",
    "q_e16": """SELECT s_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'""",
    "q_e17": """SELECT DISTINCT n_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        WHERE o_orderpriority = '1-URGENT' AND c_mktsegment = 'MACHINERY'""",
    "q_e18": """SELECT DISTINCT c_mktsegment, o_orderdate FROM customer
        LEFT JOIN (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '2001-06-01') ON c_custkey = o_custkey
        WHERE c_mktsegment LIKE '%H%'""",
    "q_e19": "SELECT DISTINCT p_name, p_type FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_quantity > 49",
    "q_e20": """SELECT DISTINCT p_name FROM lineitem JOIN part ON l_partkey = p_partkey
        WHERE (l_extendedprice - l_extendedprice * (1 - l_discount)) / nullif(l_extendedprice, 0) > 0.095""",
    "q_e21": """SELECT DISTINCT o_orderpriority FROM orders JOIN (
          SELECT l_orderkey FROM lineitem GROUP BY 1
          HAVING sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) / sum(l_quantity) > 0.9)
        ON o_orderkey = l_orderkey""",
    "q_e22": "SELECT p_type, count(*) AS products FROM part GROUP BY 1",
    "q_e23": "SELECT n_name, count(*) AS sites FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1",
    "q_e24": """SELECT p_name, sum(l_quantity) AS total_quantity,
          CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS average_price
        FROM part JOIN lineitem ON p_partkey = l_partkey WHERE p_type = 'ECONOMY' GROUP BY 1 ORDER BY 2, 1""",
    "q_e25": """SELECT r_name, n_name AS verkoper, klanten FROM nation JOIN region ON n_regionkey = r_regionkey
        JOIN (SELECT n_regionkey AS rk, count(*) AS klanten FROM nation
              WHERE n_nationkey IN (SELECT c_nationkey FROM customer) GROUP BY 1) ON rk = n_regionkey""",
    "q_e26": """SELECT c_name, c_mktsegment FROM customer
        WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01')""",
    "q_e27": """WITH below AS (SELECT p_size FROM part WHERE p_size < (SELECT avg(p_size) FROM part))
        SELECT CAST(count(*) AS DOUBLE) AS waarde FROM below UNION SELECT round(avg(p_size), 6) FROM below""",
    "q_e28": """SELECT o_orderkey FROM orders WHERE o_totalprice > 400000
        AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
    "q_e29": "SELECT c_name, CASE WHEN c_mktsegment LIKE '%MA%' THEN 'Ja' ELSE 'Nee' END AS manager FROM customer",
    "q_e30": """SELECT o_orderkey, CASE WHEN 2001 - year(o_orderdate) < 3 THEN 'kort in dienst'
        ELSE 'lang in dienst' END AS dienst FROM orders""",
    "scan_constants": """SELECT p_partkey AS productnr, p_name AS soort, 'accessoire' AS product_type,
        CAST(NULL AS VARCHAR) AS kleur, 2 AS source_id FROM part""",
    "preview_orders": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10",
    "table_counts": " UNION ALL ".join(
        f"SELECT '{n}' AS tabel, count(*) AS aantal FROM {n}" for n in ("customer", "lineitem", "orders", "part", "supplier")
    ),
    "column_types": " UNION ALL ".join(
        f"SELECT {i} AS positie, '{c}' AS kolom, '{k}' AS type, count({c}) AS gevuld FROM orders"
        for i, (c, k) in enumerate((
            ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
            ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string"),
        ))
    ),
    "stage_first_wins": f"WITH {KLANT} SELECT * FROM consolidated",
    "stage_union_conform": """SELECT s_suppkey AS leveranciernr, s_name AS naam,
          'Street ' || CAST(s_nationkey AS VARCHAR) AS adres, 'City ' || CAST(s_nationkey AS VARCHAR) AS woonplaats, 1 AS tak
        FROM supplier UNION ALL SELECT p_partkey, p_brand, p_type, p_name, 2 FROM part""",
    "stage_align": "SELECT p_partkey, p_name, CAST(p_size AS BIGINT) AS p_size, CAST(NULL AS VARCHAR) AS kleur FROM part",
    "stage_reconcile": f"""WITH {KLANT}, {FILIAAL},
        counts AS (
          SELECT 'Klant' AS doel_tabel, (SELECT count(*) FROM branches) AS aantal_bron,
            (SELECT count(*) FROM stored) AS aantal_doel_voor,
            (SELECT count(*) FROM stored) + (SELECT count(*) FROM consolidated) AS aantal_doel_na
          UNION ALL SELECT 'Filiaal', (SELECT count(*) FROM filiaal), 0, (SELECT count(*) FROM filiaal))
        SELECT *, aantal_doel_na - aantal_doel_voor AS aantal_verwerkt,
          CASE WHEN aantal_doel_na - aantal_doel_voor = aantal_bron THEN 'OK' ELSE 'WARNING' END AS status FROM counts""",
    "bk_natural": f"WITH {KLANT} SELECT source_id, klantnr, business_key FROM branches",
    "bk_source": f"""WITH {KLANT} SELECT klantnr, CASE source_id WHEN 1 THEN 'FIETS_VERKOOP_' ELSE 'ACCESSOIRE_VERKOOP_' END
        || CAST(klantnr AS VARCHAR) AS business_key FROM branches""",
    "sk_dense": """SELECT o_orderkey,
        100 + row_number() OVER (ORDER BY substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 3), o_orderkey) AS order_key FROM orders""",
    "dedupe_first": f"""SELECT {LINE} FROM (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey) AS rn FROM lineitem) WHERE rn = 1""",
    "dedupe_branches": f"WITH {KLANT} SELECT business_key, source_id, klantnr, woonplaats FROM incoming",
    "scd1_snapshot": f"""WITH {KLANT}
        SELECT s.klant_key, s.business_key, coalesce(i.klantnr, s.klantnr) AS klantnr, coalesce(i.naam, s.naam) AS naam,
          coalesce(i.woonplaats, s.woonplaats) AS woonplaats, coalesce(i.adres, s.adres) AS adres
        FROM stored s LEFT JOIN incoming i USING (business_key)
        UNION ALL SELECT * FROM fresh""",
    "scd1_counts": f"""WITH {KLANT} SELECT count(*) FILTER (s.klant_key IS NULL) AS aantal_insert,
          count(*) FILTER (s.klant_key IS NOT NULL AND i.woonplaats <> s.woonplaats) AS aantal_update,
          count(*) FILTER (s.klant_key IS NOT NULL AND i.woonplaats = s.woonplaats) AS aantal_skip
        FROM incoming i LEFT JOIN stored s USING (business_key)""",
    "scd2_history": f"""WITH {MONTEUR}
        SELECT h.* REPLACE (CASE WHEN h.eind_tijd IS NULL AND h.uurloon <> m.uurloon THEN TIMESTAMP '2021-01-01 00:00:00'
          ELSE h.eind_tijd END AS eind_tijd)
        FROM history h LEFT JOIN monteur m USING (business_key)
        UNION ALL SELECT *, TIMESTAMP '2021-01-01 00:00:00', NULL FROM opened""",
    "scd2_close_missing": f"""WITH {MONTEUR}, remaining AS (SELECT * FROM monteur WHERE regio <> 1)
        SELECT h.business_key, h.uurloon, h.begin_tijd, CASE WHEN h.eind_tijd IS NULL
          AND (r.uurloon IS NULL OR h.uurloon <> r.uurloon) THEN TIMESTAMP '2021-01-01 00:00:00' ELSE h.eind_tijd END AS eind_tijd
        FROM history h LEFT JOIN remaining r USING (business_key)
        UNION ALL SELECT business_key, o.uurloon, TIMESTAMP '2021-01-01 00:00:00', NULL
        FROM opened o JOIN remaining USING (business_key)""",
    "scd2_counts": f"""WITH {MONTEUR}, n AS (
          SELECT (SELECT count(*) FROM history) AS voor, (SELECT count(*) FROM opened) AS nieuw,
            (SELECT count(*) FROM opened WHERE business_key IN (SELECT business_key FROM history)) AS anders)
        SELECT voor AS aantal_dwh_voor, nieuw AS aantal_insert, anders AS aantal_update,
          (SELECT count(*) FROM monteur) - nieuw AS aantal_skipped, voor + nieuw AS aantal_dwh_na FROM n""",
    "scd2_append_only": f"""WITH {MONTEUR} SELECT * FROM opened""",
    "scd2_first_load": f"""WITH {FILIAAL} SELECT row_number() OVER (
        ORDER BY substr(md5(business_key), 1, 3), business_key) AS filiaal_key, business_key, provincie,
        TIMESTAMP '2021-01-01 00:00:00' AS begin_tijd, CAST(NULL AS TIMESTAMP) AS eind_tijd FROM filiaal""",
    "current_by_max": f"""WITH {MONTEUR} SELECT h.business_key, h.monteur_key, h.uurloon FROM history h
        JOIN (SELECT business_key, max(monteur_key) AS mk FROM history GROUP BY 1) x
          ON h.business_key = x.business_key AND h.monteur_key = x.mk""",
    "current_open": f"WITH {MONTEUR} SELECT business_key, monteur_key, uurloon FROM history WHERE eind_tijd IS NULL",
    "version_history": f"WITH {MONTEUR} SELECT * FROM history ORDER BY business_key, monteur_key",
    "dim_insert_only": f"WITH {KLANT} SELECT klant_key, business_key, klantnr, naam FROM fresh",
    "dim_date": """SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS datum_key, strftime(d, '%Y-%m-%d') AS datum,
          CAST(day(d) AS BIGINT) AS dag, CAST(month(d) AS BIGINT) AS maand, CAST(quarter(d) AS BIGINT) AS kwartaal,
          CAST(year(d) AS BIGINT) AS jaar
        FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem
              UNION SELECT CAST(ts AS DATE) FROM events)""",
    "dim_period": f"WITH {PERIODS} SELECT * FROM periods",
    "fact_sales": f"WITH {SALES} SELECT * FROM sales WHERE monteur_key IS NOT NULL",
    "fact_purchase": f"WITH {PURCHASES} SELECT * FROM purchases",
    "fact_maintenance": f"WITH {VISITS} SELECT * EXCLUDE (product_bk, monteur_bk, filiaal_bk) FROM visits WHERE monteur_key IS NOT NULL",
    "fact_rejects": f"WITH {SALES} SELECT source_id, count(*) AS aantal_skipped FROM sales WHERE monteur_key IS NULL GROUP BY 1",
    "fact_optional_fk": f"""WITH {SALES} SELECT source_id, count(*) AS rijen,
        count(*) FILTER (monteur_key IS NULL) AS zonder_monteur FROM sales GROUP BY 1""",
    "fact_increment": f"WITH {PURCHASES} SELECT * FROM purchases WHERE year(l_shipdate) >= 1999",
    "fact_known_dates": """SELECT CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) AS datum_key, count(*) AS rijen FROM lineitem
        WHERE CAST(l_shipdate AS DATE) IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderstatus = 'F') GROUP BY 1""",
    "measures": f"""WITH {SALES} SELECT source_id, datum_key, round(sum(verkoopprijs * aantal), 2) AS omzet
        FROM sales WHERE monteur_key IS NOT NULL GROUP BY 1, 2""",
    "measures_purchase": f"""WITH {PURCHASES} SELECT periode_key, round(sum(inkoopprijs * aantal), 2) AS inkoopwaarde
        FROM purchases GROUP BY 1""",
    "measures_maintenance": f"""WITH {VISITS}, secs AS (
          SELECT *, date_diff('second', CAST('1970-01-01 ' || starttijd AS TIMESTAMP), CAST('1970-01-01 ' || eindtijd AS TIMESTAMP)) AS s
          FROM visits WHERE monteur_key IS NOT NULL)
        SELECT onderhoudnr, round(((s + 86400) % 86400) / 3600.0, 6) AS duur,
          round((CAST((s + 86400) % 86400 AS DOUBLE) / 3600) * uurloon, 6) AS kosten FROM secs""",
    "missing_keys": f"""WITH {VISITS} SELECT onderhoudnr, product_bk, monteur_bk, filiaal_bk, CAST(product_key AS DOUBLE) AS product_key,
        CAST(monteur_key AS DOUBLE) AS monteur_key, CAST(filiaal_key AS DOUBLE) AS filiaal_key FROM visits WHERE monteur_key IS NULL""",
    "final_counts": f"""WITH {VISITS}, {PERIODS}, counts AS (
          SELECT 'Klant' AS tabel, count(*) AS aantal FROM customer
          UNION ALL SELECT 'Product', 2 * count(*) FROM part UNION ALL SELECT 'Monteur', count(*) FROM supplier
          UNION ALL SELECT 'Filiaal', count(*) FROM nation
          UNION ALL SELECT 'Leverancier', count(*) FROM supplier WHERE s_acctbal >= 0
          UNION ALL SELECT 'InkoopPeriode', count(*) FROM periods
          UNION ALL SELECT 'Onderhoud', count(*) FROM visits WHERE monteur_key IS NOT NULL
          UNION ALL SELECT 'Leeg', count(*) FROM part WHERE p_size < 0)
        SELECT *, CASE WHEN aantal > 0 THEN 'OK' ELSE 'WARNING' END AS status FROM counts""",
    "key_violations": "SELECT l_orderkey, l_linenumber, count(*) AS aantal FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "fk_orphans": "SELECT event_id, user_id FROM events WHERE user_id NOT IN (SELECT s_suppkey FROM supplier)",
    "contact_details": """SELECT c_custkey AS staff, c_nationkey AS extension, c_name || '@shop' AS email,
        'EN' AS first_language, CASE WHEN c_nationkey < 15 THEN 'FR' ELSE 'DE' END AS second_language FROM customer""",
    "staff_changes": """SELECT staff, position_en || ' ' || last_name AS full_name,
          CASE WHEN position_en = 'MACHINERY' THEN 'General Manager' ELSE position_en END AS position,
          TRY_CAST(extension AS DOUBLE) + 1 AS extension,
          CAST(CASE position_en WHEN 'BUILDING' THEN 1 WHEN 'FURNITURE' THEN 0 END AS DOUBLE) AS flag
        FROM (SELECT c_custkey AS staff, c_name AS last_name, c_mktsegment AS position_en,
                nullif(CAST(c_nationkey AS VARCHAR), '7') AS extension FROM customer
              UNION ALL SELECT -1, 'New', 'BUILDING', 'n/a') WHERE staff NOT IN (98, 99, 100)""",
    "numeric_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS kolom, CAST(min({c}) AS DOUBLE) + 0.0 AS laagste, CAST(max({c}) AS DOUBLE) AS hoogste FROM lineitem"
        for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ),
    "date_parts": """SELECT o_orderkey, CAST(strftime(d, '%Y%m%d') AS DOUBLE) AS datum_key, CAST(year(d) AS DOUBLE) AS jaar,
          CAST(quarter(d) AS DOUBLE) AS kwartaal, CAST(month(d) AS DOUBLE) AS maand, CAST(week(d) AS DOUBLE) AS week,
          CAST(day(d) AS DOUBLE) AS dagnr
        FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS d FROM orders)""",
    "pattern_dates": "SELECT o_orderkey, CAST(2026 - year(o_orderdate) AS INT) AS jaren FROM orders",
    "split_hash": f"""WITH source AS (SELECT o_orderkey FROM orders), {_split("o_orderkey")}
        SELECT o_orderkey, s2 % 100 < 20 AS is_test FROM mixed""",
    "impute_median": f"""WITH {LINES} SELECT {LINE}, coalesce(quantity, (SELECT median(quantity) FROM train)) AS quantity,
        (SELECT median(l_extendedprice) FROM train) AS median_price FROM mixed""",
    "impute_mode": f"""WITH {LINES} SELECT {LINE}, coalesce(flag, (
          SELECT flag FROM train WHERE flag IS NOT NULL GROUP BY flag ORDER BY count(*) DESC, flag LIMIT 1)) AS flag FROM mixed""",
    "scale_std": """SELECT p_partkey, round((p_size - (SELECT avg(p_size) FROM part)) / (SELECT stddev_pop(p_size) FROM part), 4) AS size,
          round((p_retailprice - (SELECT avg(p_retailprice) FROM part)) / (SELECT stddev_pop(p_retailprice) FROM part), 4)
            AS p_retailprice, CAST(0 AS DOUBLE) AS flat FROM part""",
    "onehot_unseen": "SELECT p_partkey, " + ", ".join(
        f"CAST(p_type = '{v}' AS INT) AS {v.lower()}" for v in ("ECONOMY", "LARGE", "MEDIUM", "SMALL", "STANDARD")
    ) + " FROM part",
    "dummies": "SELECT p_partkey, " + ", ".join(
        f"CAST(p_type = '{v}' AS INT) AS {v.lower()}" for v in ("LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
    ) + " FROM part",
    "class_weights": """SELECT l_returnflag, count(*) AS aantal,
          round((SELECT count(*) FROM lineitem) / ((SELECT count(DISTINCT l_returnflag) FROM lineitem) * count(*)), 6) AS gewicht
        FROM lineitem GROUP BY 1""",
    "reg_metrics": """WITH v AS (SELECT l_extendedprice AS y, l_quantity * 2000 + 1000 AS p FROM lineitem)
        SELECT round(avg(abs(y - p)), 2) AS mae, round(avg((y - p) * (y - p)), 0) AS mse,
          round(sqrt(avg((y - p) * (y - p))), 2) AS rmse, round(1 - avg((y - p) * (y - p)) / var_pop(y), 6) AS r2 FROM v""",
    "reg_bounds": """SELECT least(min(l_extendedprice), min(l_quantity * 2000 + 1000)) AS min_val,
        greatest(max(l_extendedprice), max(l_quantity * 2000 + 1000)) AS max_val FROM lineitem""",
    "cls_metrics": f"""WITH {BINARY} SELECT round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy,
        round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall,
        round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM counts""",
    "cls_weighted": f"""WITH {FLAGS}, per AS (
          SELECT c, (SELECT count(*) FROM flags WHERE y = c) AS s, (SELECT count(*) FROM flags WHERE p = c) AS g,
            (SELECT count(*) FROM flags WHERE y = c AND p = c) AS h FROM (SELECT unnest(['A', 'N', 'R']) AS c))
        SELECT round(sum(h / g * s) / sum(s), 6) AS precision, round(sum(h / s * s) / sum(s), 6) AS recall,
          round(sum(2 * h / (s + g) * s) / sum(s), 6) AS f1 FROM per""",
    "confusion": f"""WITH {FLAGS} SELECT y AS label, count(*) FILTER (p = 'A') AS "pred_A",
        count(*) FILTER (p = 'N') AS "pred_N", count(*) FILTER (p = 'R') AS "pred_R" FROM flags GROUP BY 1""",
    "reg_line": """SELECT round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
        round(regr_slope(l_extendedprice, l_quantity), 4) AS slope FROM lineitem""",
    "reg_rows": """WITH line AS (
          SELECT regr_intercept(l_extendedprice, l_quantity) AS a, regr_slope(l_extendedprice, l_quantity) AS b FROM lineitem)
        SELECT l_orderkey, l_linenumber, l_extendedprice AS actual, round(a + b * l_quantity, 2) AS predicted,
          round(l_extendedprice - (a + b * l_quantity), 2) AS residual FROM lineitem, line""",
    "cluster_sizes": "SELECT label AS cluster, count(*) AS aantal FROM embeddings GROUP BY 1",
    "nearest_mean": """WITH cells AS (
          SELECT vec_id, label, unnest(CAST(embedding AS DOUBLE[])) AS x, unnest(range(len(embedding))) AS i FROM embeddings),
        means AS (SELECT label AS nearest, i, avg(x) AS m FROM cells GROUP BY 1, 2),
        distances AS (
          SELECT vec_id, label, nearest, sum((x - m) * (x - m)) AS d FROM cells JOIN means USING (i) GROUP BY 1, 2, 3)
        SELECT vec_id, label, arg_min(nearest, d) AS nearest FROM distances GROUP BY 1, 2""",
    "silhouette_small": f"WITH {PLAIN} SELECT id, cluster, round(silhouette, 6) AS silhouette FROM scored",
    "silhouette_mean": f"WITH {PLAIN} SELECT round(avg(silhouette), 6) AS silhouette FROM scored",
    "silhouette_linear": f"WITH {SQUARED} SELECT id, cluster, round(silhouette, 6) AS silhouette FROM scored",
}


# models and files: closed forms, unrolled steps, recursive steps

_RIDGE = 0.01
_CENTRES = ((10.3, 0.2), (25.1, 5.4), (40.7, 10.1))


def _lloyd() -> str:
    """Centres before three steps, each from the means of the rows nearest to the ones before."""
    given = " UNION ALL ".join(f"SELECT {k} AS cluster, {float(a)}::DOUBLE AS quantity, {float(b)}::DOUBLE AS discount" for k, (a, b) in enumerate(_CENTRES))
    parts = [f"points AS (SELECT row_number() OVER () AS id, l_quantity AS x, l_discount * 100 AS y FROM lineitem), c0 AS ({given})"]
    for step in range(3):
        far = "(x - quantity) * (x - quantity) + (y - discount) * (y - discount)"
        parts.append(f"n{step} AS (SELECT id, x, y, arg_min(cluster, ({far}, cluster)) AS cluster, min({far}) AS far FROM points, c{step} GROUP BY id, x, y)")
        parts.append(f"c{step + 1} AS (SELECT cluster, avg(x) AS quantity, avg(y) AS discount FROM n{step} GROUP BY cluster)")
    rows = " UNION ALL ".join(
        f"SELECT {s} AS step, cluster, round(quantity, 4) AS quantity, round(discount, 4) AS discount, (SELECT round(sum(far), 2) FROM n{s}) AS inertia FROM c{s}"
        for s in range(3)
    )
    return f"WITH {', '.join(parts)} {rows}"


ORACLES |= {
    "ridge_levels": f"""WITH g AS (SELECT CAST(l_partkey AS VARCHAR) AS value, count(*) AS n, avg(l_extendedprice) AS y FROM lineitem GROUP BY 1),
        l AS (SELECT {_RIDGE} * sum(n) AS l FROM g),
        b AS (SELECT sum(n * l / (n + l) * y) / sum(n * l / (n + l)) AS b FROM g, l)
        SELECT '(intercept)' AS feature, NULL AS value, round(b, 2) AS coefficient FROM b
        UNION ALL SELECT 'l_partkey', value, round(n * (y - b) / (n + l), 2) FROM g, l, b""",
    "ridge_pair": f"""WITH m AS (SELECT avg(l_quantity) AS a, avg(l_discount) AS b, avg(l_extendedprice) AS y, var_pop(l_quantity) + {_RIDGE} AS aa,
          var_pop(l_discount) + {_RIDGE} AS bb, covar_pop(l_quantity, l_discount) AS ab, covar_pop(l_quantity, l_extendedprice) AS ay,
          covar_pop(l_discount, l_extendedprice) AS byy FROM lineitem),
        w AS (SELECT *, (bb * ay - ab * byy) / (aa * bb - ab * ab) AS u, (aa * byy - ab * ay) / (aa * bb - ab * ab) AS v FROM m)
        SELECT '(intercept)' AS feature, round(y - u * a - v * b, 2) AS coefficient FROM w
        UNION ALL SELECT 'l_quantity', round(u, 2) FROM w UNION ALL SELECT 'l_discount', round(v, 2) FROM w""",
    "descent_steps": """WITH RECURSIVE s AS (
          SELECT avg(x) AS mx, avg(x * x) AS mxx, avg(y) AS my, avg(x * y) AS mxy, avg(y * y) AS myy
          FROM (SELECT l_quantity / 50 AS x, l_extendedprice / 50000 AS y FROM lineitem)),
        path AS (
          SELECT schedule, eta0, 0 AS step, eta0 AS eta, 0::DOUBLE AS w0, 0::DOUBLE AS w1, myy / 2 AS loss, myy / 2 AS best, 0 AS stale
          FROM s, (VALUES ('constant', 0.3::DOUBLE), ('invscaling', 0.3), ('adaptive', 0.9)) AS g(schedule, eta0)
          UNION ALL
          SELECT schedule, eta0, step + 1, CASE WHEN schedule = 'adaptive' AND late >= 2 THEN used / 5 ELSE used END, n0, n1, after,
            least(best, after), CASE WHEN late >= 2 THEN 0 ELSE late END
          FROM (SELECT *, CASE WHEN after >= best * (1 - 0.001) THEN stale + 1 ELSE 0 END AS late FROM (
            SELECT *, (myy - 2 * n0 * my - 2 * n1 * mxy + n0 * n0 + 2 * n0 * n1 * mx + n1 * n1 * mxx) / 2 + 0.0001 / 2 * n1 * n1 AS after FROM (
              SELECT *, w0 - used * (w0 + w1 * mx - my) AS n0, w1 - used * (w0 * mx + w1 * mxx + w1 * 0.0001 - mxy) AS n1 FROM (
                SELECT *, CASE WHEN schedule = 'invscaling' THEN eta0 / (1 + step) ** 0.25 ELSE eta END AS used FROM path, s WHERE step < 10)))))
        SELECT schedule, step, round(eta, 6) AS eta, round(w0, 6) AS w0, round(w1, 6) AS w1, round(loss, 6) AS loss FROM path""",
    "lloyd_steps": _lloyd(),
    "pca_pair": """WITH m AS (SELECT avg(p_size) AS ma, avg(p_retailprice) AS mb, var_pop(p_size) AS aa, var_pop(p_retailprice) AS bb,
          covar_pop(p_size, p_retailprice) AS ab FROM part),
        a AS (SELECT *, atan2(2 * ab, aa - bb) / 2 AS t FROM m),
        v AS (SELECT *, cos(t) AS c, sin(t) AS s, CASE WHEN abs(cos(t)) >= abs(sin(t)) THEN sign(cos(t)) ELSE sign(sin(t)) END AS f,
          CASE WHEN abs(sin(t)) >= abs(cos(t)) THEN sign(-sin(t)) ELSE sign(cos(t)) END AS g FROM a)
        SELECT p_partkey, round(f * ((p_size - ma) * c + (p_retailprice - mb) * s), 4) + 0.0 AS pc1,
          round(g * ((p_retailprice - mb) * c - (p_size - ma) * s), 4) + 0.0 AS pc2 FROM part, v""",
    "preprocessed_rows": f"""WITH {LINES}, fit AS (SELECT median(quantity) AS q,
          (SELECT flag FROM train WHERE flag IS NOT NULL GROUP BY flag ORDER BY count(*) DESC, flag LIMIT 1) AS f FROM train),
        s AS (SELECT avg(coalesce(quantity, q)) AS mq, stddev_pop(coalesce(quantity, q)) AS sq, avg(l_extendedprice) AS mp,
          stddev_pop(l_extendedprice) AS sp FROM train, fit)
        SELECT {LINE}, l_tax, round((coalesce(quantity, q) - mq) / sq, 4) + 0.0 AS quantity, round((l_extendedprice - mp) / sp, 4) + 0.0 AS price,
          CAST(coalesce(flag, f) = 'A' AS INT) AS flag_a, CAST(coalesce(flag, f) = 'N' AS INT) AS flag_n, CAST(coalesce(flag, f) = 'R' AS INT) AS flag_r
        FROM mixed, fit, s""",
    "sheet_rejects": """WITH o AS (SELECT *, o_orderstatus = 'P' OR starts_with(o_orderpriority, '1') AS bad FROM orders)
        SELECT 'good' AS kind, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys, round(sum(o_totalprice), 2) AS amount, count(*) AS quoted
        FROM o WHERE NOT bad UNION ALL SELECT 'rejected', count(*), CAST(sum(o_orderkey) AS BIGINT), NULL, 0 FROM o WHERE bad""",
}
_RESULTS = " UNION ALL ".join(
    f"""SELECT '{name}' AS experiment, round(avg(abs(l_extendedprice - (l_quantity * {slope} + {base}))), 2) AS mae,
      round(sqrt(avg((l_extendedprice - (l_quantity * {slope} + {base})) ** 2)), 2) AS rmse FROM lineitem"""
    for name, slope, base in (("steep", 2000, 1000), ("flat", 500, 30000), ("middle", 1500, 0), ("level", 0, 38000))
)
ORACLES["ranked_results"] = f"SELECT *, row_number() OVER (ORDER BY rmse, experiment) AS place FROM ({_RESULTS})"
ORACLES["best_result"] = f"SELECT * FROM ({_RESULTS}) ORDER BY rmse, experiment LIMIT 1"

_SPLITS = (("gini", 3, 1, 2, False, 2), ("entropy", 3, 1, 2, True, 2), ("gini, leaf 400", 3, 400, 2, False, 2),
           ("entropy, split 3000", 3, 25, 3000, True, 2), ("two features", 2, 1, 2, False, 1))


def _node_counts(level: int) -> str:
    return f"""h{level} AS (SELECT r.run, node, entropy, min_leaf, min_split, max_depth, features, count(*) AS n,
      sum((y = 'A')::INT)::DOUBLE AS a, sum((y = 'N')::INT)::DOUBLE AS b, sum((y = 'R')::INT)::DOUBLE AS c
    FROM s{level} JOIN runs r USING (run) GROUP BY ALL)"""


def _spread(a: str, b: str, c: str) -> str:
    total = f"({a} + {b} + {c})"
    bits = " + ".join(f"CASE WHEN {x} > 0 THEN -{x} / {total} * log2({x} / {total}) ELSE 0 END" for x in (a, b, c))
    return f"CASE WHEN entropy THEN {bits} ELSE 1 - ({' + '.join(f'({x} / {total}) ** 2' for x in (a, b, c))}) END"


def _split_level(level: int) -> str:
    """Counts, all candidate splits, the best one per node, and the rows that go on, of one level."""
    whole = _spread("h.a", "h.b", "h.c")
    sides = [_spread("la", "lb", "lc"), _spread("(h.a - la)", "(h.b - lb)", "(h.c - lc)")]
    return f"""{_node_counts(level)},
v{level} AS (SELECT run, node, f, x, count(*) AS n, sum((y = 'A')::INT)::DOUBLE AS a, sum((y = 'N')::INT)::DOUBLE AS b, sum((y = 'R')::INT)::DOUBLE AS c
  FROM (SELECT run, node, y, unnest([1, 2, 0]) AS f, unnest([l_discount, l_tax, l_quantity]) AS x FROM s{level}) GROUP BY ALL),
w{level} AS (SELECT *, sum(n) OVER o AS ln, sum(a) OVER o AS la, sum(b) OVER o AS lb, sum(c) OVER o AS lc, lead(x) OVER (PARTITION BY run, node, f ORDER BY x) AS nx
  FROM v{level} WINDOW o AS (PARTITION BY run, node, f ORDER BY x)),
g{level} AS (SELECT w.run, w.node, w.f, w.x / 2 + nx / 2 AS threshold, round({whole} - (
    (la + lb + lc) * ({sides[0]}) + (h.n - la - lb - lc) * ({sides[1]})) / h.n, 10) AS gain
  FROM w{level} w JOIN h{level} h USING (run, node) WHERE nx IS NOT NULL AND ln >= min_leaf AND h.n - ln >= min_leaf AND h.n >= min_split
    AND {level} < max_depth AND (features = 3 OR f > 0)),
b{level} AS (SELECT run, node, unnest(min({{'o': -gain, 'f': f, 't': threshold}})) FROM g{level} GROUP BY run, node HAVING max(gain) > 0),
o{level} AS (SELECT h.run, node, n AS rows, CASE WHEN h.a >= h.b AND h.a >= h.c THEN 'A' WHEN h.b >= h.c THEN 'N' ELSE 'R' END AS label,
    CASE b.f WHEN 0 THEN 'l_quantity' WHEN 1 THEN 'l_discount' WHEN 2 THEN 'l_tax' END AS feature, round({whole}, 6) AS impurity, round(b.t, 6) AS threshold, round(-b.o, 6) AS gain
  FROM h{level} h LEFT JOIN b{level} b USING (run, node)),
s{level + 1} AS (SELECT run, node || CASE WHEN CASE b.f WHEN 0 THEN l_quantity WHEN 1 THEN l_discount ELSE l_tax END <= b.t THEN 'L' ELSE 'R' END AS node,
    y, l_quantity, l_discount, l_tax FROM s{level} JOIN b{level} b USING (run, node))"""


ORACLES["tree_splits"] = f"""WITH runs(run, features, min_leaf, min_split, entropy, max_depth) AS (VALUES {", ".join(
    f"('{n}', {f}, {leaf}, {split}, {e}, {d})" for n, f, leaf, split, e, d in _SPLITS)}),
s0 AS (SELECT run, '' AS node, l_returnflag AS y, l_quantity, l_discount, l_tax FROM lineitem, runs),
{", ".join(_split_level(n) for n in range(3))}
SELECT * FROM o0 UNION ALL SELECT * FROM o1 UNION ALL SELECT * FROM o2"""
