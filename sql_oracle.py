"""DuckDB SQL oracle for the registered queries.

Each statement restates an operator independently of the Spark plan: the fuzzy join
compares every pair in a block (no length pruning), the best partner is a window, the
upsert is ``staged UNION ALL (target anti staged)``.  Tables region ... conversations are
views in the checking session.
"""

from __future__ import annotations

# Fixed values of the registered runs, stated here on their own so that a wrong one in the library shows.
CORPORATE_SUFFIXES = ("inc", "corp", "corporation", "ltd", "limited", "llc", "co")
ADDRESS_ABBREVIATIONS = {"street": "st", "road": "rd", "avenue": "ave", "boulevard": "blvd", "drive": "dr"}
THRESHOLD = 85.0
PROFIT_THRESHOLD = 45000.0
FIRST_BATCH_CUTOFF = "1995-03-01"
RULE_REVENUE_CUTOFF = 1000000.0

REGISTRY_NO_TS = ["corporate_id", "canonical_name", "canonical_address", "activity_places", "top_suppliers",
                  "main_customers", "revenue", "profit", "match_confidence", "source1_present", "source2_present",
                  "batch_id", "match_type"]
ENTITY_COLS = ["corporate_id", "canonical_name", "match_type", "match_confidence", "name_score",
               "clean_name_s1", "clean_name_s2", "row_id_s1", "row_id_s2", "n_rows_s1", "n_rows_s2",
               "corporate_name_s1", "address", "clean_address_s1", "activity_places", "top_suppliers", "batch_id_s1",
               "corporate_name_s2", "main_customers", "revenue", "profit", "batch_id_s2"]
S1_COLS = ["clean_name_s1", "row_id_s1", "n_rows_s1", "corporate_name_s1", "address", "clean_address_s1",
           "activity_places", "top_suppliers", "batch_id_s1"]
S2_COLS = ["clean_name_s2", "row_id_s2", "n_rows_s2", "corporate_name_s2", "main_customers", "revenue", "profit",
           "batch_id_s2"]
MIN_ROWS = 1000


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# ------------------------------------------------------------------ expressions

def _tokens(x: str) -> str:
    return (f"list_filter(string_split(regexp_replace(lower(coalesce({x}, '')), '[^a-z0-9]+', ' ', 'g'), ' '),"
            f" lambda t: t <> '')")


def clean(x: str) -> str:
    suffixes = ", ".join(_q(s) for s in CORPORATE_SUFFIXES)
    return f"array_to_string(list_filter({_tokens(x)}, lambda t: t NOT IN ({suffixes})), ' ')"


def address(x: str) -> str:
    cases = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in ADDRESS_ABBREVIATIONS.items())
    return f"array_to_string(list_transform({_tokens(x)}, lambda t: CASE t {cases} ELSE t END), ' ')"


def parse_list(x: str) -> str:
    return (f"list_filter(list_transform(string_split(coalesce({x}, ''), '|'),"
            r" lambda i: regexp_replace(i, '^\s+|\s+$', '', 'g')), lambda i: i <> '')")


def sort_tokens(x: str) -> str:
    return f"array_to_string(list_sort(string_split({x}, ' ')), ' ')"


def enc(x: str) -> str:
    v = f"CAST({x} AS VARCHAR)"
    return f"coalesce(CAST(length({v}) AS VARCHAR) || ':' || {v}, '-')"


def money(x: str) -> str:
    d = f"TRY_CAST({x} AS DECIMAL(38,6))"
    return f"CASE WHEN CAST({d} AS DOUBLE) = {x} THEN CAST({d} AS VARCHAR) ELSE CAST({x} AS VARCHAR) END"


def lcs(a: str, b: str) -> str:
    """Bit-parallel LCS; ``a`` is the shorter string (at most 120 characters)."""
    mask = (f"list_sum(list_transform(range(length({a})), lambda i: CASE WHEN substr({a}, i + 1, 1) = c"
            f" THEN (1::HUGEINT << i::HUGEINT) ELSE 0::HUGEINT END))::HUGEINT")
    full = f"((1::HUGEINT << length({a})::HUGEINT) - 1)"
    step = f"(((v + (v & {mask})) | (v - (v & {mask}))) & {full})"
    return f"(length({a}) - bit_count(list_reduce(string_split({b}, ''), lambda v, c: {step}, {full})))"


def spelling(x: str, off: int) -> str:
    return (f"CASE (p_partkey * 3 + {off}) % 4 WHEN 0 THEN upper({x}) WHEN 1 THEN 'Co. ' || {x}"
            f" WHEN 2 THEN {x} || ' (Limited)' ELSE replace({x}, ' ', ' / ') END")


def base_name(name: str) -> str:
    k = "CAST(p_partkey AS VARCHAR)"
    long = " || ' ' || ".join([f"({name})"] * 6)
    return f"(substr(md5({k}), 1, 3) || ' ' || CASE WHEN p_partkey % 50 = 35 THEN {long} ELSE {name} END || ' ' || {k})"


# ------------------------------------------------------------------ CTE chain

def fixture_ctes(p: str, batch: str, cutoff: str | None) -> list[str]:
    b1 = base_name("p_name")
    b2 = base_name("CASE WHEN p_partkey % 10 = 5 THEN substr(p_name, 1, length(p_name) - 1) ELSE p_name END")
    li = "SELECT * FROM lineitem" + (f" WHERE l_shipdate < TIMESTAMP '{cutoff}'" if cutoff else "")
    pt = "SELECT * FROM part" + (f" WHERE p_partkey IN (SELECT l_partkey FROM {p}li)" if cutoff else "")
    sup = "'S' || CAST(l_suppkey AS VARCHAR)"
    return [
        f"{p}li AS ({li})",
        f"{p}pt AS ({pt})",
        f"""{p}s1 AS (SELECT {spelling(b1, 0)} AS corporate_name_s1,
              CAST(p_size AS VARCHAR) || ' ' || p_type || ' Street, ' || p_brand AS address,
              x.ap AS activity_places, x.ts AS top_suppliers, 'source1' AS source_name, {_q(batch)} AS batch_id
            FROM {p}pt LEFT JOIN (
              SELECT l_partkey, string_agg(DISTINCT {sup}, '|' ORDER BY {sup}) AS ts,
                     string_agg(DISTINCT n_name, '|' ORDER BY n_name) AS ap
              FROM {p}li JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
              GROUP BY l_partkey) x ON x.l_partkey = p_partkey
            WHERE p_partkey % 10 < 6
            UNION ALL SELECT {spelling(b1, 1)}, p_type || ' Road', p_type, p_brand || '|S0|' || p_brand, 'source1', {_q(batch)}
            FROM {p}pt WHERE p_partkey % 50 IN (1, 4)
            UNION ALL SELECT CASE WHEN p_partkey % 200 = 2 THEN 'Inc.' ELSE 'Co. Ltd' END, CAST(p_size AS VARCHAR) || ' Road', NULL, NULL,
              'source1', {_q(batch)} FROM {p}pt WHERE p_partkey % 100 = 2)""",
        f"""{p}s2 AS (SELECT {spelling(b2, 2)} AS corporate_name_s2, y.mc AS main_customers,
              CAST(f.rev AS DOUBLE) AS revenue, CAST(f.prof AS DOUBLE) AS profit,
              'source2' AS source_name, {_q(batch)} AS batch_id
            FROM {p}pt
            LEFT JOIN (SELECT l_partkey,
                sum(CAST(l_extendedprice AS DECIMAL(15,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS rev,
                sum(CAST(l_extendedprice AS DECIMAL(15,2)) * (CAST(0.12 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2))
                    - CAST(l_tax AS DECIMAL(4,2)))) AS prof
              FROM {p}li GROUP BY l_partkey) f ON f.l_partkey = p_partkey
            LEFT JOIN (SELECT l_partkey, string_agg(DISTINCT c_mktsegment, '|' ORDER BY c_mktsegment) AS mc
              FROM {p}li JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
              GROUP BY l_partkey) y ON y.l_partkey = p_partkey
            WHERE p_partkey % 10 >= 4
            UNION ALL SELECT {spelling(b2, 3)}, 'WHOLESALE|BUILDING', CAST(p_retailprice AS DOUBLE), NULL, 'source2', {_q(batch)}
            FROM {p}pt WHERE p_partkey % 50 IN (4, 7)
            UNION ALL SELECT 'Limited', NULL, CAST(p_retailprice AS DOUBLE), 0.0::DOUBLE, 'source2', {_q(batch)}
            FROM {p}pt WHERE p_partkey % 100 = 6)""",
    ]


def _items(c: str) -> str:
    """Union of the pipe lists of a group."""
    return (f"CASE WHEN count({c}) > 0 THEN array_to_string(list_sort(list_distinct(flatten(list({parse_list(c)}) "
            f"FILTER ({c} IS NOT NULL)))), '|') END AS {c}")


def _collapsed(side: str) -> str:
    """What the rows of one name (or one blank row id) say together."""
    if side == "s1":
        addr = "min(CASE WHEN trim(address) <> '' THEN address END)"
        return (f"min(corporate_name_s1) AS corporate_name_s1, {addr} AS address, {address(addr)} AS clean_address_s1, "
                f"{_items('activity_places')}, {_items('top_suppliers')}, min(batch_id_s1) AS batch_id_s1")
    order = "ORDER BY revenue DESC NULLS LAST, profit DESC NULLS LAST"
    return (f"min(corporate_name_s2) AS corporate_name_s2, {_items('main_customers')}, "
            f"first(revenue {order}) AS revenue, first(profit {order}) AS profit, min(batch_id_s2) AS batch_id_s2")


def linkage_ctes(p: str) -> list[str]:
    best_cols = ", ".join([f"u1.{c}" for c in S1_COLS] + [f"u2.{c}" for c in S2_COLS])

    def ent(select_id: str, kind: str, conf: str, score: str, src: str, s1: bool, s2: bool, where: str = "") -> str:
        cols = []
        for c in ENTITY_COLS[5:]:
            side1, side2 = c in S1_COLS, c in S2_COLS
            cols.append(c if (side1 and s1) or (side2 and s2) else f"NULL AS {c}")
        canon = {"source1_only": "corporate_name_s1", "source2_only": "corporate_name_s2"}.get(
            kind, "coalesce(corporate_name_s1, corporate_name_s2)")
        return (f"SELECT {select_id} AS corporate_id, {canon} AS canonical_name, '{kind}' AS match_type, "
                f"CAST({conf} AS DOUBLE) AS match_confidence, CAST({score} AS DOUBLE) AS name_score, "
                f"{', '.join(cols)} FROM {src} {where}")

    return [
        f"""{p}p1 AS (SELECT *, {clean('corporate_name_s1')} AS clean_name_s1, sha256(concat_ws('|', 's1', {enc('corporate_name_s1')}, {enc('address')}, {enc('activity_places')},
                     {enc('top_suppliers')})) AS row_id_s1, batch_id AS batch_id_s1 FROM {p}s1)""",
        f"""{p}p2 AS (SELECT *, {clean('corporate_name_s2')} AS clean_name_s2,
              sha256(concat_ws('|', 's2', {enc('corporate_name_s2')}, {enc('main_customers')}, {enc(money('revenue'))},
                     {enc(money('profit'))})) AS row_id_s2, batch_id AS batch_id_s2 FROM {p}s2)""",
        f"""{p}n1 AS (SELECT clean_name_s1, count(*) AS n_rows_s1, min(row_id_s1) AS row_id_s1, {_collapsed('s1')}
              FROM {p}p1 WHERE clean_name_s1 <> '' GROUP BY clean_name_s1)""",
        f"""{p}n2 AS (SELECT clean_name_s2, count(*) AS n_rows_s2, min(row_id_s2) AS row_id_s2, {_collapsed('s2')}
              FROM {p}p2 WHERE clean_name_s2 <> '' GROUP BY clean_name_s2)""",
        f"""{p}bl1 AS (SELECT '' AS clean_name_s1, count(*) AS n_rows_s1, row_id_s1, {_collapsed('s1')}
              FROM {p}p1 WHERE clean_name_s1 = '' GROUP BY row_id_s1)""",
        f"""{p}bl2 AS (SELECT '' AS clean_name_s2, count(*) AS n_rows_s2, row_id_s2, {_collapsed('s2')}
              FROM {p}p2 WHERE clean_name_s2 = '' GROUP BY row_id_s2)""",
        f"{p}ex AS (SELECT * FROM {p}n1 JOIN {p}n2 ON clean_name_s1 = clean_name_s2)",
        f"{p}u1 AS (SELECT * FROM {p}n1 WHERE NOT EXISTS (SELECT 1 FROM {p}n2 WHERE clean_name_s2 = clean_name_s1))",
        f"{p}u2 AS (SELECT * FROM {p}n2 WHERE NOT EXISTS (SELECT 1 FROM {p}n1 WHERE clean_name_s1 = clean_name_s2))",
        f"""{p}pr AS (SELECT a.clean_name_s1, b.clean_name_s2, a.st AS sorted_s1, b.st AS sorted_s2,
              length(a.st) AS la, length(b.st) AS lb
            FROM (SELECT clean_name_s1, substr(clean_name_s1, 1, 6) AS block, {sort_tokens('clean_name_s1')} AS st FROM {p}u1) a
            JOIN (SELECT clean_name_s2, substr(clean_name_s2, 1, 6) AS block, {sort_tokens('clean_name_s2')} AS st FROM {p}u2) b
              ON a.block = b.block)""",
        f"""{p}sc AS (SELECT clean_name_s1, clean_name_s2,
              CASE WHEN la = 0 OR lb = 0 THEN 0.0::DOUBLE
                   ELSE (1.0::DOUBLE - CAST(la + lb - 2 * lcs AS DOUBLE) / CAST(la + lb AS DOUBLE)) * 100.0::DOUBLE END
                AS name_score
            FROM (SELECT *, CASE WHEN la <= lb THEN {lcs('sorted_s1', 'sorted_s2')}
                                 ELSE {lcs('sorted_s2', 'sorted_s1')} END AS lcs FROM {p}pr))""",
        f"""{p}best AS (SELECT clean_name_s1, clean_name_s2, name_score FROM (
              SELECT *, row_number() OVER (PARTITION BY clean_name_s1 ORDER BY name_score DESC, clean_name_s2) AS rk
              FROM {p}sc WHERE name_score >= {THRESHOLD}) WHERE rk = 1)""",
        f"""{p}fz AS (SELECT b.name_score, {best_cols} FROM {p}best b
              JOIN {p}u1 u1 ON u1.clean_name_s1 = b.clean_name_s1 JOIN {p}u2 u2 ON u2.clean_name_s2 = b.clean_name_s2)""",
        f"""{p}ent AS (
            {ent('sha256(clean_name_s1)', 'exact_name', '100.0', 'NULL', f'{p}ex', True, True)}
            UNION ALL {ent('sha256(clean_name_s1)', 'fuzzy_name', 'name_score', 'name_score', f'{p}fz', True, True)}
            UNION ALL {ent('sha256(clean_name_s1)', 'source1_only', '0.0', 'NULL', f'{p}u1', True, False,
                           f'WHERE clean_name_s1 NOT IN (SELECT clean_name_s1 FROM {p}best)')}
            UNION ALL {ent('row_id_s1', 'source1_only', '0.0', 'NULL', f'{p}bl1', True, False)}
            UNION ALL {ent('sha256(clean_name_s2)', 'source2_only', '0.0', 'NULL', f'{p}u2', False, True,
                           f'WHERE clean_name_s2 NOT IN (SELECT clean_name_s2 FROM {p}best)')}
            UNION ALL {ent('row_id_s2', 'source2_only', '0.0', 'NULL', f'{p}bl2', False, True)})""",
        f"""{p}reg AS (SELECT corporate_id, canonical_name, coalesce(address, '') AS canonical_address,
              coalesce(activity_places, '') AS activity_places, coalesce(top_suppliers, '') AS top_suppliers,
              coalesce(main_customers, '') AS main_customers,
              coalesce(TRY_CAST(revenue AS DOUBLE), 0.0::DOUBLE) AS revenue,
              coalesce(TRY_CAST(profit AS DOUBLE), 0.0::DOUBLE) AS profit,
              match_confidence, corporate_name_s1 IS NOT NULL AS source1_present,
              corporate_name_s2 IS NOT NULL AS source2_present,
              coalesce(batch_id_s1, batch_id_s2, 'unknown') AS batch_id, match_type FROM {p}ent)""",
    ]


def feature_ctes(p: str) -> list[str]:
    def num(c: str) -> str:
        return f"CASE WHEN {c} IS NULL OR isnan({c}) THEN 0.0::DOUBLE ELSE {c} END"
    return [
        f"""{p}ft AS (SELECT corporate_id, {num('revenue')} AS revenue, {num('profit')} AS profit,
              top_suppliers, main_customers, activity_places,
              CAST(len({parse_list('top_suppliers')}) AS INTEGER) AS num_top_suppliers,
              CAST(len({parse_list('main_customers')}) AS INTEGER) AS num_main_customers,
              CAST(len({parse_list('activity_places')}) AS INTEGER) AS num_activity_places,
              CAST(CASE WHEN {num('profit')} > {PROFIT_THRESHOLD} THEN 1 ELSE 0 END AS INTEGER) AS label
            FROM {p}reg)""",
    ]


def chain(batch: str = "batch_001", cutoff: str | None = None, p: str = "") -> list[str]:
    return fixture_ctes(p, batch, cutoff) + linkage_ctes(p) + feature_ctes(p)


def with_(body: str, ctes: list[str]) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


BASE = chain()
BATCHES = chain("batch_001", FIRST_BATCH_CUTOFF, "a_") + chain("batch_002", None, "b_")
NO_TS = ", ".join(REGISTRY_NO_TS)
FEATURE_COLS = "corporate_id, revenue, profit, num_top_suppliers, num_main_customers, num_activity_places, label"


def _quality(source: str, rel: str, name: str | None, revenue: str | None) -> str:
    aggs = ["count(*) AS n_rows"]
    if name:
        aggs.append(f"count_if({name} IS NULL OR trim({name}) = '') AS blank_names")
    if revenue:
        aggs += [f"count_if({revenue} < 0) AS negative_revenue", f"max({revenue}) AS max_revenue",
                 f"avg({revenue}) AS avg_revenue"]
    parts = [f"SELECT '{source}' AS source, 'min_row_count' AS rule, CAST(NULL AS VARCHAR) AS column_name, "
             f"CAST(n_rows AS DOUBLE) AS observed, CAST({MIN_ROWS} AS DOUBLE) AS threshold, n_rows >= {MIN_ROWS} AS passed FROM st"]
    if name:
        parts.append(f"SELECT '{source}', 'non_blank', '{name}', CAST(blank_names AS DOUBLE), 0.0::DOUBLE, blank_names = 0 FROM st")
    if revenue:
        parts.append(f"SELECT '{source}', 'non_negative', '{revenue}', CAST(negative_revenue AS DOUBLE), 0.0::DOUBLE, "
                     f"negative_revenue = 0 FROM st")
        parts.append(f"SELECT '{source}', 'revenue_spread', '{revenue}', round(max_revenue / avg_revenue, 6), 1000.0::DOUBLE, "
                     f"(max_revenue IS NULL OR avg_revenue IS NULL OR NOT (max_revenue > avg_revenue * 1000.0)) FROM st")
    return f"st AS (SELECT {', '.join(aggs)} FROM {rel})", "\nUNION ALL ".join(parts)


def _quality_sql(ctes, source, rel, name, revenue):
    st, body = _quality(source, rel, name, revenue)
    return with_(body, ctes + [st])


def _upsert_body(legacy: bool = False) -> str:
    if legacy:
        cols = ", ".join(f"s.{c}" if c != "match_type" else
                         "CASE WHEN t.corporate_id IS NOT NULL THEN t.match_type ELSE s.match_type END AS match_type"
                         for c in REGISTRY_NO_TS)
        matched = f"SELECT {cols} FROM b_reg s LEFT JOIN a_reg t ON s.corporate_id = t.corporate_id"
    else:
        matched = f"SELECT {NO_TS} FROM b_reg"
    return (f"{matched}\nUNION ALL SELECT {NO_TS} FROM a_reg "
            f"WHERE corporate_id NOT IN (SELECT corporate_id FROM b_reg)")


S1_RAW = "corporate_name_s1, address, activity_places, top_suppliers"
S2_RAW = "corporate_name_s2, main_customers, revenue, profit"


def _link_rows_body() -> str:
    own1 = ", ".join(f"p.{c}" for c in S1_RAW.split(", ")) + ", NULL AS corporate_name_s2, NULL AS main_customers, NULL::DOUBLE AS revenue, NULL::DOUBLE AS profit"
    own2 = "NULL AS corporate_name_s1, NULL AS address, NULL AS activity_places, NULL AS top_suppliers, " + ", ".join(f"p.{c}" for c in S2_RAW.split(", "))
    return f"""SELECT 'source1' AS source, p.row_id_s1 AS row_id, e.corporate_id, e.match_type, {own1}
      FROM p1 p JOIN ent e ON p.clean_name_s1 = e.clean_name_s1 WHERE p.clean_name_s1 <> ''
    UNION ALL SELECT 'source1', p.row_id_s1, e.corporate_id, e.match_type, {own1}
      FROM p1 p JOIN ent e ON p.row_id_s1 = e.row_id_s1 AND e.clean_name_s1 = '' WHERE p.clean_name_s1 = ''
    UNION ALL SELECT 'source2', p.row_id_s2, e.corporate_id, e.match_type, {own2}
      FROM p2 p JOIN ent e ON p.clean_name_s2 = e.clean_name_s2 WHERE p.clean_name_s2 <> ''
    UNION ALL SELECT 'source2', p.row_id_s2, e.corporate_id, e.match_type, {own2}
      FROM p2 p JOIN ent e ON p.row_id_s2 = e.row_id_s2 AND e.clean_name_s2 = '' WHERE p.clean_name_s2 = ''"""


_AUC = """SELECT CASE WHEN 2 * pp * nn > 0 THEN CAST(num AS DOUBLE) / CAST(2 * pp * nn AS DOUBLE) END AS auc,
              CAST(pp AS BIGINT) AS positives, CAST(nn AS BIGINT) AS negatives
            FROM (SELECT sum(CAST(pos AS HUGEINT) * (2 * below + neg)) AS num, sum(pos) AS pp, sum(neg) AS nn FROM (
              SELECT *, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
              FROM (SELECT CAST(revenue AS DOUBLE) AS s, count_if(label = 1) AS pos, count_if(label <> 1) AS neg
                    FROM ft WHERE revenue IS NOT NULL GROUP BY 1)))"""


def _common_characters(a: str, b: str) -> str:
    """Characters common to two names by counts: five of each kind, and the smaller number of further ones."""
    def n(x: str, c: str) -> str:
        return f"least(length({x}) - length(replace({x}, '{c}', '')), 5)"
    kinds = "abcdefghijklmnopqrstuvwxyz0123456789 "
    rest = [f"(length({x}) - ({' + '.join(n(x, c) for c in kinds)}))" for x in (a, b)]
    return f"({' + '.join(f'least({n(a, c)}, {n(b, c)})' for c in kinds)} + least({rest[0]}, {rest[1]}))"


PRUNING = f"""SELECT a.block, names_s1, names_s2, CAST(CAST(names_s1 AS HUGEINT) * names_s2 AS DECIMAL(38,0)) AS pairs_in_block,
      coalesce(pairs_scored, 0) AS pairs_scored, coalesce(pairs_passing, 0) AS pairs_passing
    FROM (SELECT substr(clean_name_s1, 1, 6) AS block, count(*) AS names_s1 FROM u1 GROUP BY 1) a
    JOIN (SELECT substr(clean_name_s2, 1, 6) AS block, count(*) AS names_s2 FROM u2 GROUP BY 1) b ON a.block = b.block
    LEFT JOIN (SELECT substr(clean_name_s1, 1, 6) AS block, count(*) AS pairs_scored, CAST(count_if(name_score >= {THRESHOLD}) AS BIGINT) AS pairs_passing
               FROM pr JOIN sc USING (clean_name_s1, clean_name_s2)
               WHERE {_common_characters('sorted_s1', 'sorted_s2')} >= (la + lb) * ({THRESHOLD} / 200.0) - 0.000001 GROUP BY 1) c ON c.block = a.block"""

# pairs in one order, best first; each is matched if neither of its names is taken yet
ONE_TO_ONE_THRESHOLD = 50.0
ONE_TO_ONE = [
    f"""ranked AS MATERIALIZED (SELECT row_number() OVER (ORDER BY name_score DESC, clean_name_s1, clean_name_s2) AS i, *
          FROM sc WHERE name_score >= {ONE_TO_ONE_THRESHOLD})""",
    """walk(i, taken1, taken2, matched) AS (
          SELECT 0::BIGINT, []::VARCHAR[], []::VARCHAR[], false
          UNION ALL SELECT r.i, CASE WHEN free THEN list_append(taken1, clean_name_s1) ELSE taken1 END,
                           CASE WHEN free THEN list_append(taken2, clean_name_s2) ELSE taken2 END, free
          FROM (SELECT r.*, taken1, taken2, NOT list_contains(taken1, r.clean_name_s1) AND NOT list_contains(taken2, r.clean_name_s2) AS free
                FROM walk w JOIN ranked r ON r.i = w.i + 1) r)"""]


def _held(p: str) -> str:
    return "\nUNION ALL ".join(f"SELECT corporate_id, '{s}' || CASE WHEN clean_name_{s} = '' THEN '#' || row_id_{s} ELSE ':' || clean_name_{s} END AS name "
                               f"FROM {p}ent WHERE clean_name_{s} IS NOT NULL" for s in ("s1", "s2"))


SUCCESSION = [
    f"olds AS MATERIALIZED ({_held('a_')})", f"news AS MATERIALIZED ({_held('b_')})",
    """edges AS MATERIALIZED (
        SELECT 'old:' || corporate_id AS x, name AS y FROM olds UNION ALL SELECT 'new:' || corporate_id, name FROM news
        UNION ALL SELECT name, 'old:' || corporate_id FROM olds UNION ALL SELECT name, 'new:' || corporate_id FROM news)""",
    "reach(origin, node) AS (SELECT x, x FROM edges WHERE x LIKE 'old:%' UNION SELECT origin, y FROM reach JOIN edges ON x = node)",
    """parts AS (SELECT substr(origin, 5) AS corporate_id, CAST(count_if(node LIKE 'old:%') AS BIGINT) AS n_old, CAST(count_if(node LIKE 'new:%') AS BIGINT) AS n_new
        FROM reach GROUP BY origin)"""]


# the first batch's rows, and the later ones whose name it lacks
INCREMENT_CUTOFF = "1992-05-01"
INCREMENT = fixture_ctes("e_", "batch_001", INCREMENT_CUTOFF) + fixture_ctes("l_", "batch_002", None) + [
    f"c_{s} AS (SELECT * FROM e_{s} UNION ALL SELECT * FROM l_{s} WHERE {clean(n)} NOT IN (SELECT {clean(n)} FROM e_{s}))"
    for s, n in (("s1", "corporate_name_s1"), ("s2", "corporate_name_s2"))] + linkage_ctes("c_")


# Newton's method for the logistic model, written out step by step: features scaled by the training rows' mean and spread, five coefficients.
LOGISTIC_FEATURES = ("revenue", "num_top_suppliers", "num_main_customers", "num_activity_places")
NEWTON_STEPS = 14
TEST_SPLIT = "substr(sha256(CAST(corporate_id AS VARCHAR)), 1, 6) >= 'cccccc'"


def _solved(source: str, n: int) -> str:
    """SELECT d0.. FROM ``source`` (a00.., r0..: a symmetric system) by elimination, one nested query a column."""
    inner = source
    for j in range(n):
        rows = []
        for i in range(n):
            for k in range(n):
                rows.append(f"a{i}{k} - a{i}{j} / a{j}{j} * a{j}{k} AS a{i}{k}" if i != j else f"a{i}{k}")
            rows.append(f"r{i} - a{i}{j} / a{j}{j} * r{j} AS r{i}" if i != j else f"r{i}")
        inner = f"(SELECT {', '.join(rows)} FROM {inner})"
    return f"(SELECT {', '.join(f'r{i} / a{i}{i} AS d{i}' for i in range(n))} FROM {inner})"


def newton_ctes() -> list[str]:
    n = len(LOGISTIC_FEATURES) + 1
    scale = ", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(LOGISTIC_FEATURES, 1))
    x = ", ".join(f"(ft.{c} - m{i}) / CASE WHEN s{i} > 0 THEN s{i} ELSE 1 END AS x{i}" for i, c in enumerate(LOGISTIC_FEATURES, 1))
    p = "1 / (1 + exp(-(" + " + ".join(f"b{i} * x{i}" for i in range(n)) + ")))"
    sums = [f"sum(p * (1 - p) * x{i} * x{k}) AS a{i}{k}" for i in range(n) for k in range(n)] + [f"sum((label - p) * x{i}) AS r{i}" for i in range(n)]
    out = [f"scaled AS (SELECT {scale} FROM ft WHERE NOT {TEST_SPLIT})",
           f"xs AS MATERIALIZED (SELECT ft.*, {TEST_SPLIT} AS is_test, 1.0::DOUBLE AS x0, {x} FROM ft, scaled)",
           f"beta0 AS (SELECT {', '.join(f'0.0::DOUBLE AS b{i}' for i in range(n))})"]
    for step in range(NEWTON_STEPS):
        system = f"(SELECT {', '.join(sums)} FROM (SELECT xs.*, {p} AS p FROM xs, beta{step} WHERE NOT is_test))"
        out.append(f"beta{step + 1} AS MATERIALIZED (SELECT {', '.join(f'b{i} + d{i} AS b{i}' for i in range(n))} FROM beta{step}, {_solved(system, n)})")
    out.append(f"sco AS MATERIALIZED (SELECT xs.*, {p} AS score FROM xs, beta{NEWTON_STEPS})")
    return out


def _optimality() -> str:
    terms = {"intercept": "1.0::DOUBLE", **{c: f"CAST({c} AS DOUBLE)" for c in LOGISTIC_FEATURES}}
    return "\nUNION ALL ".join(f"SELECT '{c}' AS coefficient, round(sum(abs({v})), 2) AS weight, round(abs(sum((score - label) * {v})) / sum(abs({v})), 5) AS residual "
                               f"FROM sco WHERE NOT is_test" for c, v in terms.items())


MODEL_METRICS = f"""SELECT 'fitted' AS run_id, 'batch_001' AS batch_id, 'model' AS kind, name, value, txt AS "text" FROM (
      SELECT 'auc' AS name, round(CAST(sum(CASE WHEN a.score > b.score THEN 2 WHEN a.score = b.score THEN 1 ELSE 0 END) AS DOUBLE) / (2.0::DOUBLE * count(*)), 3) AS value, NULL::VARCHAR AS txt
      FROM (SELECT score FROM sco WHERE is_test AND label = 1) a, (SELECT score FROM sco WHERE is_test AND label = 0) b
      UNION ALL SELECT 'prediction_rate', avg(CAST(score > 0.5 AS INTEGER)), NULL FROM sco WHERE is_test
      UNION ALL SELECT 'drifted', CASE WHEN avg(CAST(score > 0.5 AS INTEGER)) BETWEEN 0.5::DOUBLE - 0.15::DOUBLE AND 0.5::DOUBLE + 0.15::DOUBLE THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END, NULL FROM sco WHERE is_test
      UNION ALL SELECT 'train_count', CAST(count_if(NOT is_test) AS DOUBLE), NULL FROM sco
      UNION ALL SELECT 'test_count', CAST(count_if(is_test) AS DOUBLE), NULL FROM sco
      UNION ALL SELECT 'features', NULL, '{",".join(LOGISTIC_FEATURES)}')"""


def statements() -> dict[str, str]:
    names = ("SELECT 'source1' AS source, corporate_name_s1 AS raw_name FROM s1 "
             "UNION ALL SELECT 'source2', corporate_name_s2 FROM s2")
    lists = ("SELECT 'top_suppliers' AS field, top_suppliers AS raw_list FROM s1 "
             "UNION ALL SELECT 'activity_places', activity_places FROM s1 "
             "UNION ALL SELECT 'main_customers', main_customers FROM s2")
    recon_counts = """SELECT (SELECT count(*) FROM s1) AS s1r, (SELECT count(*) FROM s2) AS s2r,
        (SELECT count(*) FROM reg) AS fin,
        (SELECT CAST(count_if(match_type = 'exact_name') AS BIGINT) FROM reg) AS ex,
        (SELECT CAST(count_if(match_type = 'fuzzy_name') AS BIGINT) FROM reg) AS fz,
        (SELECT CAST(count_if(match_type = 'source1_only') AS BIGINT) FROM reg) AS o1,
        (SELECT CAST(count_if(match_type = 'source2_only') AS BIGINT) FROM reg) AS o2"""
    split = f"CASE WHEN substr(sha256(CAST(corporate_id AS VARCHAR)), 1, 6) < 'cccccc' THEN 'train' ELSE 'test' END"
    rule = f"CAST(revenue > {RULE_REVENUE_CUTOFF} AS INTEGER)"
    return {
        "source1_scan": with_("SELECT corporate_name_s1, address, activity_places, top_suppliers, source_name, batch_id FROM s1", BASE),
        "source2_scan": with_("SELECT corporate_name_s2, main_customers, revenue, profit, source_name, batch_id FROM s2", BASE),
        "clean_names": with_(f"SELECT source, raw_name, {clean('raw_name')} AS clean_name FROM ({names})", BASE),
        "block_keys": with_(f"SELECT source, raw_name, {clean('raw_name')} AS clean_name, "
                            f"substr({clean('raw_name')}, 1, 6) AS block FROM ({names})", BASE),
        "clean_addresses": with_(f"SELECT address, {address('address')} AS clean_address FROM s1", BASE),
        "parse_lists": with_(f"SELECT field, raw_list, array_to_string({parse_list('raw_list')}, '|') AS items, "
                             f"CAST(len({parse_list('raw_list')}) AS INTEGER) AS n_items FROM ({lists})", BASE),
        "exact_match": with_("SELECT clean_name_s1, corporate_name_s1, corporate_name_s2, revenue, "
                             "'exact_name' AS match_type, 100.0::DOUBLE AS match_confidence FROM ex", BASE),
        "unmatched_source1": with_("SELECT clean_name_s1, corporate_name_s1, row_id_s1, n_rows_s1 FROM u1", BASE),
        "unmatched_source2": with_("SELECT clean_name_s2, corporate_name_s2, row_id_s2, n_rows_s2 FROM u2", BASE),
        # the operator scores the pairs that can reach the threshold; of these, all that do
        "token_sort_scores": with_(f"SELECT clean_name_s1, clean_name_s2, name_score FROM sc WHERE name_score >= {THRESHOLD}", BASE),
        "fuzzy_match": with_("SELECT clean_name_s1, clean_name_s2, name_score, 'fuzzy_name' AS match_type, "
                             "name_score AS match_confidence FROM fz", BASE),
        "pair_pruning": with_(PRUNING, BASE),
        "one_to_one_matches": "WITH RECURSIVE " + ",\n".join(BASE + ONE_TO_ONE) + "\nSELECT clean_name_s1, clean_name_s2, name_score FROM walk JOIN ranked USING (i) WHERE matched",
        "entity_succession": "WITH RECURSIVE " + ",\n".join(BATCHES + SUCCESSION) + """
            SELECT o.corporate_id AS stale_id, min(n.corporate_id) AS successor_id, count(DISTINCT n.corporate_id) AS n_successors,
              CASE WHEN n_new = 0 THEN 'gone' WHEN n_old = 1 AND n_new = 1 THEN 'renamed' WHEN n_new = 1 THEN 'merged'
                   WHEN n_old = 1 THEN 'split' ELSE 'regrouped' END AS kind, n_old, n_new
            FROM (SELECT * FROM olds WHERE corporate_id NOT IN (SELECT corporate_id FROM news)) o
            LEFT JOIN (SELECT corporate_id AS cid, name FROM news) n0 USING (name) LEFT JOIN (SELECT DISTINCT corporate_id FROM news) n ON n.corporate_id = n0.cid
            JOIN parts p ON p.corporate_id = o.corporate_id GROUP BY o.corporate_id, n_old, n_new""",
        "source1_only": with_("SELECT corporate_id, canonical_name, match_confidence FROM ent WHERE match_type = 'source1_only'", BASE),
        "source2_only": with_("SELECT corporate_id, canonical_name, match_confidence FROM ent WHERE match_type = 'source2_only'", BASE),
        "resolve_entities": with_("SELECT corporate_id, canonical_name, match_type, match_confidence, clean_name_s1, "
                                  "clean_name_s2, row_id_s1, row_id_s2, n_rows_s1, n_rows_s2, clean_address_s1, revenue, "
                                  "profit FROM ent", BASE),
        "incremental_entities": with_("SELECT corporate_id, canonical_name, match_type, match_confidence, clean_name_s1, "
                                      "clean_name_s2, row_id_s1, row_id_s2, n_rows_s1, n_rows_s2, clean_address_s1, revenue, "
                                      "profit, batch_id_s1, batch_id_s2 FROM c_ent", INCREMENT),
        "harmonized_registry": with_(f"SELECT {NO_TS} FROM reg", BASE),
        "link_rows": with_(_link_rows_body(), BASE),
        "duplicate_keys": with_(f"SELECT corporate_id, count(*) AS copies FROM ({_link_rows_body()}) "
                                f"GROUP BY corporate_id HAVING count(*) > 1", BASE),
        "upsert_registry": with_(_upsert_body(), BATCHES),
        "upsert_partial_columns": with_(_upsert_body(legacy=True), BATCHES),
        "upsert_actions": with_("SELECT s.corporate_id, CASE WHEN EXISTS (SELECT 1 FROM a_reg t WHERE "
                                "t.corporate_id = s.corporate_id) THEN 'update' ELSE 'insert' END AS action FROM b_reg s",
                                BATCHES),
        "registry_store": with_(_upsert_body(), BATCHES),
        "registry_bucketed": with_(_upsert_body(), BATCHES),
        "stale_registry_rows": with_(f"SELECT {NO_TS} FROM a_reg WHERE corporate_id NOT IN (SELECT corporate_id FROM b_reg)",
                                     BATCHES),
        "quality_source1": _quality_sql(BASE, "source1", "s1", "corporate_name_s1", None),
        "quality_source2": _quality_sql(BASE, "source2", "s2", "corporate_name_s2", "revenue"),
        "quality_customer": _quality_sql([], "source2", "(SELECT c_name AS corporate_name_s2, c_acctbal AS revenue FROM customer)",
                                         "corporate_name_s2", "revenue"),
        "match_type_counts": with_("SELECT count(*) AS final_rows, CAST(count_if(match_type = 'exact_name') AS BIGINT) AS exact_matches, "
                                   "CAST(count_if(match_type = 'fuzzy_name') AS BIGINT) AS fuzzy_matches, "
                                   "CAST(count_if(match_type = 'source1_only') AS BIGINT) AS source1_only, "
                                   "CAST(count_if(match_type = 'source2_only') AS BIGINT) AS source2_only FROM reg", BASE),
        "reconciliation": with_(f"""SELECT s1r AS source1_rows, s2r AS source2_rows, fin AS final_rows,
              s1r + s2r - fin AS duplicates_removed, ex AS exact_matches, fz AS fuzzy_matches,
              o1 AS source1_only, o2 AS source2_only,
              round(CAST(ex + fz AS DOUBLE) / CAST(greatest(fin, 1) AS DOUBLE) * 100.0::DOUBLE, 2) AS match_rate_pct
            FROM ({recon_counts})""", BASE),
        "registry_view_counts": with_("""SELECT match_type, count(*) AS rows,
              CAST(count_if(source1_present AND source2_present) AS BIGINT) AS both_sources,
              min(match_confidence) AS min_confidence, max(match_confidence) AS max_confidence
            FROM reg GROUP BY match_type""", BASE),
        "block_stats": with_("""SELECT coalesce(a.block, b.block) AS block, coalesce(names_s1, 0) AS names_s1,
              coalesce(rows_s1, 0) AS rows_s1, coalesce(names_s2, 0) AS names_s2, coalesce(rows_s2, 0) AS rows_s2,
              CAST(CAST(coalesce(names_s1, 0) AS HUGEINT) * coalesce(names_s2, 0) AS DECIMAL(38,0)) AS candidate_pairs
            FROM (SELECT substr(clean_name_s1, 1, 6) AS block, count(DISTINCT clean_name_s1) AS names_s1,
                    count(*) AS rows_s1 FROM p1 WHERE clean_name_s1 <> '' GROUP BY 1) a
            FULL OUTER JOIN (SELECT substr(clean_name_s2, 1, 6) AS block, count(DISTINCT clean_name_s2) AS names_s2,
                    count(*) AS rows_s2 FROM p2 WHERE clean_name_s2 <> '' GROUP BY 1) b ON a.block = b.block""", BASE),
        "consolidation_drift": with_("""SELECT 'consolidation_ratio' AS metric, v AS current_value,
              0.25::DOUBLE AS historical_avg, 0.15::DOUBLE AS tolerance,
              (v < 0.25::DOUBLE - 0.15::DOUBLE OR v > 0.25::DOUBLE + 0.15::DOUBLE) AS is_anomaly
            FROM (SELECT round(CAST((SELECT count(*) FROM reg) AS DOUBLE)
                  / CAST(greatest((SELECT count(*) FROM s1) + (SELECT count(*) FROM s2), 1) AS DOUBLE), 4) AS v)""", BASE),
        "ml_features": with_(f"SELECT {FEATURE_COLS} FROM ft", BASE),
        "ml_features_compat": with_(f"""SELECT corporate_id, revenue, profit,
              CAST(coalesce(len(string_split(top_suppliers, '|')), -1) AS INTEGER) AS num_top_suppliers,
              CAST(coalesce(len(string_split(main_customers, '|')), -1) AS INTEGER) AS num_main_customers,
              CAST(coalesce(len(string_split(activity_places, '|')), -1) AS INTEGER) AS num_activity_places,
              label FROM ft""", BASE),
        "training_export": with_("SELECT corporate_id, revenue, profit, top_suppliers, main_customers, activity_places, "
                                 "num_top_suppliers, num_main_customers, num_activity_places, label FROM ft", BASE),
        "training_from_csv": with_(f"""SELECT coalesce(revenue, 0.0::DOUBLE) AS revenue, coalesce(profit, 0.0::DOUBLE) AS profit,
              0 AS num_top_suppliers, CAST(len({parse_list('main_customers')}) AS INTEGER) AS num_main_customers,
              0 AS num_activity_places,
              CAST(CASE WHEN coalesce(profit, 0.0) > {PROFIT_THRESHOLD} THEN 1 ELSE 0 END AS INTEGER) AS label
            FROM s2""", BASE),
        "hash_split": with_(f"SELECT corporate_id, label, {split} AS split FROM ft", BASE),
        "stratified_split": with_("""SELECT corporate_id, label,
              CASE WHEN row_number() OVER (PARTITION BY label ORDER BY sha256(CAST(corporate_id AS VARCHAR)), corporate_id)
                        <= ceil(count(*) OVER (PARTITION BY label) * 0.2) THEN 'test' ELSE 'train' END AS split
            FROM ft""", BASE),
        "train_test_counts": with_(f"SELECT CAST(count_if({split} = 'train') AS BIGINT) AS train_count, "
                                   f"CAST(count_if({split} = 'test') AS BIGINT) AS test_count FROM ft", BASE),
        "rank_auc": with_(_AUC, BASE),
        "logistic_scores": with_("SELECT corporate_id, label, CAST(score > 0.5 AS INTEGER) AS prediction, round(score, 3) AS prediction_score FROM sco WHERE is_test",
                                 BASE + newton_ctes()),
        "logistic_optimality": with_(_optimality(), BASE + newton_ctes()),
        "model_metrics": with_(MODEL_METRICS, BASE + newton_ctes()),
        "forest_scores": with_(f"SELECT corporate_id, label, true AS score_in_range, true AS prediction_agrees FROM ft WHERE {split} = 'test'", BASE),
        "prediction_drift": with_(f"""SELECT 'prediction_rate' AS metric, v AS current_value, 0.5::DOUBLE AS historical_avg, 0.15::DOUBLE AS tolerance,
              (v < 0.5::DOUBLE - 0.15::DOUBLE OR v > 0.5::DOUBLE + 0.15::DOUBLE) AS is_anomaly
            FROM (SELECT avg({rule}) AS v FROM ft)""", BASE),
        "run_metrics": with_(f"""SELECT 'registered' AS run_id, 'batch_001' AS batch_id, 'model' AS kind, name, value, txt AS "text" FROM (
              SELECT 'auc' AS name, auc AS value, NULL::VARCHAR AS txt FROM ({_AUC})
              UNION ALL SELECT 'train_count', CAST(count_if({split} = 'train') AS DOUBLE), NULL FROM ft
              UNION ALL SELECT 'test_count', CAST(count_if({split} = 'test') AS DOUBLE), NULL FROM ft
              UNION ALL SELECT 'revenue_cutoff', NULL, '1000000')""", BASE),
        "classification_report": with_(f"""SELECT class, precision, recall, f1_score, support FROM (
              SELECT cls AS class, precision, recall,
                CASE WHEN precision + recall > 0 THEN 2.0::DOUBLE * precision * recall / (precision + recall) ELSE 0.0::DOUBLE END AS f1_score,
                support FROM (
                SELECT cls, support, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0::DOUBLE END AS precision,
                  CASE WHEN support > 0 THEN tp / support ELSE 0.0::DOUBLE END AS recall FROM (
                  SELECT c.cls, coalesce((SELECT count(*) FROM cr WHERE y = c.cls), 0) AS support,
                    coalesce((SELECT count(*) FROM cr WHERE y = c.cls AND p = c.cls), 0) AS tp,
                    coalesce((SELECT count(*) FROM cr WHERE p = c.cls), 0) AS predicted
                  FROM (SELECT DISTINCT y AS cls FROM cr UNION SELECT DISTINCT p FROM cr) c)))
            UNION ALL SELECT 'accuracy', NULL::DOUBLE, NULL::DOUBLE,
              CAST(count_if(y = p) AS DOUBLE) / CAST(count(*) AS DOUBLE), CAST(count(*) AS BIGINT) FROM cr
            UNION ALL SELECT 'macro avg', avg_p, avg_r, avg_f, n FROM agg
            UNION ALL SELECT 'weighted avg', w_p, w_r, w_f, n FROM agg""",
                                       BASE + [f"cr AS (SELECT CAST(label AS VARCHAR) AS y, CAST({rule} AS VARCHAR) AS p FROM ft)",
                                               _report_agg()]),
    }


def _report_agg() -> str:
    per = """SELECT cls, support, precision, recall,
          CASE WHEN precision + recall > 0 THEN 2.0::DOUBLE * precision * recall / (precision + recall) ELSE 0.0::DOUBLE END AS f1
        FROM (SELECT cls, support, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0::DOUBLE END AS precision,
                CASE WHEN support > 0 THEN tp / support ELSE 0.0::DOUBLE END AS recall FROM (
              SELECT c.cls, coalesce((SELECT count(*) FROM cr WHERE y = c.cls), 0) AS support,
                coalesce((SELECT count(*) FROM cr WHERE y = c.cls AND p = c.cls), 0) AS tp,
                coalesce((SELECT count(*) FROM cr WHERE p = c.cls), 0) AS predicted
              FROM (SELECT DISTINCT y AS cls FROM cr UNION SELECT DISTINCT p FROM cr) c))"""
    return f"""agg AS (SELECT sum(precision) / count(*) AS avg_p, sum(recall) / count(*) AS avg_r, sum(f1) / count(*) AS avg_f,
          CAST(sum(support) AS BIGINT) AS n, sum(precision * support) / sum(support) AS w_p, sum(recall * support) / sum(support) AS w_r,
          sum(f1 * support) / sum(support) AS w_f FROM ({per}))"""
