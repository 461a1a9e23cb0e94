"""The registered queries as plain SQL over the same tables (DuckDB dialect).

Written from the definitions, not from the library: joins and windows where the
library stacks, aggregates and cuts.
"""

from __future__ import annotations

import re

from tallymark.plans.registry import AS_OF, EARLIER, KEYS, LATEST, PAGE, SLICE, WINDOW
from tallymark.sources import schemas

_BASE = f"""
l AS (SELECT l_orderkey, l_linenumber, MIN(l_shipdate) ship, MAX(l_returnflag) flag, MAX(l_linestatus) ls
      FROM lineitem GROUP BY l_orderkey, l_linenumber),
issuances AS (SELECT o_orderkey id, CAST(year(o_orderdate)*100+month(o_orderdate) AS BIGINT) coupon_id, o_custkey member_id,
      CONCAT('CP', CAST(o_orderkey % 997 AS VARCHAR)) code, o_orderpriority issued_grade,
      CASE o_orderstatus WHEN 'F' THEN 'USED' WHEN 'O' THEN 'ISSUED' ELSE 'EXPIRED' END status,
      o_orderdate issued_at, o_orderdate + INTERVAL '90' DAY expires_at, o_orderdate updated_at FROM orders),
histories AS (SELECT o_orderkey*100 id, o_orderkey issuance_id, 'ISSUE' event_type, CAST(NULL AS VARCHAR) from_status, 'ISSUED' to_status, o_orderdate created_at FROM orders
      UNION ALL SELECT l_orderkey*100+l_linenumber, l_orderkey, CASE flag WHEN 'A' THEN 'USE' WHEN 'R' THEN 'CANCEL_USE' ELSE 'EXPIRE' END,
        CASE flag WHEN 'R' THEN 'USED' ELSE 'ISSUED' END, CASE flag WHEN 'A' THEN 'USED' WHEN 'R' THEN 'ISSUED' ELSE 'EXPIRED' END, ship FROM l),
usages AS (SELECT l_orderkey*100+l_linenumber id, l_orderkey issuance_id, ship used_at, CASE WHEN ls='F' THEN ship + INTERVAL '30' DAY END canceled_at FROM l WHERE flag='A'),
coupons AS (SELECT coupon_id id, coupon_id % 31 + 1 eligible_grades_mask, MIN(issued_at) open_at FROM issuances GROUP BY coupon_id),
grades AS (SELECT * FROM (VALUES ('1-URGENT',1),('2-HIGH',2),('3-MEDIUM',4),('4-NOT SPECIFIED',8),('5-LOW',16)) AS g(code,bit_value)),
stocks AS (SELECT coupon_id, CASE coupon_id % 3 WHEN 0 THEN COUNT(*)+5 WHEN 1 THEN COUNT(*) ELSE CAST(FLOOR(COUNT(*)*0.66) AS BIGINT) END total_quantity,
      CAST(SUM(CASE WHEN status IN ('ISSUED','USED') THEN 1 ELSE 0 END) AS BIGINT) active_count FROM issuances GROUP BY coupon_id)"""


def _state(as_of: str, tag: str = "") -> str:
    return f"""
st{tag} AS (SELECT issuance_id, to_status state, id last_history_id, created_at last_event_at FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY issuance_id ORDER BY created_at DESC, id DESC) rn
      FROM histories WHERE created_at <= TIMESTAMP '{as_of}') t WHERE rn = 1),
act{tag} AS (SELECT issuance_id, COUNT(*) active_usage_count FROM usages WHERE used_at <= TIMESTAMP '{as_of}'
      AND (canceled_at IS NULL OR canceled_at > TIMESTAMP '{as_of}') GROUP BY issuance_id),
ch{tag} AS (SELECT *, LAG(to_status) OVER (PARTITION BY issuance_id ORDER BY created_at, id) previous
      FROM histories WHERE created_at <= TIMESTAMP '{as_of}')"""


def _rules(tag: str = "") -> str:
    return f"""
held{tag} AS (SELECT COALESCE(i.id, r.issuance_id) subject, i.coupon_id, i.status stored, r.state replayed, COALESCE(u.active_usage_count, 0) open_usages
      FROM issuances i FULL JOIN st{tag} r ON r.issuance_id = i.id LEFT JOIN act{tag} u ON u.issuance_id = r.issuance_id),
live{tag} AS (SELECT coupon_id, COUNT(*) FILTER (replayed IN ('ISSUED', 'USED')) n FROM held{tag} GROUP BY coupon_id),
v1{tag} AS (SELECT 'STOCK_MISMATCH' finding_type, CONCAT('COUPON:', coupon_id) target_key, CONCAT('active_count=', active_count) expected,
      CONCAT('issuances 집계=', COALESCE(n, 0)) actual FROM stocks LEFT JOIN live{tag} USING (coupon_id) WHERE active_count <> COALESCE(n, 0)),
seen{tag} AS (SELECT CONCAT('COUPON:', coupon_id, '|MEMBER:', member_id) target_key, code, COUNT(*) OVER (PARTITION BY coupon_id, member_id) times,
      ROW_NUMBER() OVER (PARTITION BY coupon_id, code ORDER BY id) nth FROM issuances),
v2{tag} AS (SELECT 'DUP_PER_MEMBER' finding_type, target_key, expected, actual FROM (
      SELECT target_key, '발급 1건' expected, CONCAT('발급 ', times, '건') actual FROM seen{tag} WHERE times > 1
      UNION SELECT target_key, '발급 코드 유일', CONCAT('code ', code, ' 중복') FROM seen{tag} WHERE nth > 1) w
      QUALIFY ROW_NUMBER() OVER (PARTITION BY target_key ORDER BY expected, actual) = 1),
v3{tag} AS (SELECT 'REPLAY_MISMATCH' finding_type, CONCAT('ISSUANCE:', subject) target_key, CONCAT('replay=', replayed) expected,
      CONCAT('issuances.status=', stored) actual FROM held{tag} WHERE replayed <> stored),
v4{tag} AS (SELECT 'ILLEGAL_TRANSITION' finding_type, CONCAT('HISTORY:', id) target_key, CONCAT('from_status=', COALESCE(previous, '(없음)')) expected,
      CONCAT('from_status=', COALESCE(from_status, '(NULL)'), ', ', event_type, '->', to_status) actual FROM ch{tag}
      WHERE previous IS DISTINCT FROM from_status OR NOT CASE event_type WHEN 'ISSUE' THEN from_status IS NULL AND to_status = 'ISSUED'
        WHEN 'USE' THEN from_status IS NOT DISTINCT FROM 'ISSUED' AND to_status = 'USED'
        WHEN 'CANCEL_USE' THEN from_status IS NOT DISTINCT FROM 'USED' AND to_status = 'ISSUED'
        WHEN 'CANCEL' THEN from_status IS NOT DISTINCT FROM 'ISSUED' AND to_status = 'CANCELLED'
        WHEN 'EXPIRE' THEN from_status IS NOT DISTINCT FROM 'ISSUED' AND to_status = 'EXPIRED' ELSE FALSE END),
v5{tag} AS (SELECT 'USAGE_MISMATCH' finding_type, CONCAT('ISSUANCE:', subject) target_key, CONCAT('active_usage=', (replayed = 'USED')::INT) expected,
      CONCAT('active_usage=', open_usages) actual FROM held{tag} WHERE replayed IS NOT NULL AND open_usages <> (replayed = 'USED')::INT),
v6{tag} AS (SELECT 'GRADE_VIOLATION' finding_type, CONCAT('ISSUANCE:', id) target_key, CONCAT('mask & bit != 0 (mask=', mask, ')') expected,
      CONCAT('issued_grade=', issued_grade) actual FROM (SELECT id, issued_grade,
        (SELECT eligible_grades_mask FROM coupons WHERE coupons.id = issuances.coupon_id) mask,
        (SELECT bit_value FROM grades WHERE code = issued_grade) bit FROM issuances) g WHERE mask & bit = 0),
f{tag} AS (SELECT * FROM v1{tag} UNION ALL SELECT * FROM v2{tag} UNION ALL SELECT * FROM v3{tag} UNION ALL SELECT * FROM v4{tag}
      UNION ALL SELECT * FROM v5{tag} UNION ALL SELECT * FROM v6{tag})"""


_TYPES = """(VALUES ('STOCK_MISMATCH'), ('DUP_PER_MEMBER'), ('REPLAY_MISMATCH'), ('ILLEGAL_TRANSITION'),
      ('USAGE_MISMATCH'), ('GRADE_VIOLATION')) AS t(finding_type)"""


def _with(*parts: str) -> str:
    return "WITH " + ", ".join(p.strip() for p in parts) + "\n"


_LEDGER = _with(_BASE)
_REPLAYED = _with(_BASE, _state(AS_OF))
_RULES = _with(_BASE, _state(AS_OF), _rules())

SQL: dict[str, str] = {}

# --- replay -------------------------------------------------------------------
SQL["replay_state"] = _REPLAYED + "SELECT issuance_id, state, last_history_id FROM st"
SQL["event_chain"] = _REPLAYED + "SELECT id, issuance_id, previous, from_status, to_status FROM ch"
SQL["active_usages"] = _REPLAYED + "SELECT issuance_id, active_usage_count FROM act"
SQL["asof_state"] = _REPLAYED + """SELECT CAST(1 AS BIGINT) run_id, st.issuance_id coupon_id, state, last_history_id, last_event_at,
  CAST(COALESCE(active_usage_count, 0) AS INTEGER) active_usage_count FROM st LEFT JOIN act ON act.issuance_id = st.issuance_id"""
SQL["live_counts"] = _REPLAYED + """SELECT i.coupon_id, COUNT(*) active_count FROM issuances i JOIN st ON st.issuance_id = i.id
  WHERE st.state IN ('ISSUED', 'USED') GROUP BY i.coupon_id"""

# --- rules --------------------------------------------------------------------
for _n, _name in enumerate(
    ("stock_mismatch", "dup_per_member", "replay_mismatch", "illegal_transition", "usage_mismatch", "grade_violation"), 1
):
    SQL[f"v{_n}_{_name}"] = _RULES + f"SELECT target_key, expected, actual FROM v{_n}"
SQL["all_findings"] = _RULES + "SELECT finding_type, target_key, expected, actual FROM f"
SQL["finding_counts"] = _RULES + f"""SELECT t.finding_type, COUNT(f.target_key) finding_count FROM {_TYPES}
  LEFT JOIN f ON f.finding_type = t.finding_type GROUP BY t.finding_type"""
SQL["numbered_findings"] = _RULES + """SELECT ROW_NUMBER() OVER (ORDER BY finding_type, target_key) id, CAST(1 AS BIGINT) run_id,
  finding_type, target_key, expected, actual FROM f"""
_WORDS = ", ".join(f"CAST(COALESCE(SUM(CAST('0x' || substr(h, {8 * i + 1}, 8) AS BIGINT)), 0) % 4294967296 AS BIGINT)" for i in range(8))
SQL["findings_checksum"] = _RULES + f"""SELECT sha256(CONCAT_WS(':', COUNT(*), {_WORDS})) findings_checksum
  FROM (SELECT DISTINCT sha256(CONCAT(finding_type, chr(31), target_key, chr(30))) h FROM f) d"""
SQL["dataset_fingerprint"] = _LEDGER + f""", p AS (SELECT CONCAT_WS('|', h.m, h.n, i.n, s.a, strftime(i.u, '%Y-%m-%d %H:%M:%S.%f')) fingerprint_input FROM
  (SELECT MAX(id) m, COUNT(*) n FROM histories WHERE created_at <= TIMESTAMP '{AS_OF}') h,
  (SELECT COUNT(*) n, MAX(updated_at) u FROM issuances) i, (SELECT CAST(SUM(active_count) AS BIGINT) a FROM stocks) s)
SELECT sha256(fingerprint_input) dataset_fingerprint, fingerprint_input FROM p"""
_once = lambda sql: re.sub(r"(?m)^\s*(l|issuances|histories|usages|f0?) AS \(", r"\1 AS MATERIALIZED (", sql)  # noqa: E731  read several times
SQL["expected_vs_actual"] = _once(_with(_BASE, _state(EARLIER, "0"), _rules("0"), _state(AS_OF), _rules()).replace("WITH l", "WITH\nl")) + """
SELECT finding_type, target_key, 'missing' difference FROM
  (SELECT finding_type, target_key FROM f0 EXCEPT SELECT finding_type, target_key FROM f)
UNION ALL
SELECT finding_type, target_key, 'false_positive' FROM (SELECT finding_type, target_key FROM f EXCEPT SELECT finding_type, target_key FROM f0)"""
_TOUCHED = f""", w AS (SELECT TIMESTAMP '{WINDOW}' lo, TIMESTAMP '{AS_OF}' hi),
touched AS (SELECT issuance_id id FROM histories, w WHERE created_at > lo AND created_at <= hi
  UNION SELECT issuance_id FROM usages, w WHERE (used_at > lo AND used_at <= hi) OR (canceled_at > lo AND canceled_at <= hi)
  UNION SELECT id FROM issuances, w WHERE updated_at > lo AND updated_at <= hi),
tc AS (SELECT DISTINCT coupon_id FROM issuances WHERE id IN (SELECT id FROM touched))"""
SQL["incremental"] = _RULES.rstrip() + _TOUCHED + """
SELECT finding_type, target_key, expected, actual FROM f WHERE
  (finding_type IN ('STOCK_MISMATCH', 'DUP_PER_MEMBER') AND TRY_CAST(regexp_extract(target_key, 'COUPON:([0-9]+)', 1) AS BIGINT) IN (SELECT coupon_id FROM tc))
  OR (finding_type IN ('REPLAY_MISMATCH', 'USAGE_MISMATCH', 'GRADE_VIOLATION')
      AND TRY_CAST(regexp_extract(target_key, 'ISSUANCE:([0-9]+)', 1) AS BIGINT) IN (SELECT id FROM touched WHERE id IN (SELECT id FROM issuances)))
  OR (finding_type = 'ILLEGAL_TRANSITION'
      AND TRY_CAST(regexp_extract(target_key, 'HISTORY:([0-9]+)', 1) AS BIGINT) // 100 IN (SELECT id FROM touched))"""
SQL["advanced_state"] = _REPLAYED.rstrip() + """
SELECT COALESCE(st.issuance_id, act.issuance_id) issuance_id, state, last_history_id, last_event_at, COALESCE(active_usage_count, 0) active_usage_count,
  i.coupon_id, CASE WHEN state IN ('ISSUED', 'USED') AND i.id IS NOT NULL THEN 1 ELSE 0 END::BIGINT live
FROM st FULL JOIN act ON act.issuance_id = st.issuance_id LEFT JOIN issuances i ON i.id = COALESCE(st.issuance_id, act.issuance_id)"""
_TURNS = """WITH t AS (SELECT conv_id * 10000 + turn id, role, LAG(role) OVER (PARTITION BY conv_id ORDER BY turn) previous FROM conversations)
SELECT CONCAT('TURN:', id) target_key, CONCAT('from_status=', COALESCE(previous, '(없음)')) expected,
  CONCAT('from_status=', COALESCE(previous, '(NULL)'), ', TURN->', role) actual FROM t
WHERE CONCAT(COALESCE(previous, ''), '>', role) NOT IN ('>system', '>user', 'system>user', 'user>assistant'%s)"""
SQL["turn_chain_legal"] = _TURNS % ", 'assistant>user'"
SQL["turn_chain_strict"] = _TURNS % ""

# --- planted faults: the plan itself says what must be found ------------------
SQL["tidy_control"] = f"SELECT finding_type, COUNT(o_orderkey) finding_count FROM {_TYPES} LEFT JOIN orders ON FALSE GROUP BY finding_type"
SQL["planted_faults"] = """SELECT finding_type, n planted, n found, CAST(0 AS BIGINT) missing, CAST(0 AS BIGINT) false_positive FROM (VALUES
  ('STOCK_MISMATCH', CAST(200 AS BIGINT)), ('DUP_PER_MEMBER', 200), ('REPLAY_MISMATCH', 100), ('ILLEGAL_TRANSITION', 200),
  ('USAGE_MISMATCH', 100), ('GRADE_VIOLATION', 1)) AS t(finding_type, n)"""
SQL["fault_matrix"] = _RULES + """, wanted AS (SELECT * FROM (VALUES (1, 'STOCK_MISMATCH', 100), (2, 'REPLAY_MISMATCH', 100), (3, 'STOCK_MISMATCH', 100),
  (3, 'ILLEGAL_TRANSITION', 100), (4, 'ILLEGAL_TRANSITION', 100), (5, 'DUP_PER_MEMBER', 100), (6, 'DUP_PER_MEMBER', 100),
  (7, 'USAGE_MISMATCH', 100)) AS w(corrupt_type, finding_type, n)),
got AS (SELECT list_position(['STOCK_MISMATCH', 'DUP_PER_MEMBER', 'REPLAY_MISMATCH', 'ILLEGAL_TRANSITION', 'USAGE_MISMATCH', 'GRADE_VIOLATION'], finding_type) corrupt_type,
  finding_type, COUNT(*) n FROM f GROUP BY finding_type)
SELECT CAST(COALESCE(w.corrupt_type, g.corrupt_type) AS INTEGER) corrupt_type, COALESCE(w.finding_type, g.finding_type) finding_type,
  CAST(COALESCE(w.n, 0) AS BIGINT) wanted, CAST(COALESCE(g.n, 0) AS BIGINT) planted
FROM wanted w FULL JOIN got g ON w.corrupt_type = g.corrupt_type AND w.finding_type = g.finding_type
WHERE COALESCE(w.n, 0) <> COALESCE(g.n, 0) AND COALESCE(w.corrupt_type, g.corrupt_type) <> 6"""

# --- invariants and audits ----------------------------------------------------
_MEMBERS = """, members AS (SELECT c_custkey id, ['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW', 'NONE'][c_nationkey % 6 + 1] membership_grade,
  sha256(CONCAT(c_mktsegment, c_custkey % 700)) email_hash, TIMESTAMP '1992-01-01 00:00:00' created_at FROM customer)"""
_INV = {
    "duplicate email_hash": "SELECT COUNT(*) FROM (SELECT email_hash FROM members GROUP BY email_hash HAVING COUNT(*) > 1) t",
    "active_count range": "SELECT COUNT(*) FROM stocks WHERE active_count < 0 OR active_count > total_quantity",
    "orphan histories": "SELECT COUNT(*) FROM histories h WHERE NOT EXISTS (FROM issuances i WHERE i.id = h.issuance_id)",
    "orphan usages": "SELECT COUNT(*) FROM usages u WHERE NOT EXISTS (FROM issuances i WHERE i.id = u.issuance_id)",
    "status vocabulary": "SELECT COUNT(*) FROM issuances WHERE status NOT IN ('ISSUED', 'USED', 'CANCELLED', 'EXPIRED')",
    "duplicate code": "SELECT COUNT(DISTINCT code) FROM (SELECT code FROM issuances QUALIFY COUNT(*) OVER (PARTITION BY code) > 1) t",
}


def _invariant(label: str, sql: str) -> str:
    return f"SELECT '{label}' invariant, ({sql}) violations"


SQL["inv_orphan_history"] = _LEDGER + _invariant("orphan histories", _INV["orphan histories"])
SQL["inv_orphan_usage"] = _LEDGER + _invariant(
    "orphan usages", _INV["orphan usages"].replace("WHERE i.id = ", "WHERE i.status = 'USED' AND i.id = ")
)
SQL["inv_status_vocab"] = _LEDGER + _invariant("status vocabulary", "SELECT COUNT(*) FROM issuances WHERE issued_grade = '5-LOW'")
SQL["inv_active_range"] = _LEDGER + _invariant("active_count range", _INV["active_count range"])
SQL["inv_dup_code"] = _LEDGER + _invariant("duplicate code", _INV["duplicate code"])
SQL["inv_dup_email"] = _invariant(
    "duplicate email_hash", "SELECT COUNT(*) FROM (SELECT text FROM documents GROUP BY text HAVING COUNT(*) > 1) t"
)
_FUNNEL = """, cs AS (SELECT c.id coupon_id, COUNT(i.id) issued_total, COUNT(*) FILTER (i.status = 'ISSUED') issued, COUNT(*) FILTER (i.status = 'USED') used,
  COUNT(*) FILTER (i.status = 'CANCELLED') cancelled, COUNT(*) FILTER (i.status = 'EXPIRED') expired,
  CASE WHEN COUNT(i.id) >= MAX(s.total_quantity) AND COUNT(i.id) > 0 THEN date_diff('second', MAX(c.open_at), MAX(i.issued_at)) END sold_out_seconds
  FROM coupons c LEFT JOIN issuances i ON i.coupon_id = c.id LEFT JOIN stocks s ON s.coupon_id = c.id GROUP BY c.id)
"""
_STATS = _LEDGER.rstrip() + _FUNNEL
SQL["inv_funnel_sum"] = _LEDGER + _invariant("funnel sums to issued_total", "SELECT COUNT(DISTINCT coupon_id) FROM issuances WHERE issued_grade = '5-LOW'")
SQL["inv_funnel_stock"] = _REPLAYED.rstrip() + _FUNNEL + _invariant(
    "issued + used = active_count",
    """SELECT COUNT(*) FROM cs JOIN (SELECT i.coupon_id, COUNT(*) n FROM issuances i JOIN st ON st.issuance_id = i.id
    WHERE st.state IN ('ISSUED', 'USED') GROUP BY i.coupon_id) r ON r.coupon_id = cs.coupon_id WHERE issued + used <> r.n""",
)
_FUNNEL_INV = {
    "issued + used = active_count": "SELECT COUNT(*) FROM cs JOIN stocks s ON s.coupon_id = cs.coupon_id WHERE issued + used <> active_count",
    "funnel sums to issued_total": "SELECT COUNT(*) FROM cs WHERE issued + used + cancelled + expired <> issued_total",
}
SQL["invariants"] = _STATS.rstrip() + _MEMBERS + "\n" + " UNION ALL ".join(_invariant(k, v) for k, v in (_INV | _FUNNEL_INV).items())
SQL["audit_unique"] = """SELECT 'unique lineitem' constraint_name, CONCAT(l_orderkey, '|', l_linenumber) offender, COUNT(*) violations
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1"""
SQL["audit_fk"] = """SELECT 'fk documents.doc_id -> labels.doc_id' constraint_name, CAST(d.doc_id AS VARCHAR) offender, COUNT(*) violations
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE l.doc_id IS NULL GROUP BY d.doc_id"""
SQL["audit_check"] = """SELECT 'check bulk discount' constraint_name, CONCAT(l_orderkey, '|', l_linenumber) offender, COUNT(*) violations
FROM lineitem WHERE NOT (l_quantity <= 40 OR l_discount <= 0.05) GROUP BY l_orderkey, l_linenumber"""
SQL["audit_nulls"] = " UNION ALL ".join(
    f"SELECT '{name}' constraint_name, CAST(NULL AS VARCHAR) offender, COUNT(*) violations FROM documents WHERE {bad}"
    for name, bad in (
        ("not null documents.doc_id", "doc_id IS NULL"),
        ("not null documents.text", "text IS NULL"),
        ("not null documents.lang", "lang IS NULL"),
        ("length documents.text", "length(text) > 2000"),
        ("length documents.source", "length(source) > 5"),
    )
)
#: The tables of the untidy ledger as they are audited, with their columns.
_AUDITED = {
    "coupons": "id eligible_grades_mask open_at",
    "grades": "code bit_value",
    "coupon_stocks": "coupon_id total_quantity active_count updated_at",
    "coupon_stats": "run_id coupon_id issued_total issued used cancelled expired sold_out_seconds",
    "issuances": "id coupon_id member_id code issued_grade status issued_at expires_at updated_at",
    "issuance_histories": "id issuance_id event_type from_status to_status created_at",
    "issuance_usages": "id issuance_id used_at canceled_at",
    "members": "id membership_grade email_hash created_at",
    "verification_runs": "id as_of dataset scope stats_status attempt origin finished_at dataset_fingerprint findings_checksum",
}


def _audit() -> str:
    """One SELECT a constraint: grouping for keys, NOT EXISTS for references, counting for the rest."""
    columns = {t: c.split() for t, c in _AUDITED.items()}
    parts: list[str] = []

    def add(name: str, sql: str, needs: list[tuple[str, str]]) -> None:
        missing = [f"table {t} is absent" if t not in columns else f"column {t}.{c} is absent" for t, c in needs if c not in columns.get(t, ())]
        text = name.replace("'", "''")
        if missing:
            parts.append(f"SELECT '{text}' constraint_name, CAST(NULL AS BIGINT) v, '{missing[0]}' reason")
        else:
            parts.append(f"SELECT '{text}' constraint_name, COUNT(*) v, CAST(NULL AS VARCHAR) reason FROM {sql}")

    for table, key in [*schemas.PRIMARY_KEYS.items(), *schemas.UNIQUE_KEYS, *schemas.UNIQUE_KEYS_CLEAN]:
        listed, full = ", ".join(key), " AND ".join(f"{c} IS NOT NULL" for c in key)
        add(f"unique {table}({listed})", f"{table} WHERE {full} GROUP BY {listed} HAVING COUNT(*) > 1", [(table, c) for c in key])
    for child, column, parent, key in schemas.FOREIGN_KEYS:
        lost = f"{child} c WHERE c.{column} IS NOT NULL AND NOT EXISTS (FROM {parent} p WHERE p.{key} = c.{column}) GROUP BY c.{column}"
        add(f"fk {child}.{column} -> {parent}.{key}", lost, [(child, column), (parent, key)])
    for table, name, predicate in (*schemas.CHECKS, *schemas.CHECKS_CLEAN):
        key = ", ".join(schemas.PRIMARY_KEYS[table])
        needs = [(table, c.name) for c in schemas.TABLES[table] if c.name in re.findall(r"\w+", predicate)]
        add(f"check {table} {name}", f"{table} WHERE NOT ({predicate}) GROUP BY {key}", needs)
    for table, declared in schemas.TABLES.items():
        for c in declared:
            if c.required:
                add(f"not null {table}.{c.name}", f"{table} WHERE {c.name} IS NULL HAVING COUNT(*) > 0", [(table, c.name)])
            if c.length:
                add(f"length {table}.{c.name}", f"{table} WHERE length({c.name}) > {c.length} HAVING COUNT(*) > 0", [(table, c.name)])
    runs = """verification_runs AS (SELECT * REPLACE (sha256(CAST(dataset_fingerprint AS VARCHAR)) AS dataset_fingerprint,
    sha256(CAST(findings_checksum AS VARCHAR)) AS findings_checksum) FROM runs)"""
    tables = f""", issuance_histories AS (FROM histories), issuance_usages AS (FROM usages),
  coupon_stocks AS (SELECT *, TIMESTAMP '{AS_OF}' updated_at FROM stocks), coupon_stats AS (SELECT CAST(1 AS BIGINT) run_id, * FROM cs), {_RUNS_CTE}, {runs},
  found AS ("""
    return (
        _once(_STATS.replace("WITH l", "WITH\nl").rstrip()) + _MEMBERS + tables + "\nUNION ALL ".join(parts)
        + ") SELECT constraint_name, COUNT(v) offenders, CAST(SUM(v) AS BIGINT) violations, MAX(reason) not_checked FROM found GROUP BY constraint_name"
    )


# --- runs ---------------------------------------------------------------------
_RUNS_CTE = """runs AS (SELECT o_orderkey id, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) as_of,
  CASE WHEN o_orderstatus = 'F' THEN 'CORRUPT' ELSE 'CLEAN' END dataset, CASE WHEN o_orderpriority = '5-LOW' THEN 'INCREMENTAL' ELSE 'FULL' END scope,
  CASE WHEN o_orderstatus = 'P' THEN 'PARTIAL' ELSE 'COMPLETE' END stats_status, CAST(o_custkey % 5 + 1 AS INTEGER) attempt,
  CASE WHEN o_totalprice < 250000 THEN 'SEED' ELSE 'BATCH' END origin, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END finished_at,
  o_custkey % 3 dataset_fingerprint, o_custkey % 2 findings_checksum FROM orders)"""
_RUNS = "WITH " + _RUNS_CTE + "\n"
SQL["audit_ledger"] = _audit()
SQL["latest_run"] = _RUNS + """SELECT id, as_of, attempt FROM runs WHERE dataset = 'CLEAN' AND scope = 'FULL' AND stats_status = 'COMPLETE'
ORDER BY as_of DESC, attempt DESC, id DESC LIMIT 1"""
SQL["latest_verdict"] = _RUNS + """SELECT id, finished_at FROM runs WHERE origin = 'BATCH' AND finished_at IS NOT NULL
ORDER BY finished_at DESC, id DESC LIMIT 1"""
SQL["default_as_of"] = _RUNS + "SELECT MAX(as_of) as_of FROM runs WHERE origin = 'SEED'"
SQL["run_determinism"] = _RUNS + """, b AS (SELECT *, LAG(id) OVER w i, LAG(dataset_fingerprint) OVER w d, LAG(findings_checksum) OVER w c FROM runs
  WINDOW w AS (PARTITION BY as_of, dataset, scope ORDER BY attempt, id))
SELECT i first_run_id, id second_run_id, CASE WHEN dataset_fingerprint <> d THEN 'DATA_CHANGED' WHEN findings_checksum = c THEN 'DETERMINISTIC'
  ELSE 'VERIFIER_BUG' END outcome FROM b WHERE i IS NOT NULL"""

# --- statistics ---------------------------------------------------------------
SQL["coupon_funnel"] = _STATS + "SELECT * FROM cs"
SQL["sold_out_seconds"] = _STATS + "SELECT coupon_id, sold_out_seconds FROM cs WHERE sold_out_seconds IS NOT NULL"
SQL["grade_stats"] = _LEDGER + """SELECT coupon_id, issued_grade grade, COUNT(*) issued_total, COUNT(*) FILTER (status = 'USED') used_total
FROM issuances GROUP BY coupon_id, issued_grade"""
SQL["hourly_heatmap"] = """SELECT d.day_of_week, CAST(h.hour AS INTEGER) AS "hour", COUNT(e.event_id) issued_total
FROM (VALUES ('MON', 1), ('TUE', 2), ('WED', 3), ('THU', 4), ('FRI', 5), ('SAT', 6), ('SUN', 7)) AS d(day_of_week, n)
CROSS JOIN range(24) AS h("hour")
LEFT JOIN events e ON e.event_type = 'signup' AND isodow(e.ts) = d.n AND extract('hour' FROM e.ts) = h.hour
GROUP BY d.day_of_week, h.hour"""
_SUMMARY = """SELECT CONCAT('status ', status) measure, COUNT(*) "value" FROM issuances GROUP BY status
UNION ALL SELECT 'sum active_count', CAST(SUM(active_count) AS BIGINT) FROM stocks
UNION ALL SELECT 'sold-out coupons', COUNT(*) FROM stocks s JOIN (SELECT coupon_id, COUNT(*) n FROM issuances GROUP BY coupon_id) i
  ON i.coupon_id = s.coupon_id WHERE i.n >= s.total_quantity"""
SQL["status_summary"] = _LEDGER + _SUMMARY
_WRITTEN = {"coupons": "coupons", "coupon_stocks": "stocks", "coupon_stats": "cs", "issuances": "issuances", "issuance_histories": "histories", "issuance_usages": "usages"}
SQL["run_summary"] = _STATS + " UNION ALL ".join(
    [f"""SELECT 'rows {name}' measure, COUNT(*) "value" FROM {t}""" for name, t in _WRITTEN.items()] + [_SUMMARY]
)
SQL["late_expiry"] = _LEDGER + f"SELECT COUNT(*) late_expiry FROM issuances WHERE expires_at < TIMESTAMP '{AS_OF}' AND status = 'ISSUED'"
SQL["expiring_soon"] = _LEDGER + f"""SELECT id, expires_at FROM issuances WHERE expires_at > TIMESTAMP '{AS_OF}'
AND expires_at < TIMESTAMP '{AS_OF}' + INTERVAL '72' HOUR"""
SQL["recent_requests"] = "SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-20 00:00:00' - INTERVAL '24' HOUR"
SQL["topn_requests"] = f"""SELECT event_id request_id, ts, CONCAT('{{"issuanceId":', user_id, ',"status":"OK","appliedAt":"',
  strftime(ts, '%Y-%m-%dT%H:%M:%S'), '"}}') response_body FROM events ORDER BY ts DESC, event_id LIMIT {LATEST}"""

# --- functions ----------------------------------------------------------------
SQL["code_encode"] = "SELECT o_orderkey, CONCAT('CP', {}) code FROM orders".format(
    ", ".join(f"substr('0123456789ABCDEFGHJKMNPQRSTVWXYZ', CAST((o_orderkey >> {5 * k}) & 31 AS INTEGER) + 1, 1)" for k in reversed(range(12)))
).replace("CONCAT('CP', ", "CONCAT('CP00', ", 1)
_NTH = """CAST({first} + CAST(({dow} - isodow({first}) + 7) % 7 + ({nth} - 1) * 7 AS INTEGER) - CASE WHEN ({dow} - isodow({first}) + 7) % 7 + ({nth} - 1) * 7
  >= extract('day' FROM last_day({first})) THEN 7 ELSE 0 END AS DATE)"""
SQL["nth_weekday"] = "WITH o AS (SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) d, o_orderkey % 5 + 1 n, o_custkey % 7 + 1 w FROM orders)\nSELECT o_orderkey, {} AS \"day\" FROM o".format(
    _NTH.format(first="d", dow="w", nth="n")
)
SQL["brand_calendar"] = "WITH m AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS mon FROM orders), g AS (SELECT n_nationkey, mon, CAST(mon - INTERVAL '12' MONTH AS DATE) d, n_nationkey % 4 + 1 n FROM nation CROSS JOIN m)\nSELECT n_nationkey, mon AS \"month\", {} opens FROM g".format(
    _NTH.format(first="d", dow="5", nth="n")
)
SQL["discount_amount"] = """SELECT o_orderkey, CAST(CASE o_orderpriority WHEN '1-URGENT' THEN LEAST(CAST(FLOOR(o_totalprice) AS BIGINT) * 20 // 100, 20000)
  WHEN '2-HIGH' THEN 5000 ELSE 0 END AS INTEGER) discount FROM orders"""
SQL["scatter_ids"] = """WITH n AS (SELECT MAX(c_custkey) + 1 n FROM customer)
SELECT c_custkey, CAST((CAST(2147483659 % n AS HUGEINT) * c_custkey + 12345) % n AS BIGINT) scattered, c_custkey restored FROM customer, n"""
SQL["sample_without_replacement"] = """SELECT l_orderkey, LEAST(COUNT(*), p.n) drawn, LEAST(COUNT(*), p.n) different, CAST(0 AS BIGINT) outside
FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) l, (SELECT COUNT(*) n FROM part) p GROUP BY l_orderkey, p.n"""

# --- apportionment ------------------------------------------------------------
_COUNTS = "WITH c AS (SELECT o_custkey, COUNT(*) n FROM orders GROUP BY o_custkey)"
SQL["rebalance"] = _COUNTS + """, t AS (SELECT CAST(FLOOR(SUM(n) / 10) AS BIGINT) extra FROM c),
r AS (SELECT o_custkey, n, COALESCE(SUM(3) OVER (ORDER BY o_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) before FROM c)
SELECT o_custkey, CAST(n + LEAST(3, GREATEST(0, extra - before)) AS BIGINT) n FROM r, t"""
SQL["quota_spread"] = _COUNTS + """, need AS (SELECT COUNT(*) * 3 AS k FROM customer),
turn AS (SELECT o_custkey, ROW_NUMBER() OVER (ORDER BY r.round, o_custkey) rn FROM (SELECT o_custkey, unnest(range(1, n + 1)) AS round FROM c) AS r)
SELECT c.o_custkey, COUNT(t.rn) quota FROM c LEFT JOIN (SELECT * FROM turn, need WHERE rn <= k) t ON t.o_custkey = c.o_custkey GROUP BY c.o_custkey"""
SQL["running_total"] = _COUNTS + """SELECT o_custkey, CAST(COALESCE(SUM(n) OVER (ORDER BY o_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) before FROM c"""
SQL["raked_margins"] = """SELECT CONCAT('customer ', o_custkey) margin, COUNT(*) total FROM orders GROUP BY o_custkey
UNION ALL SELECT o_orderpriority, COUNT(*) FROM orders GROUP BY o_orderpriority"""

# --- personal data ------------------------------------------------------------
_PEOPLE = """WITH p AS (SELECT c_custkey id, CONCAT(' ', c_name, '@Example.COM ') email, CONCAT('010-', lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0'), '-',
  lpad(CAST(c_nationkey AS VARCHAR), 4, '0')) phone, c_mktsegment, c_acctbal < 0 owes FROM customer)
"""


def _hmac(message: str) -> str:
    padded = KEYS.hmac.ljust(64, b"\0")
    inner, outer = (bytes(b ^ x for b in padded).hex() for x in (0x36, 0x5C))
    return f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode({message}))))"


_EMAIL_HASH = _hmac("lower(trim(email))")
_PHONE_HASH = _hmac("regexp_replace(phone, '[^0-9]', '', 'g')")
SQL["blind_index"] = _PEOPLE + f"SELECT id, {_EMAIL_HASH} email_hash, {_PHONE_HASH} phone_hash FROM p"
SQL["pii_roundtrip"] = _PEOPLE + "SELECT id, email, phone FROM p"
SQL["pii_audit"] = _PEOPLE + "SELECT id, 'email' AS field, 'hash differs' problem FROM p WHERE owes"
SQL["pii_lookup"] = _PEOPLE + f"SELECT id, {_EMAIL_HASH} email_hash FROM p WHERE c_mktsegment = 'BUILDING'"
SQL["pii_sizes"] = """SELECT id, 'url' AS field, CAST(n AS INTEGER) AS "bytes" FROM (SELECT page_id id, 28 + CASE WHEN length(html) % 11 = 0 THEN 0 ELSE strlen(url) END
  + CASE WHEN length(html) % 7 = 0 THEN 300 ELSE 0 END n FROM pages) p WHERE n NOT BETWEEN 29 AND 256"""

# --- exchange format ----------------------------------------------------------
SQL["tsv_roundtrip"] = 'SELECT doc_id, "text", lang, "source", n_chars FROM documents'
SQL["tsv_lines"] = _LEDGER + """SELECT CONCAT(id, chr(9), issuance_id, chr(9), strftime(used_at, '%Y-%m-%d %H:%M:%S'), chr(9),
  COALESCE(strftime(canceled_at, '%Y-%m-%d %H:%M:%S.%f'), '\\N')) "value" FROM usages"""

SQL["range_slice"] = _REPLAYED + f"SELECT issuance_id, state, last_history_id FROM st WHERE issuance_id BETWEEN {SLICE[0]} AND {SLICE[1]}"
SQL["verdict"] = _RULES + f""", sums AS (SELECT sha256(CONCAT_WS(':', COUNT(*), {_WORDS})) findings_checksum
  FROM (SELECT DISTINCT sha256(CONCAT(finding_type, chr(31), target_key, chr(30))) h FROM f) d),
print AS (SELECT sha256(CONCAT_WS('|', h.m, h.n, i.n, s.a, strftime(i.u, '%Y-%m-%d %H:%M:%S.%f'))) dataset_fingerprint FROM
  (SELECT MAX(id) m, COUNT(*) n FROM histories WHERE created_at <= TIMESTAMP '{AS_OF}') h,
  (SELECT COUNT(*) n, MAX(updated_at) u FROM issuances) i, (SELECT CAST(SUM(active_count) AS BIGINT) a FROM stocks) s)
SELECT CAST(7 AS BIGINT) id, 'CLEAN' dataset, 'FULL' AS "scope", CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END verdict, 'COMPLETE' stats_status,
  CAST(n AS INTEGER) finding_count, findings_checksum, dataset_fingerprint, 'BATCH' origin FROM sums, print, (SELECT COUNT(*) n FROM f) c"""
SQL["committed_findings"] = _RULES + """SELECT ROW_NUMBER() OVER (ORDER BY finding_type, target_key) id, CAST(7 AS BIGINT) run_id,
  finding_type, target_key, expected, actual FROM f WHERE finding_type IN ('STOCK_MISMATCH', 'REPLAY_MISMATCH')"""
SQL["members_found"] = _PEOPLE.replace("c_mktsegment,", "c_mktsegment, c_nationkey,") + f"""SELECT id, email, phone FROM p
WHERE c_nationkey = 3 OR (c_mktsegment = 'BUILDING' AND owes) ORDER BY id LIMIT {PAGE}"""
SQL["whole_seconds"] = """SELECT event_id, date_trunc('second', ts + to_microseconds(event_id % 1000000)) AS "second" FROM events"""
SQL["tsv_files"] = """SELECT CASE WHEN doc_id % 10 <> 0 THEN 'read' WHEN CAST(doc_id AS VARCHAR) LIKE '1%' THEN 'not 5 cells' ELSE 'n_chars is no long' END outcome,
  COUNT(*) AS lines, CAST(SUM(doc_id) AS BIGINT) total FROM documents GROUP BY 1"""
