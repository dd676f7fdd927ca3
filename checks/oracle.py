"""DuckDB SQL for the registered queries, over the same parquet tables."""

from __future__ import annotations

import re

from checks.queries import ARBITER_SQL, JUDGE_SQL, PART_TEXT
from checks.views import messages_sql
from smslens.functions.vocabulary import (
    FREQUENCY_RANGES, LENGTH_RANGES, MESSAGE_TYPES, OTP_TRIGGER, PLACEHOLDER_TABLE, RULE_CATALOG, TAXONOMY_LABELS, WEEKDAYS,
)
from smslens.operators.similarity import minhash_factors

SPACES = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def norm(c: str) -> str:
    return f"trim(regexp_replace(lower(coalesce({c}, '')), {q(SPACES)}, ' ', 'g'))"


def guard(c: str) -> str:
    """Each letter beyond ASCII between underscores: DuckDB's \b knows ASCII word characters only."""
    return f"regexp_replace(regexp_replace({c}, '([^\\x00-\\x7F])', '_\\1_', 'g'), '_([^\\p{{L}}\\p{{M}}\\p{{Nd}}\\x00-\\x7F])_', '\\1', 'g')"


def unguard(c: str) -> str:
    return f"regexp_replace({c}, '_([^\\x00-\\x7F])_', '\\1', 'g')"


def guarded_pattern(pattern: str) -> str:
    return re.sub(r"\[([a-z])([^\x00-\x7f])\]", r"(?:\1|_\2_)", pattern)


def chain(source: str, text: str, name: str) -> str:
    """CTEs ``name``: all columns of ``source`` plus template_text, template_id, rules (text), from raw text."""
    rules = sorted(PLACEHOLDER_TABLE, key=lambda r: r[1])
    steps = [f"{name}_n AS (SELECT *, {norm(text)} AS c0 FROM {source})", f"{name}_0 AS (SELECT *, {guard('c0')} AS p0 FROM {name}_n)"]
    for i, (rule, _, token, pattern) in enumerate(rules):
        new = f"regexp_replace(p{i}, {q(guarded_pattern(pattern))}, {q(token)}, 'gi')"
        if rule == "otp":
            new = f"CASE WHEN regexp_matches(c0, {q(OTP_TRIGGER)}, 'i') THEN {new} ELSE p{i} END"
        steps.append(f"{name}_{i + 1} AS (SELECT *, {new} AS p{i + 1} FROM {name}_{i})")
    n = len(rules)
    fired = ", ".join(f"CASE WHEN p{i} <> p{i + 1} THEN {q(r[0])} END" for i, r in enumerate(rules))
    drop = ", ".join(["c0", *(f"p{i}" for i in range(n + 1))])
    steps.append(
        f"{name} AS (SELECT * EXCLUDE ({drop}), c0 AS cleaned_message, {unguard(f'p{n}')} AS template_text,"
        f" substr(md5({unguard(f'p{n}')}), 1, 16) AS template_id, concat_ws(',', {fired}) AS rules FROM {name}_{n})"
    )
    return ",\n".join(steps)


def rule_case(column: int) -> str:
    """CASE over the catalog giving its name (0), label (2) or confidence (3)."""
    out = []
    for rule in sorted(RULE_CATALOG, key=lambda r: r[1]):
        _, _, _, _, every, some, no, sender = rule
        parts = [f"contains(template_text, '[{t}]')" for t in every] + [f"NOT contains(template_text, '[{t}]')" for t in no]
        if some:
            parts.append("(" + " OR ".join(f"contains(template_text, '[{t}]')" for t in some) + ")")
        if sender:
            parts.append(f"coalesce(regexp_matches(client_name, {q(sender)}, 'i'), false)")
        value = rule[column] if column == 3 else q(rule[column])
        out.append(f"WHEN {' AND '.join(parts)} THEN {value}")
    return "CASE " + " ".join(out) + " END"


def watched_case() -> str:
    out = []
    for rule in sorted(RULE_CATALOG, key=lambda r: r[1]):
        tokens = sorted(set(rule[4]) | set(rule[5]))
        hits = ", ".join(f"CASE WHEN contains(template_text, '[{t}]') THEN '{t}' END" for t in tokens)
        out.append(f"WHEN {q(rule[0])} THEN {'concat_ws(chr(44), ' + hits + ')' if tokens else q('')}")
    return "CASE rule_name " + " ".join(out) + " END"


def split_label(c: str) -> str:
    return f"split_part({c}, '::', 1) AS category, CASE WHEN {c} IS NULL THEN NULL ELSE split_part({c}, '::', 2) END AS subcategory"


def classify_cte(name: str, source: str) -> str:
    return f"""{name}_r AS (SELECT *, {rule_case(0)} AS rule_name, {rule_case(2)} AS label, CAST({rule_case(3)} AS DOUBLE) AS c0 FROM {source}),
{name} AS (SELECT * EXCLUDE (c0), {split_label('label')}, coalesce(c0, 0.0::DOUBLE) AS confidence,
  CASE WHEN rule_name IS NULL THEN 'pending' ELSE 'rule' END AS level_used, rule_name IS NOT NULL AS agreement FROM {name}_r)"""


RAW = f"raw AS ({messages_sql()})"
DELIVERED = RAW + ",\ndelivered AS (SELECT * FROM raw WHERE StatusId = 3)"
TPL = DELIVERED + ",\n" + chain("delivered", "Message", "tpl")
FREQ_CTE = """,
freq AS (SELECT template_id, template_text, rules, ClientName AS client_name, frequency, first_seen, last_seen FROM (
  SELECT *, row_number() OVER (PARTITION BY template_id ORDER BY ArrivalDate, ClientName NULLS FIRST, rules) AS rn,
         count(*) OVER (PARTITION BY template_id) AS frequency,
         min(ArrivalDate) OVER (PARTITION BY template_id) AS first_seen, max(ArrivalDate) OVER (PARTITION BY template_id) AS last_seen
  FROM tpl) WHERE rn = 1),
fired AS (SELECT * FROM freq WHERE rules <> '')"""
FREQ = TPL + FREQ_CTE
CLS = FREQ + ",\n" + classify_cte("cls", "fired") + ",\n" + classify_cte("cls_all", "freq")
VOTE_CLS = DELIVERED + """,
vm AS (SELECT Message, ClientName, ArrivalDate FROM delivered
  UNION ALL SELECT text, role, TIMESTAMP '2024-01-05 00:00:00' + to_seconds(conv_id * 60 + turn) FROM conversations),
""" + chain("vm", "Message", "tpl") + FREQ_CTE + ",\n" + classify_cte("cls_all", "freq")
PENDING = VOTE_CLS + ",\npending AS (SELECT template_id, frequency + length(template_text) AS frequency FROM cls_all WHERE level_used = 'pending')"
VOTES = PENDING + f""",
votes AS ({JUDGE_SQL}),
arb AS ({ARBITER_SQL}),
paired AS (SELECT template_id, max(label) FILTER (judge = 1) AS l1, CAST(max(confidence) FILTER (judge = 1) AS DOUBLE) AS c1,
  max(label) FILTER (judge = 2) AS l2, CAST(max(confidence) FILTER (judge = 2) AS DOUBLE) AS c2 FROM votes GROUP BY 1)"""


def resolve(partial: bool) -> str:
    family = "WHEN split_part(j1, '::', 1) = split_part(j2, '::', 1) AND low >= 0.7::DOUBLE THEN 'partial_agreement'" if partial else ""
    return VOTES + f""",
j0 AS (SELECT c.*, coalesce(p.l1, 'error') AS j1, coalesce(p.l2, 'error') AS j2,
  least(coalesce(p.c1, 0.0), coalesce(p.c2, 0.0)) AS low, a.label AS a_label, a.confidence::DOUBLE AS a_conf, a.error AS a_error
  FROM cls_all c LEFT JOIN paired p USING (template_id) LEFT JOIN arb a USING (template_id)),
j1 AS (SELECT *, CASE WHEN level_used = 'rule' THEN 'rule' WHEN j1 = j2 AND low >= 0.7::DOUBLE THEN 'panel_agreement' {family}
  WHEN a_label IS NULL OR a_error IS NOT NULL THEN 'error' WHEN a_label = 'ABSTAIN' THEN 'human_review' ELSE 'arbiter' END AS lv FROM j0),
j2 AS (SELECT template_id, template_text, client_name, frequency, first_seen, lv AS level_used,
  CASE lv WHEN 'rule' THEN label WHEN 'panel_agreement' THEN j1 WHEN 'partial_agreement' THEN split_part(j1, '::', 1)
    WHEN 'error' THEN 'ERROR' ELSE a_label END AS label,
  CASE lv WHEN 'rule' THEN confidence WHEN 'panel_agreement' THEN low WHEN 'partial_agreement' THEN low WHEN 'error' THEN 0.0 ELSE a_conf END AS confidence,
  lv IN ('rule', 'panel_agreement') AS agreement,
  CASE WHEN lv NOT IN ('rule', 'error') THEN j1 END AS panel_judge_1, CASE WHEN lv NOT IN ('rule', 'error') THEN j2 END AS panel_judge_2,
  CASE WHEN lv IN ('arbiter', 'human_review') THEN a_label END AS arbiter_label, lv IN ('human_review', 'error') AS needs_human_review,
  CASE WHEN lv = 'error' THEN coalesce(a_error, 'no arbiter decision') END AS error FROM j1),
res AS (SELECT *, {split_label('label')} FROM j2)"""


RES = resolve(False)
LOOKUP = CLS + """,
lookup AS (SELECT template_id, category AS categoria, subcategory AS subcategoria FROM cls WHERE trim(label) <> ''),
lb AS (SELECT PhoneNumber AS phone_number, ArrivalDate, Message FROM raw WHERE StatusId = 3 AND ArrivalDate >= TIMESTAMP '2024-01-01 00:00:00'),
""" + chain("lb", "Message", "sc") + """,
m AS (SELECT sc.phone_number, ArrivalDate, coalesce(nullif(categoria, ''), 'unknown') AS category, coalesce(subcategoria, 'unknown') AS subcategory
  FROM sc LEFT JOIN lookup USING (template_id)),
kinds AS (SELECT *, CASE """ + " ".join(
    f"WHEN subcategory IN ({', '.join(q(s) for s in subs)}) THEN '{t}'" for t, subs in MESSAGE_TYPES.items()
) + """ ELSE 'service_notifications' END AS kind FROM m)"""
REQUESTS = """req AS (SELECT user_id AS ordinal, '57300' || lpad(user_id::VARCHAR, 7, '0') AS phone_number FROM (
  SELECT DISTINCT user_id FROM events UNION ALL SELECT s_suppkey + 900000 FROM supplier))"""


def ranges(c: str, table) -> str:
    return "CASE " + " ".join(f"WHEN {c} >= {low} THEN '{label}'" for low, label in reversed(table)) + f" ELSE '{table[0][1]}' END"


def text_rows(table: str, text: str, key: str) -> str:
    return f"WITH src AS (SELECT {key}, {text} AS body FROM {table}),\n" + chain("src", "body", "x") + (
        f"\nSELECT {key}, template_id, rules AS applied_rules, length(template_text) AS template_chars FROM x"
    )


def w(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


SIGHT = TPL + ",\nseen AS (SELECT template_id, template_text, ClientName AS client_name, ArrivalDate FROM tpl),\n" + classify_cte("sg", "seen") + """,
si AS (SELECT template_id, label, level_used, client_name, ArrivalDate AS arrived, confidence FROM sg WHERE level_used = 'rule'),
early AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY template_id ORDER BY arrived, label) rn FROM si WHERE arrived < TIMESTAMP '2024-01-11') WHERE rn = 1),
later AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY template_id ORDER BY arrived, label) rn FROM si
  WHERE template_id NOT IN (SELECT template_id FROM early)) WHERE rn = 1)"""

PRED = """pred AS (SELECT CASE WHEN toxic = 1 THEN 'toxic::' ELSE 'clean::' END || CASE WHEN quality = 1 THEN 'good' ELSE 'bad' END AS label,
  CASE WHEN toxic = 1 THEN 'toxic::' ELSE 'clean::' END || CASE WHEN n_chars % 3 > 0 THEN 'good' ELSE 'bad' END AS predicted_label,
  (n_chars % 100)::DOUBLE / 100.0::DOUBLE AS conf FROM documents JOIN labels USING (doc_id))"""

# Every distinct word (under 90) becomes one byte, so that DuckDB's edit distance counts words.
PARTS = f"""pt AS (SELECT template_text, min(p_brand) AS sender, substr(md5(template_text), 1, 16) AS template_id, string_split(template_text, ' ') AS ws
  FROM (SELECT {PART_TEXT} AS template_text, p_brand FROM part) GROUP BY template_text),
letters AS (SELECT w, chr((32 + row_number() OVER (ORDER BY w))::INT) AS c FROM (SELECT DISTINCT unnest(ws) AS w FROM pt)),
spelled AS (SELECT template_id, any_value(sender) AS sender, any_value(ws) AS ws, string_agg(c, '' ORDER BY i) AS code
  FROM (SELECT template_id, sender, ws, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM pt) JOIN letters USING (w) GROUP BY 1),
pairs AS (SELECT a.template_id, b.template_id AS other, levenshtein(a.code, b.code) AS d
  FROM spelled a JOIN spelled b ON a.sender = b.sender AND a.template_id <> b.template_id AND list_has_any(a.ws, b.ws))"""

CURVE = PRED + """,
st AS (SELECT *, least(floor(conf * 20), 19)::INT AS step FROM pred),
g AS (SELECT DISTINCT predicted_label AS label, t.s FROM st, range(20) t(s)),
act AS (SELECT label, count(*) AS a FROM pred GROUP BY 1),
c AS (SELECT g.label, g.s, count(st.step) AS predicted, count(st.step) FILTER (st.label = g.label) AS correct FROM g LEFT JOIN st ON st.predicted_label = g.label AND st.step >= g.s GROUP BY 1, 2),
curve AS (SELECT c.label, c.s::DOUBLE / 20.0::DOUBLE AS threshold, predicted, correct, CASE WHEN predicted > 0 THEN correct::DOUBLE / predicted END AS precision,
  CASE WHEN a > 0 THEN correct::DOUBLE / a ELSE 0.0 END AS recall FROM c LEFT JOIN act ON act.label = c.label)"""
CUTS = CURVE + """,
cuts AS (SELECT label, min(threshold) AS cut, arg_min(precision, threshold) AS precision, arg_min(recall, threshold) AS recall FROM curve x
  WHERE predicted >= 5 AND NOT EXISTS (SELECT 1 FROM curve y WHERE y.label = x.label AND y.threshold >= x.threshold AND y.predicted >= 5 AND y.precision < 0.45) GROUP BY 1)"""
SIMILAR = PARTS + """,
best AS (SELECT *, row_number() OVER (PARTITION BY template_id ORDER BY d, other) AS rn FROM pairs WHERE d BETWEEN 1 AND 2 AND substr(other, 1, 1) < '8'),
done AS (SELECT pt.template_id, template_text, CASE WHEN other IS NULL THEN 'pending' ELSE 'similar' END AS level_used, 'part::' || substr(other, 1, 2) AS label,
  CASE WHEN other IS NULL THEN 0.0 ELSE 0.9 END::DOUBLE AS confidence, other AS similar_id, d::DOUBLE AS similar_score
  FROM pt LEFT JOIN best ON best.template_id = pt.template_id AND rn = 1 WHERE substr(pt.template_id, 1, 1) >= '8')"""
GRAMS = f"""wd AS (SELECT doc_id AS id, string_split({norm('text')}, ' ') AS ws FROM documents WHERE doc_id IS NOT NULL),
g AS (SELECT DISTINCT id, ('0x' || substr(md5(array_to_string(ws[i:i + 2], ' ')), 1, 15))::BIGINT AS g FROM (SELECT id, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) AS i FROM wd)),
sizes AS (SELECT id, count(*) AS n FROM g GROUP BY 1),
sig AS (SELECT id, {', '.join(f"min(({a} * (g % 4294967296) + {b}) % 4294967291) AS m{k}" for k, (a, b) in enumerate(minhash_factors(32)))} FROM g GROUP BY 1),
bk AS ({' UNION ALL '.join(f"SELECT id, concat_ws(',', {b}, {', '.join(f'm{k}' for k in range(4 * b, 4 * b + 4))}) AS bucket FROM sig" for b in range(8))})"""


def alike(pairs: str) -> str:
    """CTE sim: src, dst, similarity of the pairs, by counting shared n-grams."""
    return f"""sh AS (SELECT src, dst, count(*) AS c FROM {pairs} JOIN g x ON x.id = src JOIN g y ON y.id = dst AND x.g = y.g GROUP BY 1, 2),
sim AS (SELECT src, dst, c::DOUBLE / (a.n + b.n - c) AS similarity FROM sh JOIN sizes a ON a.id = src JOIN sizes b ON b.id = dst)"""


SQL = {
    "delivered_messages": w(DELIVERED, """SELECT MTMessageId AS mt_message_id, Message AS message, PhoneNumber AS phone_number, StatusId::INT AS status_id,
  ClientId AS client_id, nullif(trim(ClientName), '') AS client_name, PriorityId AS priority_id, nullif(trim(PriorityDescription), '') AS priority_description,
  nullif(trim(OperatorName), '') AS operator_name, ArrivalDate AS "timestamp", AccountName AS account_name, 1::INT AS segments, Variables AS variables FROM delivered"""),
    "first_delivered": w(DELIVERED, "SELECT MTMessageId, PhoneNumber, Message FROM delivered ORDER BY MTMessageId LIMIT 1000"),
    "day_counts": w(DELIVERED, "SELECT day(ArrivalDate)::INT AS day, count(*) AS messages FROM delivered WHERE day(ArrivalDate) IN (1, 2, 3, 15) GROUP BY 1"),
    "filtered_clients": w(DELIVERED, """SELECT ClientName, count(*) AS messages FROM delivered
  WHERE PriorityDescription = 'Alto' AND OperatorName = 'Tigo' AND ClientName IS NOT NULL GROUP BY 1"""),
    "lake_scan": w(DELIVERED + ",\n" + REQUESTS, """SELECT PhoneNumber, count(*) AS messages, min(ArrivalDate) AS first_arrival, max(ArrivalDate) AS last_arrival
  FROM delivered WHERE ArrivalDate >= TIMESTAMP '2024-01-17' AND PhoneNumber IN (SELECT phone_number FROM req) GROUP BY 1"""),
    "phone_timeline": w(DELIVERED, "SELECT PhoneNumber, Message, ArrivalDate FROM delivered WHERE PhoneNumber = '573000000008'"),
    "tolerant_json": """WITH l AS (SELECT CASE event_type WHEN 'error' THEN regexp_replace(props, '\\}$', '') WHEN 'view' THEN '  ' ELSE props END AS v FROM events)
SELECT (v->>'$.k')::BIGINT AS k, count(*) AS lines, 'record' AS kind FROM l WHERE trim(v) <> '' AND json_valid(v) GROUP BY 1
UNION ALL SELECT NULL, count(*), 'rejected' FROM l WHERE trim(v) <> '' AND NOT json_valid(v)""",
    "resume_pending": w(FREQ, "SELECT template_id, template_text, frequency FROM freq WHERE substr(template_id, 1, 1) >= '8' ORDER BY frequency DESC, template_id LIMIT 5"),
    "classification_lookup": w(TPL + ",\nseen AS (SELECT MTMessageId, template_id, template_text, ClientName AS client_name FROM tpl),\n" + classify_cte("cl", "seen"),
      """SELECT template_id, coalesce(nullif(trim(category), ''), 'unknown') AS categoria, coalesce(nullif(trim(subcategory), ''), 'unknown') AS subcategoria, label
  FROM (SELECT *, row_number() OVER (PARTITION BY template_id ORDER BY MTMessageId DESC) AS rn FROM cl) WHERE rn = 1"""),
    "split_log": w(TPL, "SELECT rules <> '' AS has_placeholder, count(*) AS messages, sum(length(template_text))::BIGINT AS template_chars FROM tpl GROUP BY 1"),
    "run_metadata": w(CLS, """SELECT (SELECT sum(frequency)::BIGINT FROM freq) AS total_messages, (SELECT count(*) FROM fired) AS unique_templates,
  (SELECT count(*) FROM freq WHERE rules = '') AS unique_pure_messages, count(*) AS total_classified, count(*) FILTER (level_used = 'rule') AS matched_rules,
  count(*) FILTER (level_used <> 'rule') AS pending, 100.0::DOUBLE * count(*) FILTER (level_used = 'rule') / count(*) AS coverage_percentage FROM cls"""),
    "run_summary": w(TPL, """SELECT (SELECT count(*) FROM raw) AS total_messages_processed, count(*) AS messages_after_filter, count(DISTINCT template_id) AS unique_templates,
  sum(CASE WHEN rules = '' THEN 0 ELSE len(string_split(rules, ',')) END)::BIGINT AS total_rules_applied, count(DISTINCT ClientName) AS unique_clients,
  count(DISTINCT OperatorName) AS unique_operators, count(DISTINCT (PriorityId, PriorityDescription)) AS unique_priorities, count(DISTINCT PhoneNumber) AS unique_phones FROM tpl"""),
    "normalized_messages": w(RAW, f"SELECT MTMessageId, {norm('Message')} AS NormalizedMessage FROM raw"),
    "normalization_report": w(RAW + f",\nn AS (SELECT Message AS b, {norm('Message')} AS a FROM raw)", """SELECT count(*) AS total, count(*) FILTER (a <> b) AS changed,
  100.0::DOUBLE * count(*) FILTER (a <> b) / count(*) AS changed_pct, sum(length(b))::BIGINT AS chars_before, sum(length(a))::BIGINT AS chars_after,
  (sum(length(b)) - sum(length(a)))::BIGINT AS chars_removed, max(length(b)) AS max_length_before, max(length(a)) AS max_length_after FROM n"""),
    "normalization_samples": w(RAW, f"SELECT MTMessageId, Message, {norm('Message')} AS NormalizedMessage FROM raw WHERE Message <> {norm('Message')} ORDER BY MTMessageId LIMIT 5"),
    "conversation_normalization": f"SELECT conv_id, turn, {norm('text')} AS NormalizedMessage FROM conversations",
    "document_normalization": f"""WITH n AS (SELECT text AS b, {norm('text')} AS a FROM documents) SELECT count(*) AS total, count(*) FILTER (a <> b) AS changed,
  100.0::DOUBLE * count(*) FILTER (a <> b) / count(*) AS changed_pct, sum(length(b))::BIGINT AS chars_before, sum(length(a))::BIGINT AS chars_after,
  (sum(length(b)) - sum(length(a)))::BIGINT AS chars_removed, max(length(b)) AS max_length_before, max(length(a)) AS max_length_after FROM n""",
    "templates": w(TPL, "SELECT MTMessageId, template_id, template_text, rules AS applied_rules, rules <> '' AS has_placeholder FROM tpl"),
    "conversation_templates": text_rows("conversations", "text", "conv_id, turn"),
    "document_templates": text_rows("documents", "text", "doc_id"),
    "page_templates": text_rows("pages", "html", "page_id"),
    "unified_spelling": f"SELECT conv_id, turn, translate({norm('text')}, 'áéíóúüÁÉÍÓÚÜ', 'aeiouuAEIOUU') AS unified FROM conversations",
    "template_frequency": w(FREQ, "SELECT template_id, template_text, rules AS applied_rules, client_name, frequency, first_seen, last_seen FROM fired"),
    "pure_text_frequency": w(TPL, "SELECT cleaned_message, count(*) AS frequency FROM tpl WHERE rules = '' GROUP BY 1"),
    "distinct_counts": w(TPL, "SELECT count(DISTINCT CASE WHEN rules <> '' THEN template_id END) AS unique_templates, count(DISTINCT CASE WHEN rules = '' THEN template_id END) AS unique_pure_messages FROM tpl"),
    "template_stats": w(TPL, """SELECT template_id, template_text, count(*) AS frequency,
  coalesce(array_to_string(list_sort(list_distinct(list(ClientName))), ','), '') AS client_names,
  coalesce(array_to_string(list_sort(list_distinct(list(PriorityId))), ','), '') AS priority_ids,
  coalesce(array_to_string(list_sort(list_distinct(list(OperatorName))), ','), '') AS operator_names,
  count(DISTINCT PhoneNumber) AS phone_count, min(ArrivalDate) AS first_seen, max(ArrivalDate) AS last_seen FROM tpl GROUP BY 1, 2"""),
    "split_summary": w(TPL, """SELECT count(*) AS total, count(*) FILTER (rules <> '') AS with_placeholders, count(*) FILTER (rules = '') AS pure,
  count(*) FILTER (rules <> '')::DOUBLE / count(*) AS placeholder_ratio FROM tpl"""),
    "frequent_coverage": w(FREQ, """SELECT count(*) AS templates, sum(frequency)::BIGINT AS messages, count(*) FILTER (frequency > 1) AS frequent_templates,
  (sum(frequency) FILTER (frequency > 1))::BIGINT AS frequent_messages,
  100.0::DOUBLE * (count(*) FILTER (frequency > 1)::DOUBLE / count(*)) AS frequent_templates_pct,
  100.0::DOUBLE * ((sum(frequency) FILTER (frequency > 1))::DOUBLE / sum(frequency)) AS frequent_messages_pct,
  sum(frequency)::DOUBLE / count(*) AS messages_per_template, 100.0::DOUBLE * (1.0::DOUBLE - count(*)::DOUBLE / sum(frequency)) AS reduction_pct FROM freq"""),
    "frequency_histogram": w(FREQ + f",\nh AS (SELECT {ranges('frequency', FREQUENCY_RANGES)} AS frequency_range, count(*) AS templates, sum(frequency)::BIGINT AS messages FROM freq GROUP BY 1)",
      "SELECT *, 100.0::DOUBLE * (templates::DOUBLE / (SELECT sum(templates) FROM h)) AS templates_pct, 100.0::DOUBLE * (messages::DOUBLE / (SELECT sum(messages) FROM h)) AS messages_pct FROM h"),
    "top_frequent": w(FREQ, "SELECT template_id, template_text, frequency FROM fired WHERE frequency > 1 ORDER BY frequency DESC, template_id LIMIT 10"),
    "top_templates": w(FREQ, "SELECT template_id, template_text, frequency, 100.0::DOUBLE * (frequency::DOUBLE / (SELECT count(*) FROM delivered)) AS pct FROM freq ORDER BY frequency DESC, template_id LIMIT 20"),
    "message_count": w(DELIVERED, "SELECT count(*) AS messages FROM delivered"),
    "client_counts": w(DELIVERED, "SELECT ClientName, count(*) AS messages FROM delivered WHERE ClientName IS NOT NULL GROUP BY 1"),
    "operator_counts": w(DELIVERED, "SELECT OperatorName, count(*) AS messages FROM delivered WHERE OperatorName IS NOT NULL GROUP BY 1"),
    "priority_counts": w(DELIVERED, "SELECT PriorityId, PriorityDescription, count(*) AS messages FROM delivered GROUP BY 1, 2"),
    "client_top": w(DELIVERED, """SELECT ClientName, count(*) AS messages, 100.0::DOUBLE * (count(*)::DOUBLE / (SELECT count(*) FROM delivered)) AS pct
  FROM delivered WHERE ClientName IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5"""),
    "operator_top": w(DELIVERED, """SELECT OperatorName, count(*) AS messages, 100.0::DOUBLE * (count(*)::DOUBLE / (SELECT count(*) FROM delivered)) AS pct
  FROM delivered WHERE OperatorName IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""),
    "distinct_phones": w(DELIVERED, "SELECT count(DISTINCT PhoneNumber) AS phones FROM delivered"),
    "time_range": w(DELIVERED, """SELECT min(ArrivalDate) AS min_timestamp, max(ArrivalDate) AS max_timestamp,
  date_diff('microsecond', min(ArrivalDate), max(ArrivalDate))::DOUBLE / 3.6e9::DOUBLE AS duration_hours FROM delivered"""),
    "message_report": w(DELIVERED, """SELECT count(*) AS total_messages, count(DISTINCT ClientName) AS unique_clients, count(DISTINCT OperatorName) AS unique_operators,
  count(DISTINCT PhoneNumber) AS unique_phones, count(DISTINCT (PriorityId, PriorityDescription)) AS unique_priorities,
  min(ArrivalDate) AS min_timestamp, max(ArrivalDate) AS max_timestamp FROM delivered"""),
    "completeness": w(DELIVERED, " UNION ALL ".join(
      f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NOT NULL AND {c}::VARCHAR <> '') AS filled, 100.0::DOUBLE * count(*) FILTER ({c} IS NOT NULL AND {c}::VARCHAR <> '') / count(*) AS filled_pct FROM delivered"
      for c in ("PhoneNumber", "ClientName", "OperatorName", "ArrivalDate"))),
    "length_bands": w(DELIVERED, f"SELECT {ranges('length(Message)', LENGTH_RANGES)} AS band, count(*) AS messages FROM delivered GROUP BY 1"),
    "rule_classification": w(CLS, f"""SELECT template_id, template_text, client_name, frequency, label, category, subcategory, confidence, level_used, agreement, rule_name,
  {watched_case()} AS matched_tokens FROM cls"""),
    "message_classification": w(TPL + ",\nseen AS (SELECT MTMessageId, template_text, ClientName AS client_name FROM tpl),\n" + classify_cte("mc", "seen"),
      "SELECT MTMessageId, label, level_used, rule_name FROM mc"),
    "rule_coverage": w(CLS, """SELECT count(*) AS total_classified, count(*) FILTER (level_used = 'rule') AS matched_rules, count(*) FILTER (level_used <> 'rule') AS pending,
  100.0::DOUBLE * count(*) FILTER (level_used = 'rule') / count(*) AS coverage_pct FROM cls"""),
    "label_report": w(CLS + """,
lr AS (SELECT label, category, subcategory, sum(frequency)::BIGINT AS frequency, count(*) AS templates, array_to_string(list_sort(list_distinct(list(rule_name))), ', ') AS rules,
  round(avg(confidence), 6) AS avg_confidence FROM cls WHERE trim(label) <> '' GROUP BY 1, 2, 3)""",
      "SELECT *, frequency::DOUBLE / (SELECT sum(frequency) FROM lr) AS share, row_number() OVER (ORDER BY frequency DESC, label)::INT AS rank FROM lr"),
    "label_export": w(CLS, """SELECT template_id, template_text, label, category, subcategory, rule_name, frequency, printf('%.2f', confidence) AS confidence,
  replace(rules, ',', ', ') AS applied_rules FROM cls WHERE trim(label) <> ''"""),
    "pending_top": w(CLS + ",\npd AS (SELECT template_id, template_text, frequency FROM cls_all WHERE level_used = 'pending' ORDER BY frequency DESC, template_id LIMIT 100)",
      "SELECT *, row_number() OVER (ORDER BY frequency DESC, template_id)::INT AS rank, 100.0::DOUBLE * (frequency::DOUBLE / (SELECT sum(frequency) FROM pd)) AS pct FROM pd"),
    "pending_summary": w(CLS, """SELECT count(*) AS templates, sum(frequency)::BIGINT AS total, avg(frequency)::DOUBLE AS mean, max(frequency) AS largest, min(frequency) AS smallest
  FROM (SELECT * FROM cls_all WHERE level_used = 'pending' ORDER BY frequency DESC, template_id LIMIT 100)"""),
    "pending_rules": w(CLS + ",\nt100 AS (SELECT * FROM cls WHERE level_used = 'pending' ORDER BY frequency DESC, template_id LIMIT 100)", """SELECT rule_name, count(*) AS templates
  FROM (SELECT unnest(string_split(rules, ',')) AS rule_name FROM t100) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"""),
    "resolve_votes": w(RES, """SELECT template_id, label, category, subcategory, round(confidence, 6) AS confidence, level_used, agreement, panel_judge_1, panel_judge_2, arbiter_label,
  needs_human_review, error FROM res"""),
    "resolve_votes_partial": w(resolve(True), "SELECT template_id, label, round(confidence, 6) AS confidence, level_used FROM res"),
    "merged_labels": w(PENDING + f""",
v AS (SELECT template_id, judge, CASE WHEN label IN ('banking::otp_2fa', 'government::dian') THEN 'public::security' ELSE label END AS label FROM ({JUDGE_SQL})),
p AS (SELECT template_id, max(label) FILTER (judge = 1) AS a, max(label) FILTER (judge = 2) AS b FROM v GROUP BY 1)""", "SELECT a = b AS same, count(*) AS templates FROM p GROUP BY 1"),
    "level_summary": w(RES, "SELECT count(*) AS total, " + ", ".join(
      f"count(*) FILTER (level_used = '{lv}') AS {lv}, 100.0::DOUBLE * count(*) FILTER (level_used = '{lv}') / greatest(count(*), 1) AS {lv}_pct"
      for lv in ("panel_agreement", "arbiter", "human_review", "error")) + " FROM res"),
    "top_labels": w(RES, "SELECT label, count(*) AS templates, 100.0::DOUBLE * (count(*)::DOUBLE / (SELECT count(*) FROM res)) AS pct FROM res GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"),
    "top_categories": w(RES, "SELECT category, count(*) AS templates, 100.0::DOUBLE * (count(*)::DOUBLE / (SELECT count(*) FROM res)) AS pct FROM res GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"),
    "disagreements": w(RES, """SELECT panel_judge_1 || ' vs ' || panel_judge_2 AS pattern, count(*) AS occurrences,
  100.0::DOUBLE * (count(*)::DOUBLE / (SELECT count(*) FROM res WHERE level_used = 'arbiter')) AS pct FROM res WHERE level_used = 'arbiter' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""),
    "taxonomy_violations": w(RES, f"SELECT label, count(*) AS rows FROM res WHERE label <> '' AND label NOT IN ('ABSTAIN', {', '.join(q(x) for x in TAXONOMY_LABELS)}) GROUP BY 1"),
    "extrapolated_shares": w(RES, """SELECT label, count(*) AS templates,
  round(round(100.0::DOUBLE * (count(*)::DOUBLE / (SELECT count(*) FROM res)) / 100.0::DOUBLE, 6) * 6700000.0::DOUBLE)::BIGINT AS expected_messages
  FROM res GROUP BY 1"""),
    "judged_templates": w(VOTE_CLS, """SELECT template_id, 1::INT AS judge, CASE WHEN length(template_text) % 5 = 4 THEN 'error' WHEN length(template_text) > 30 THEN 'utilities::water' ELSE 'government::dian' END AS label,
  CASE WHEN length(template_text) % 5 = 4 THEN 0.0 ELSE 0.75 END::DOUBLE AS confidence FROM cls_all WHERE level_used = 'pending'"""),
    "store_levels": w(RES, "SELECT level_used, count(*) AS templates, round(avg(confidence), 6) AS avg_confidence FROM res GROUP BY 1"),
    "store_by_level": w(RES, "SELECT template_id, label, first_seen AS classified_at FROM res WHERE level_used = 'rule' ORDER BY first_seen DESC, template_id LIMIT 5"),
    "store_by_confidence": w(RES, "SELECT template_id, round(confidence, 6) AS confidence FROM res WHERE confidence BETWEEN 0.0 AND 0.9::DOUBLE ORDER BY res.confidence, template_id LIMIT 10"),
    "store_by_client": w(RES, "SELECT template_id, client_name, first_seen AS classified_at FROM res WHERE client_name = 'Nequi' ORDER BY first_seen DESC, template_id LIMIT 100"),
    "store_needing_review": w(RES, "SELECT template_id, level_used, needs_human_review FROM res WHERE needs_human_review ORDER BY first_seen DESC, template_id LIMIT 100"),
    "upsert_first_wins": w(SIGHT, """SELECT template_id, label, client_name, arrived AS first_seen, arrived AS last_seen, 1::BIGINT AS frequency FROM early
  UNION ALL SELECT template_id, label, client_name, arrived, arrived, 1 FROM later"""),
    "frequency_update": w(SIGHT + ",\nd AS (SELECT template_id, count(*) AS c, max(arrived) AS l FROM si WHERE arrived >= TIMESTAMP '2024-01-11' GROUP BY 1)",
      "SELECT template_id, 1 + coalesce(c, 0) AS frequency, coalesce(l, arrived) AS last_seen FROM early LEFT JOIN d USING (template_id)"),
    "phone_hours": w(LOOKUP, """SELECT p.phone_number, h.hour::INT AS hour, count(m.phone_number) AS messages FROM (SELECT DISTINCT phone_number FROM m) p
  JOIN range(24) h(hour) ON true LEFT JOIN m ON m.phone_number = p.phone_number AND hour(m.ArrivalDate) = h.hour GROUP BY 1, 2"""),
    "phone_dayparts": w(LOOKUP, "SELECT phone_number, " + ", ".join(
      f"count(*) FILTER (hour(ArrivalDate) >= {a} AND hour(ArrivalDate) < {b})::DOUBLE / count(*) AS {n}_share_last_365d"
      for n, a, b in (("night_00_06", 0, 6), ("morning_06_12", 6, 12), ("afternoon_12_18", 12, 18), ("evening_18_24", 18, 24))) + " FROM m GROUP BY 1"),
    "phone_weekdays": w(LOOKUP, f"SELECT phone_number, (isodow(ArrivalDate) - 1)::INT AS day_index, {list(WEEKDAYS)}[isodow(ArrivalDate)] AS weekday, count(*) AS messages FROM m GROUP BY 1, 2, 3"),
    "phone_categories": w(LOOKUP + ",\ntot AS (SELECT phone_number, count(*) AS t FROM m GROUP BY 1)", """SELECT m.phone_number, category, count(*) AS messages, min(ArrivalDate) AS first_seen, max(ArrivalDate) AS last_seen,
  count(*)::DOUBLE / any_value(t) AS share FROM m JOIN tot ON tot.phone_number = m.phone_number WHERE category <> 'unknown' GROUP BY 1, 2"""),
    "phone_subcategories": w(LOOKUP + ",\ntot AS (SELECT phone_number, category, count(*) AS t FROM m GROUP BY 1, 2)", """SELECT m.phone_number, m.category, subcategory, count(*) AS messages,
  count(*)::DOUBLE / any_value(t) AS share FROM m JOIN tot ON tot.phone_number = m.phone_number AND tot.category = m.category
  WHERE m.category <> 'unknown' AND subcategory <> 'unknown' GROUP BY 1, 2, 3"""),
    "phone_types": w(LOOKUP, "SELECT phone_number, " + ", ".join(f"count(*) FILTER (kind = '{t}') AS {t}" for t in (*MESSAGE_TYPES, "service_notifications")) + " FROM kinds GROUP BY 1"),
    "score_documents_flat": w(LOOKUP + ",\n" + REQUESTS + """,
cat AS (SELECT phone_number, category, count(*) AS n FROM m WHERE category <> 'unknown' GROUP BY 1, 2),
cats AS (SELECT phone_number, count(*) AS c, sum(n)::BIGINT AS s, first(category ORDER BY n DESC, category) AS f FROM cat GROUP BY 1),
agg AS (SELECT phone_number, count(*) AS n, count(*) FILTER (kind = 'otp_2fa') AS otp, count(*) FILTER (kind = 'service_notifications') AS sn,
  count(*) FILTER (hour(ArrivalDate) < 6)::DOUBLE / count(*) AS ns FROM kinds GROUP BY 1)""",
      """SELECT req.phone_number, coalesce(n, 0) AS hour_messages, 24::INT AS hour_buckets, coalesce(n, 0) AS weekday_messages, coalesce(c, 0)::INT AS categories,
  coalesce(s, 0) AS category_messages, coalesce(f, '') AS first_category, coalesce(otp, 0) AS otp_2fa, coalesce(sn, 0) AS service_notifications, coalesce(ns, 0.0::DOUBLE) AS night_share
  FROM req LEFT JOIN agg ON agg.phone_number = req.phone_number LEFT JOIN cats ON cats.phone_number = req.phone_number"""),
    "phone_profile": w(TPL, """SELECT PhoneNumber AS phone_number, template_id, ClientName AS sender, count(*) AS appearances, min(ArrivalDate)::DATE AS first_day, max(ArrivalDate)::DATE AS last_day
  FROM tpl GROUP BY 1, 2, 3"""),
    "hot_templates": w(FREQ, "SELECT template_id, frequency, last_seen FROM freq WHERE frequency >= 50 AND last_seen::DATE >= DATE '2024-01-31' - 90"),
    "known_traffic": w(CLS + ",\nk AS (SELECT template_id FROM cls WHERE level_used = 'rule'),\nr AS (SELECT frequency, template_id IN (SELECT template_id FROM k) AS known FROM freq)",
      """SELECT count(*) FILTER (known) AS known_templates, count(*) FILTER (NOT known) AS unknown_templates, coalesce(sum(frequency) FILTER (known), 0)::BIGINT AS known_messages,
  sum(frequency)::BIGINT AS messages, coalesce(sum(frequency) FILTER (known), 0)::DOUBLE / sum(frequency) AS known_share FROM r"""),
    "known_messages": w(CLS, "SELECT MTMessageId, template_id, template_id IN (SELECT template_id FROM cls WHERE level_used = 'rule') AS known FROM tpl"),
    "near_templates": w(PARTS, """SELECT template_id, other AS similar_id, d::INT AS words_changed FROM (
  SELECT *, row_number() OVER (PARTITION BY template_id ORDER BY d, other) AS rn FROM pairs WHERE d BETWEEN 1 AND 2) WHERE rn = 1"""),
    "similar_levels": w(SIMILAR, "SELECT template_id, level_used, label, confidence, similar_id, similar_score FROM done"),
    "similar_level_counts": w(SIMILAR, "SELECT level_used, count(*) AS templates, sum(length(template_text))::BIGINT AS messages FROM done GROUP BY 1"),
    "label_cuts": w(CUTS, "SELECT label, cut, precision, recall FROM cuts"),
    "accepted_by_cut": w(CUTS, """SELECT predicted_label, coalesce(least(floor(conf * 20), 19) / 20.0 >= cut, false) AS accepted, count(*) AS rows
  FROM pred LEFT JOIN cuts ON cuts.label = predicted_label GROUP BY 1, 2"""),
    "minhash_links": w(GRAMS + f""",
lk AS (SELECT id AS src, least AS dst, count(*) AS bands FROM bk JOIN (SELECT bucket, min(id) AS least FROM bk GROUP BY 1) USING (bucket) WHERE id <> least GROUP BY 1, 2),
{alike('lk')}""", "SELECT src, dst, bands, similarity FROM lk JOIN sim USING (src, dst) WHERE similarity >= 0.8"),
    "embedding_links": """WITH e AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0),
f AS (SELECT v, min(id) AS id FROM e GROUP BY 1)
SELECT a.id AS src, b.id AS dst, round(list_cosine_similarity(a.v, b.v), 5) AS cosine FROM f a JOIN f b ON a.id > b.id WHERE list_cosine_similarity(a.v, b.v) >= 0.4
UNION ALL SELECT e.id, f.id, 1.0 FROM e JOIN f USING (v) WHERE e.id <> f.id""",
    "confusion": w(PRED, "SELECT label, predicted_label, count(*) AS rows FROM pred GROUP BY 1, 2"),
    "submodel_categories": w(PRED + ",\ns AS (SELECT split_part(label, '::', 1) AS category, count(*) AS rows, count(*) FILTER (label <> predicted_label AND split_part(label, '::', 1) = split_part(predicted_label, '::', 1)) AS confused_inside FROM pred GROUP BY 1)",
      "SELECT *, confused_inside::DOUBLE / rows AS confusion_rate, confused_inside::DOUBLE / rows >= 0.2::DOUBLE AS needs_submodel FROM s"),
    "threshold_curve": w(CURVE, "SELECT * FROM curve"),
    "training_readiness": w(SIGHT, "SELECT label, count(*) AS examples, count(*) >= 500 AS ready FROM si WHERE trim(label) <> '' AND confidence >= 0.9::DOUBLE GROUP BY 1"),
    "streamed_template_counts": w(TPL, "SELECT template_id, template_text, count(*) AS frequency, min(ArrivalDate) AS first_seen, max(ArrivalDate) AS last_seen FROM tpl GROUP BY 1, 2"),
    "streamed_first_sightings": w(TPL, "SELECT DISTINCT template_id, template_text FROM tpl"),
}
SQL["word_clusters"] = f"""WITH RECURSIVE {PARTS},
near AS (SELECT template_id AS a, other AS b FROM pairs WHERE d = 1),
reach AS (SELECT DISTINCT a AS node, a AS seen FROM near UNION SELECT node, b FROM reach JOIN near ON seen = a)
SELECT node AS template_id, min(seen) AS cluster_id FROM reach GROUP BY 1"""
SQL["minhash_clusters"] = f"""WITH RECURSIVE {GRAMS},
pr AS (SELECT DISTINCT a.id AS src, b.id AS dst FROM bk a JOIN bk b ON a.bucket = b.bucket AND a.id > b.id), {alike('pr')},
near AS (SELECT src AS a, dst AS b FROM sim WHERE similarity >= 0.8 UNION ALL SELECT dst, src FROM sim WHERE similarity >= 0.8),
reach AS (SELECT DISTINCT a AS node, a AS seen FROM near UNION SELECT node, b FROM reach JOIN near ON seen = a)
SELECT node AS id, min(seen) AS component FROM reach GROUP BY 1"""
SQL["written_first_sightings"] = SQL["streamed_first_sightings"]
SQL["written_split"] = w(TPL, "SELECT rules <> '' AS has_placeholder, count(*) AS messages FROM tpl GROUP BY 1")
SQL["written_template_log"] = w(TPL, """SELECT template_id, CASE WHEN rules <> '' THEN 'with_placeholders' ELSE 'pure_messages' END AS category, 2 * count(*) AS lines
  FROM tpl GROUP BY 1, 2""")
SQL["day_run"] = w(CLS, """SELECT freq.template_id, freq.template_text, freq.frequency, freq.first_seen, freq.last_seen, cls.label, cls.confidence, cls.level_used
  FROM freq LEFT JOIN cls USING (template_id)""")
SQL["stored_slice"] = w(DELIVERED, """SELECT year(ArrivalDate)::INT AS year, month(ArrivalDate)::INT AS month, PhoneNumber, count(*) AS messages
  FROM delivered WHERE ArrivalDate >= TIMESTAMP '2024-01-17' GROUP BY ALL""")
SQL["exported_table"] = w(RES, "SELECT level_used, label, count(*) AS templates, sum(frequency)::BIGINT AS messages FROM res GROUP BY 1, 2")
SQL["scored_phones"] = w(DELIVERED + ",\n" + REQUESTS, """SELECT phone_number, count(PhoneNumber) AS messages, '2024-01-31T00:00:00Z' AS generated_at, 'ref' AS request_reference,
  'standard' AS granularity, 30::BIGINT AS data_lookback_days, '1.0.0' AS version
  FROM req LEFT JOIN (SELECT PhoneNumber FROM delivered WHERE ArrivalDate >= TIMESTAMP '2024-01-01') x ON PhoneNumber = phone_number GROUP BY ALL""")
SQL["phone_profile_updated"] = SQL["phone_profile"]
SQL["word_clusters_updated"] = SQL["word_clusters"]
SQL["own_rules"] = w(FREQ, """SELECT template_id, label, rule_name, CASE rule_name WHEN 'pin' THEN 0.6 WHEN 'bank' THEN 0.5 ELSE 0.0 END::DOUBLE AS confidence,
  CASE WHEN rule_name IS NULL THEN 'pending' ELSE 'rule' END AS level_used FROM (SELECT *, CASE rule_name WHEN 'pin' THEN 'security::pin' WHEN 'bank' THEN 'banking::any' END AS label
  FROM (SELECT *, CASE WHEN NOT contains(template_text, '[ENTIDAD_BANCARIA]') AND (contains(template_text, '[OTP]') OR contains(template_text, '[PHONE]')) THEN 'pin'
    WHEN contains(template_text, '[ENTIDAD_BANCARIA]') THEN 'bank' END AS rule_name FROM freq))""")
SQL["phone_profile_merged"] = SQL["phone_profile"]
