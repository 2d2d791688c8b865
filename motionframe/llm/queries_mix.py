"""Queries of the audit of filters, the mix of sources and the repair of conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import audit, conversations, mixing
from .frames import table


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("filter")


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, most=2.0).drop("repeats")


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.report(conversations.damaged(table(spark, sf_dir, "conversations")))


QUERIES = {"op11_filter_audit": op11_filter_audit, "op12_source_mix": op12_source_mix, "op13_conversations": op13_conversations}


def _crc(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    bits = "list_reduce([xor(c, b)] || range(8), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))"
    return f"xor(list_reduce([4294967295] || list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT), lambda c, b: {bits}), 4294967295)"


def _closed(s: str) -> str:
    """Inserts after a layer: from nothing, system or assistant to user, from user to assistant, and once more around."""
    more = lambda x: f"{{'c': {x}.c + 5, 'a': {x}.a || 'I', 't': {x}.t || "
    u, a = "{'role': 'user', 'text': ''}", "{'role': 'assistant', 'text': ''}"
    to = lambda x, r: f"CASE WHEN {x} IS NOT NULL THEN {more(x)}[{r}]}} END"
    return f"""{s}1 AS (SELECT * REPLACE (list_min([u, {to('n', u)}, {to('s', u)}, {to('a', u)}]) AS u) FROM {s}0),
        {s}2 AS (SELECT * REPLACE (list_min([a, {to('u', a)}]) AS a) FROM {s}1),
        {s}3 AS (SELECT * REPLACE (list_min([u, {to('a', u)}]) AS u) FROM {s}2)"""


SQL = {
    "op11_filter_audit": r"""
        WITH doc AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        lab AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS bad FROM labels GROUP BY doc_id),
        flag AS (SELECT part, (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INT
                 + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS mask, coalesce(good, false)::INT AS good, coalesce(bad, false)::INT AS bad FROM doc LEFT JOIN lab USING (doc_id)),
        cell AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM flag GROUP BY ALL),
        letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
        ord AS (SELECT a.x || b.x || c.x || d.x || e.x AS o FROM letter a, letter b, letter c, letter d, letter e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
        step AS (SELECT o, k::INT AS step, 1 << (ascii(o[k]) - 65) AS own, coalesce(list_sum(list_transform(range(1, k), lambda j: 1 << (ascii(o[j]) - 65))), 0)::BIGINT AS earlier FROM ord, range(1, 6) r(k)),
        met AS (SELECT part, o AS filter_order, step, own, coalesce(sum(n) FILTER (mask & (own | earlier) = 0), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (mask & own > 0 AND mask & earlier = 0), 0)::BIGINT AS removed,
                coalesce(sum(n) FILTER (mask & own > 0 AND mask & earlier > 0), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (mask = own), 0)::BIGINT AS unique_fails,
                coalesce(sum(good) FILTER (mask & own > 0 AND mask & earlier = 0), 0)::BIGINT AS good_lost, coalesce(sum(bad) FILTER (mask & own > 0 AND mask & earlier = 0), 0)::BIGINT AS toxic_lost FROM cell, step GROUP BY ALL)
        SELECT * EXCLUDE (own), sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley FROM met
    """,
    "op12_source_mix": r"""
        WITH doc AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 15))::BIGINT AS k FROM documents),
        src AS (SELECT source, sum(size)::BIGINT AS source_size, [5.0::DOUBLE, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w FROM doc GROUP BY source),
        fil AS (SELECT *, 2 * source_size::DOUBLE AS cap, 2 * source_size / w AS fill, 1.5::DOUBLE * sum(source_size) OVER () AS budget FROM src),
        run AS (SELECT *, budget - coalesce(sum(cap) OVER b, 0) >= fill * (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS is_full FROM fil WINDOW b AS (ORDER BY fill, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        tgt AS (SELECT source, source_size, CASE WHEN is_full THEN cap ELSE w * (budget - coalesce(sum(cap) FILTER (is_full) OVER (), 0)) / (sum(w) FILTER (NOT is_full) OVER ()) END AS target FROM run),
        ned AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM tgt),
        cum AS (SELECT doc_id, size, source_size, target, whole, target - whole * source_size - (sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id) - size) AS room FROM doc d JOIN ned n ON d.source IS NOT DISTINCT FROM n.source)
        SELECT doc_id, size, source_size, target, (size * (whole + (2 * room >= size)::BIGINT))::BIGINT AS taken FROM cum
    """,
    "op13_conversations": f"""
        WITH RECURSIVE raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS k FROM conversations),
        dam AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS copy FROM raw WHERE k <> 0),
        num AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, left(role, 1) AS h FROM dam),
        see AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, lag(h) OVER (PARTITION BY conv_id ORDER BY i) AS before, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]')[-1] AS final FROM num),
        fau AS (SELECT *, final IS NULL AS is_blank, final IS NOT NULL AND again AS is_dup, final IS NOT NULL AND NOT again AND final NOT IN ('.', '!', '?') AS is_cut FROM see),
        tal AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (is_blank) AS blank, count(*) FILTER (is_dup) AS duplicate, count(*) FILTER (is_cut) AS truncated,
                count(*) FILTER (before IS NOT NULL AND before || h NOT IN ('su', 'ua', 'au')) AS illegal, list({{'h': h, 'role': role, 'text': text, 'del': is_blank OR is_dup, 'x': CASE WHEN is_cut THEN 5 ELSE 0 END}} ORDER BY i) AS rs FROM fau GROUP BY conv_id),
        z0 AS (SELECT conv_id, rs, 0 AS i, {{'c': 0, 'a': '', 't': []::STRUCT(role VARCHAR, text VARCHAR)[]}} AS n, NULL::STRUCT(c INT, a VARCHAR, t STRUCT(role VARCHAR, text VARCHAR)[]) AS s, NULL::STRUCT(c INT, a VARCHAR, t STRUCT(role VARCHAR, text VARCHAR)[]) AS u, NULL::STRUCT(c INT, a VARCHAR, t STRUCT(role VARCHAR, text VARCHAR)[]) AS a FROM tal),
        {_closed("z")},
        dp AS (SELECT * FROM z3 UNION ALL (WITH now AS (SELECT *, rs[i + 1] AS r FROM dp WHERE i < len(rs)), y0 AS (SELECT conv_id, rs, i + 1 AS i, {{D_n}} AS n, list_min([{{D_s}}, {{K_ns}}]) AS s, list_min([{{D_u}}, {{K_nu}}, {{K_su}}, {{K_au}}, {{R_nu}}, {{R_su}}, {{R_au}}]) AS u, list_min([{{D_a}}, {{K_ua}}, {{R_ua}}]) AS a FROM now), {_closed("y")} SELECT * FROM y3)),
        fin AS (SELECT conv_id, list_min([n, a]) AS best FROM dp WHERE i = len(rs))
        SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit,
               sha256(coalesce(array_to_string(list_transform(best.t, lambda m: m.role || ':' || m.text), chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN tal t ON c.conv_id IS NOT DISTINCT FROM t.conv_id LEFT JOIN fin f ON c.conv_id IS NOT DISTINCT FROM f.conv_id
    """,
}


def _moves() -> dict[str, str]:
    """The edits of a row by the states that they lead from and to."""
    out = {f"D_{x}": f"CASE WHEN {x} IS NOT NULL THEN {{'c': {x}.c + 2, 'a': {x}.a || 'D', 't': {x}.t}} END" for x in "nsua"}
    for x, y in ("ns", "nu", "su", "au", "ua"):
        out[f"K_{x}{y}"] = f"CASE WHEN {x} IS NOT NULL AND NOT r.del AND r.h = '{y}' THEN {{'c': {x}.c + r.x, 'a': {x}.a || 'K', 't': {x}.t || [{{'role': r.role, 'text': r.text}}]}} END"
        role = {"u": "user", "a": "assistant"}.get(y)
        out[f"R_{x}{y}"] = f"CASE WHEN {x} IS NOT NULL AND NOT r.del THEN {{'c': {x}.c + 1 + r.x, 'a': {x}.a || 'R', 't': {x}.t || [{{'role': '{role}', 'text': r.text}}]}} END"
    return out


for _name, _sql in _moves().items():
    SQL["op13_conversations"] = SQL["op13_conversations"].replace("{" + _name + "}", _sql)
