"""DuckDB counterpart of each registered query."""

from __future__ import annotations

from docmeld.plans.oracle import percentage, rounded, with_parts

_TEXT_DOB = "* REPLACE (dob::varchar AS dob)"
_PUBLISHED = """FROM events_log WHERE match_class <> 'non_match'
    AND scored_ts >= date_trunc('hour', TIMESTAMP '2001-06-01 10:30:00' - INTERVAL 1 HOUR)"""


def _counts(table: str, column: str, alias: str) -> str:
    return f"SELECT {column} AS {alias}, count(*) AS cnt FROM {table} GROUP BY 1"


def _expectations() -> str:
    def rows(table: str, source: str, *rules: tuple[str, str, str]) -> list[str]:
        return [
            f"SELECT '{table}' AS \"table\", '{rule}' AS rule, '{level}' AS level,"
            f" count(*) FILTER (NOT coalesce({passes}, false)) AS violations, count(*) AS total FROM {source}"
            for rule, level, passes in rules
        ]

    def pairs(lane: str, suffix: str) -> list[str]:
        return rows(
            f"{lane}_pairs", f"{lane}_pairs_faulty",
            ("valid_pair", "drop", f"doc_id IS NOT NULL AND {lane}_id IS NOT NULL"),
            ("valid_similarity_scores" + suffix, "warn", "first_name_sim BETWEEN 0 AND 1 AND last_name_sim BETWEEN 0 AND 1"),
            ("valid_exact_flags" + suffix, "warn", "ssn4_exact IN (0, 1) AND dob_exact IN (0, 1)"),
        )

    def matches(lane: str, suffix: str) -> list[str]:
        return rows(
            f"{lane}_matches", f"{lane}_matches_faulty",
            ("valid_weight" + suffix, "warn", "total_weight IS NOT NULL"),
            ("valid_classification" + suffix, "warn", "match_class IN ('match', 'possible_match', 'non_match')"),
            ("weight_class_consistent" + suffix, "fail", "NOT (match_class = 'match' AND total_weight < 4)"),
        )

    parsed = rows(
        "parsed", "parsed",
        ("doc_id_present", "warn", "doc_id IS NOT NULL"),
        ("path_present", "warn", "path IS NOT NULL"),
        ("raw_text_or_unreadable", "warn", "raw_text IS NOT NULL OR unreadable_flag"),
        ("valid_ingest_ts", "warn", "ingest_ts IS NOT NULL"),
    )
    structured = rows(
        "structured", "structured_unchecked",
        ("doc_id_present", "warn", "doc_id IS NOT NULL"),
        ("has_extracted_field", "warn", "first_name IS NOT NULL OR last_name IS NOT NULL OR dob IS NOT NULL"),
        ("valid_dob_format", "warn", "dob IS NULL OR dob BETWEEN DATE '1900-01-01' AND DATE '2025-01-01'"),
        ("valid_ssn4_format", "warn", "ssn4 IS NULL OR regexp_full_match(ssn4, '[0-9]{4}')"),
        ("no_all_nulls", "drop", "first_name IS NOT NULL OR last_name IS NOT NULL OR dob IS NOT NULL OR ssn4 IS NOT NULL"),
    )
    lanes = pairs("member", "") + pairs("auth", "_auth") + matches("member", "") + matches("auth", "_auth")
    return "\nUNION ALL ".join(parsed + structured + lanes)


# All pairs, one by one.
_FIELDS = ("ssn4", "dob", "first_name", "last_name")
_COMPARED = ", ".join(f"nullif(lower(trim({f}::varchar)), '') AS {f}" for f in _FIELDS)
_PATTERNS = f"""SELECT {' + '.join(f"(d.{f} IS NOT NULL AND m.{f} IS NOT NULL)::int * {1 << i}" for i, f in enumerate(_FIELDS))} AS present,
    {' + '.join(f"coalesce(d.{f} = m.{f}, false)::int * {1 << i}" for i, f in enumerate(_FIELDS))} AS agree, count(*) AS pairs
    FROM (SELECT {_COMPARED} FROM structured) d, (SELECT {_COMPARED} FROM member) m GROUP BY 1, 2"""


def _estimated() -> str:
    """Expectation-maximisation as a recursion: one row of parameters per step."""
    ids = range(len(_FIELDS))
    has, agrees = (lambda i: f"(present >> {i} & 1)"), (lambda i: f"(agree >> {i} & 1)")
    rate = lambda w, i: f"(sum({w} * {agrees(i)}) + 0.5::double) / (sum({w} * {has(i)}) + 1.0::double)"
    like = lambda r: " * ".join(
        f"CASE WHEN {has(i)} = 0 THEN 1.0::double WHEN {agrees(i)} = 1 THEN {r}{i} ELSE 1 - {r}{i} END" for i in ids)
    names = ", ".join([f"m{i}" for i in ids] + [f"u{i}" for i in ids])
    fields = "\nUNION ALL ".join(f"SELECT '{f}' AS field_name, m{i} AS m, u{i} AS u FROM done" for i, f in enumerate(_FIELDS))
    return f"""SELECT field_name, {rounded('m', 6)} AS m_probability, {rounded('u', 6)} AS u_probability,
        {rounded('ln(m / u)', 2)} AS agreement_weight, {rounded('ln((1 - m) / (1 - u))', 2)} AS disagreement_weight,
        1.0::double AS field_weight_multiplier
    FROM (WITH RECURSIVE p AS MATERIALIZED (SELECT present, agree, pairs::double AS n FROM ({_PATTERNS})),
        em(step, share, {names}) AS (
            SELECT 0, 1 / (SELECT count(*) FROM member)::double, {', '.join(['0.9::double'] * len(_FIELDS))},
                {', '.join(rate('n', i) for i in ids)} FROM p
            UNION ALL
            SELECT step + 1, sum(sure) / sum(n), {', '.join(rate('sure', i) for i in ids)}, {', '.join(rate('(n - sure)', i) for i in ids)}
            FROM (SELECT *, n * t / (t + f) AS sure
                  FROM (SELECT *, share * {like('m')} AS t, (1 - share) * {like('u')} AS f FROM em, p WHERE step < 100))
            GROUP BY step),
        done AS (SELECT * FROM em WHERE step = 100)
        {fields})"""


_TABLES = {
    "parsed": "parsed", "structured": "structured", "member_pairs": "member_pairs", "auth_pairs": "auth_pairs",
    "member_matches": "member_matches", "auth_matches": "auth_matches", "match_events": "events_log",
}
_LANES = ("parsed", "structured", "member_pairs", "auth_pairs", "member_matches", "auth_matches", "events_log")

_VALIDATION = f"""
SELECT 'parsed_has_rows' AS "check", n > 0 AS passed, 'count=' || n AS detail FROM (SELECT count(*) AS n FROM parsed)
UNION ALL SELECT 'structured_has_rows', CASE WHEN r > 0 THEN n > 0 END, 'structured=' || n || ', readable=' || r
    FROM (SELECT (SELECT count(*) FROM structured) AS n, (SELECT count(*) FROM parsed WHERE NOT unreadable_flag) AS r)
UNION ALL SELECT 'parsed_doc_ids_unique', n = 0, 'dupes=' || n
    FROM (SELECT count(*) AS n FROM (SELECT doc_id FROM parsed GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'structured_doc_ids_unique', n = 0, 'dupes=' || n
    FROM (SELECT count(*) AS n FROM (SELECT doc_id FROM structured GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'structured_in_parsed', n = 0, 'orphans=' || n
    FROM (SELECT count(*) AS n FROM structured s WHERE NOT EXISTS (SELECT 1 FROM parsed p WHERE p.doc_id = s.doc_id))
""" + "".join(
    f"""UNION ALL SELECT '{lane}_matches_populated', CASE WHEN p > 0 THEN m > 0 END, 'pairs=' || p || ', matches=' || m
    FROM (SELECT (SELECT count(*) FROM {lane}_pairs) AS p, (SELECT count(*) FROM {lane}_matches) AS m)
UNION ALL SELECT '{lane}_classes_valid', CASE WHEN m > 0 THEN bad = 0 END, 'invalid=' || bad
    FROM (SELECT count(*) AS m, count(*) FILTER (match_class NOT IN ('match', 'possible_match', 'non_match')) AS bad
          FROM {lane}_matches)
"""
    for lane in ("member", "auth")
) + f"""UNION ALL SELECT 'extraction_complete', CASE WHEN r > 0 AND s > 0 THEN rate >= 80 END,
       'rate=' || rate || ', missing=' || miss || ', readable=' || r
    FROM (SELECT *, {percentage('r - miss', 'r', 1)} AS rate FROM (
        SELECT (SELECT count(*) FROM parsed WHERE NOT unreadable_flag) AS r, (SELECT count(*) FROM structured) AS s,
               (SELECT count(*) FROM parsed p WHERE NOT unreadable_flag
                AND NOT EXISTS (SELECT 1 FROM structured s WHERE s.doc_id = p.doc_id)) AS miss))
UNION ALL SELECT 'event_count', NULL, 'events=' || count(*) FROM events_log"""


def _class_shares(total: str = "count(match_class)") -> str:
    return ", ".join(
        f"{percentage(f'count(*) FILTER (match_class = {c!r})', total)} AS pct_{c}"
        for c in ("match", "possible_match", "non_match")
    )


_PAIRWEIGHTED = f"""
SELECT count(DISTINCT p.doc_id) AS total_docs,
       {percentage('count(*) FILTER (p.unreadable_flag)', 'count(DISTINCT p.doc_id)')} AS pct_unreadable,
       {percentage('count(*) FILTER (s.missing_dob)', 'count(DISTINCT p.doc_id)')} AS pct_missing_dob,
       {percentage('count(*) FILTER (s.missing_ssn4)', 'count(DISTINCT p.doc_id)')} AS pct_missing_ssn4,
       count(*) FILTER (p.parse_error_status IS NOT NULL) AS parse_errors, {_class_shares()}
FROM parsed p LEFT JOIN structured s ON s.doc_id = p.doc_id LEFT JOIN member_matches m ON m.doc_id = p.doc_id"""


def _metrics(key: str = "1") -> str:
    """One metrics row per value of ``key``, an expression over a parsed row."""
    docs = "count(DISTINCT doc_id)"
    return f"""
SELECT * EXCLUDE (key) RENAME (grp AS batch_id) FROM (
    SELECT {key} AS grp, {key} AS key, {docs} AS total_docs,
           {percentage('count(DISTINCT doc_id) FILTER (unreadable_flag)', docs)} AS pct_unreadable,
           {percentage('count(DISTINCT doc_id) FILTER (missing_dob)', docs)} AS pct_missing_dob,
           {percentage('count(DISTINCT doc_id) FILTER (missing_ssn4)', docs)} AS pct_missing_ssn4,
           count(DISTINCT doc_id) FILTER (parse_error_status IS NOT NULL) AS parse_errors
    FROM (SELECT p.*, s.missing_dob, s.missing_ssn4 FROM parsed p LEFT JOIN structured s ON s.doc_id = p.doc_id)
    GROUP BY 1)
JOIN (SELECT {key} AS key, {_class_shares()}
      FROM (SELECT p.*, m.match_class FROM parsed p LEFT JOIN member_matches m ON m.doc_id = p.doc_id)
      GROUP BY 1) USING (key)"""


_DQ = f"SELECT * EXCLUDE (batch_id) FROM ({_metrics()})"
_MONTH = "date_trunc('month', pipeline_run_ts)::timestamp"
_MONTHLY = f"SELECT *, batch_id AS run_ts FROM ({_metrics(_MONTH)})"
_NEEDS_DQ = ("parsed", "structured", "member_matches")


def _gate() -> str:
    limits = {"pct_unreadable": 5, "pct_missing_dob": 20, "pct_missing_ssn4": 30}
    return "\nUNION ALL ".join(
        f"""SELECT '{m}' AS metric, {m} AS value, {v}::double AS "limit", {m} > {v} AS breached,
        CASE WHEN {m} IS NULL THEN 'NO_DATA' WHEN {m} > {v} THEN 'BREACH' ELSE 'PASS' END AS status FROM ({_DQ})"""
        for m, v in limits.items()
    )


def _threshold(name: str, flag: str, limit: int, source: str) -> str:
    return f"""SELECT '{name}' AS check_name, {percentage(f'count(*) FILTER ({flag})', 'count(*)')} AS value,
        '< {limit}%' AS threshold,
        CASE WHEN 100.0 * count(*) FILTER ({flag}) / count(*) < {limit} THEN 'PASS' ELSE 'FAIL' END AS status
        FROM {source}"""


_READABLE = "(SELECT * FROM curated WHERE NOT unreadable_flag)"
_NO_SSN4 = "extracted_ssn4 IS NULL OR extracted_ssn4 = ''"
_STATUS_SQL = """SELECT p.doc_id, unreadable_flag, best_class, best_weight,
       CASE best_class WHEN 'match' THEN 'LOW' WHEN 'possible_match' THEN 'MEDIUM' ELSE 'HIGH' END AS doc_risk_tier
FROM parsed p LEFT JOIN (
    SELECT doc_id, max(total_weight) AS best_weight, arg_max(match_class, total_weight) AS best_class
    FROM member_matches GROUP BY 1) b ON b.doc_id = p.doc_id"""


def _weights(digits: int) -> str:
    return ", ".join(f"{rounded(f'{f}(total_weight)', digits)} AS {f}_weight" for f in ("avg", "min", "max"))


_PAGE_FILES = """
        SELECT page_id // 20 AS lot, sum(strlen(html) + 1)::bigint AS length, md5(string_agg(html || chr(10), '' ORDER BY page_id)) AS content_md5
        FROM pages GROUP BY 1"""

_HISTOGRAM = f"""SELECT round(total_weight, 0) AS weight_bucket, match_class, count(*) AS pair_count
FROM member_matches GROUP BY ALL"""

ORACLE: dict[str, str] = {
    "parse_documents": """
        SELECT '/notes/' || doc_id || '.tif' AS path, md5('/notes/' || doc_id || '.tif') AS doc_id, 1::int AS page_count,
               NULL::varchar AS parse_error_status, length(raw) < 50 AS unreadable_flag,
               TIMESTAMP '2025-01-01 10:00:00' AS pipeline_run_ts, length(raw)::int AS n_chars, md5(raw) AS text_md5
        FROM (SELECT doc_id, array_to_string(list_filter(string_split(text, chr(10)), lambda x: x <> ''),
                                             chr(10) || chr(10)) AS raw FROM documents)""",
    "assemble_text": """
        SELECT '/notes/' || doc_id || '.tif' AS path,
               md5(array_to_string(list_filter(string_split(text, chr(10)), lambda x: x <> ''), chr(10) || chr(10))) AS text_md5
        FROM documents""",
    "unreadable_flag": with_parts("SELECT doc_id, unreadable_flag FROM parsed", "parsed"),
    "readable_documents": with_parts("SELECT doc_id, md5(raw_text) AS text_md5 FROM parsed WHERE NOT unreadable_flag", "parsed"),
    "extract_fields": with_parts(
        """SELECT doc_id, first_name, last_name, dob_text AS dob, ssn4, member_id_on_form, auth_id, provider_name
        FROM fields WHERE NOT unreadable_flag""", "fields"),
    "extract_fields_json": with_parts(
        """SELECT doc_id, first_name, last_name, dob_text AS dob, ssn4, member_id_on_form, auth_id, provider_name
        FROM fields WHERE NOT unreadable_flag""", "fields"),
    "structure_documents": with_parts(f"SELECT {_TEXT_DOB} FROM structured_unchecked", "structured_unchecked"),
    "expect_drop": with_parts(f"SELECT {_TEXT_DOB} FROM structured", "structured"),
    "enrich_auth": with_parts(f"SELECT {_TEXT_DOB} FROM auth_with_member", "auth_with_member"),
    "candidate_pairs_member": with_parts("SELECT doc_id, member_id FROM member_candidates", "member_candidates"),
    "candidate_pairs_auth": with_parts("SELECT doc_id, auth_id FROM auth_candidates", "auth_candidates"),
    "jaro": with_parts(
        """SELECT l_orderkey, l_linenumber, x AS c_name, y AS s_name, jaro AS sim
        FROM business_pairs JOIN exact_jaro ON a = x AND b = y""", "business_pairs", "exact_jaro"),
    "jaro_winkler": with_parts(
        """SELECT l_orderkey, l_linenumber, x AS c_name, y AS s_name, sim
        FROM business_pairs JOIN folded_winkler ON a = lower(x) AND b = lower(y)""", "business_pairs", "folded_winkler"),
    "jw_sim_sql": with_parts(
        """SELECT l_orderkey, l_linenumber, x AS c_name, y AS s_name, sim
        FROM business_pairs JOIN folded_winkler ON a = lower(x) AND b = lower(y)""", "business_pairs", "folded_winkler"),
    "pair_features_member": with_parts("SELECT * FROM member_pairs", "member_pairs"),
    "pair_features_auth": with_parts("SELECT * FROM auth_pairs", "auth_pairs"),
    "fs_score": with_parts(
        "SELECT doc_id, member_id, w_ssn4, w_dob, w_first, w_last, total_weight FROM member_matches", "member_matches"),
    "fs_classify": with_parts("SELECT doc_id, auth_id, total_weight, match_class FROM auth_matches", "auth_matches"),
    "match_events": with_parts("SELECT * FROM events_log", "events_log"),
    "fs_parameters": with_parts(
        "\nUNION ALL ".join(
            f"""SELECT '{f}' AS field_name, m AS m_probability, u AS u_probability,
                {rounded('ln(m / u)', 2)} AS agreement_weight, {rounded('ln((1 - m) / (1 - u))', 2)} AS disagreement_weight,
                1.0::double AS field_weight_multiplier
            FROM (SELECT (SELECT count(*) FILTER (d.{f} = m.{f}::varchar)::double / count(*)
                          FROM form d JOIN member m USING (member_id)) AS m,
                         (SELECT sum(n * n)::double / (sum(n) * sum(n))::double
                          FROM (SELECT count(*) AS n FROM member GROUP BY {f})) AS u)"""
            for f in ("ssn4", "dob")
        ), "form", "member"),
    "fs_agreement_patterns": with_parts(_PATTERNS, "structured", "member"),
    "fs_parameters_estimated": with_parts(_estimated(), "structured", "member"),
    "expectations_report": with_parts(
        _expectations(), "parsed", "structured_unchecked", "member_pairs_faulty", "auth_pairs_faulty",
        "member_matches_faulty", "auth_matches_faulty"),
    "table_counts": with_parts(
        "\nUNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {s}" for t, s in _TABLES.items()), *_LANES),
    "duplicate_doc_ids": with_parts(
        "SELECT doc_id, count(*) AS cnt FROM member_candidates GROUP BY 1 HAVING count(*) > 1", "member_candidates"),
    "repeated_documents": with_parts(
        """SELECT doc_id, count(*) AS cnt FROM (SELECT doc_id FROM parsed UNION ALL SELECT doc_id FROM parsed WHERE path LIKE '%7.%')
        GROUP BY 1 HAVING count(*) > 1""", "parsed"),
    "orphan_structured": with_parts(
        """SELECT doc_id, count(*) AS rows FROM structured s
        WHERE NOT EXISTS (SELECT 1 FROM parsed p WHERE p.doc_id = s.doc_id AND p.path LIKE '/notes/%') GROUP BY 1""",
        "structured", "parsed"),
    "missing_structured": with_parts(
        """SELECT doc_id, count(*) AS rows FROM parsed p WHERE NOT unreadable_flag
        AND NOT EXISTS (SELECT 1 FROM structured s WHERE s.doc_id = p.doc_id) GROUP BY 1""", "parsed", "structured"),
    "validation_report": with_parts(_VALIDATION, *_LANES),
    "dq_metrics": with_parts(_DQ, *_NEEDS_DQ),
    "dq_metrics_pairweighted": with_parts(_PAIRWEIGHTED, *_NEEDS_DQ),
    "dq_gate": with_parts(_gate(), *_NEEDS_DQ),
    "dq_threshold_report": with_parts(
        _threshold("Pct Unreadable", "unreadable_flag", 15, "parsed")
        + "\nUNION ALL " + _threshold("Pct Missing DOB", "missing_dob", 95, "structured")
        + "\nUNION ALL " + _threshold("Pct Missing SSN4", "missing_ssn4", 95, "structured")
        + "\nUNION ALL SELECT 'Total Docs Parsed', count(*)::double, 'n/a', 'INFO' FROM parsed"
        + "\nUNION ALL SELECT 'Total Structured', count(*)::double, 'n/a', 'INFO' FROM structured",
        "parsed", "structured"),
    "dq_threshold_report_readable": with_parts(
        _threshold("Pct Unreadable", "unreadable_flag", 15, "curated")
        + "\nUNION ALL " + _threshold("Pct Missing DOB", "extracted_dob IS NULL", 20, _READABLE)
        + "\nUNION ALL " + _threshold("Pct Missing SSN4", _NO_SSN4, 25, _READABLE)
        + f"""\nUNION ALL SELECT 'Avg Parse Confidence', {rounded('avg(parse_confidence)', 3)}, '> 0.7',
        CASE WHEN avg(parse_confidence) > 0.7 THEN 'PASS' ELSE 'FAIL' END FROM {_READABLE}""", "curated"),
    "recent_runs": with_parts(_MONTHLY + " ORDER BY run_ts DESC LIMIT 20", *_NEEDS_DQ),
    "latest_dq_run": with_parts(_MONTHLY + " ORDER BY run_ts DESC LIMIT 1", *_NEEDS_DQ),
    "run_log_append": with_parts(
        "\nUNION ALL ".join(
            f"""SELECT TIMESTAMP '2025-01-01 0{hour}:00:00' AS run_ts,
            CASE WHEN pct_unreadable > {u} OR pct_missing_dob > {d} OR pct_missing_ssn4 > {s} THEN 'DQ_BREACH'
                 ELSE 'SUCCESS' END AS status, true AS by_this_user FROM ({_DQ})"""
            for hour, (u, d, s) in ((2, (5, 20, 30)), (4, (15, 95, 95)), (3, (5, 20, 30)), (2, (15, 95, 95)))
        ), *_NEEDS_DQ),
    "run_history": with_parts(
        f"""SELECT run_ts, CASE WHEN pct_missing_dob > 95 THEN 'DQ_BREACH' ELSE 'SUCCESS' END AS status, 'history' AS run_by FROM ({_MONTHLY})
        UNION ALL
        SELECT run_ts, CASE WHEN month(run_ts) % 2 = 1 THEN 'VALIDATION_FAILED' ELSE 'ABORTED' END, 'history' FROM ({_MONTHLY})
        ORDER BY run_ts DESC, status LIMIT 19""", *_NEEDS_DQ),
    "src_binary_stream": _PAGE_FILES,
    "src_listed_files": _PAGE_FILES,
    "stream_structured": with_parts(f"SELECT {_TEXT_DOB} FROM structured", "structured"),
    "stream_full_refresh": with_parts(f"SELECT {_TEXT_DOB} FROM structured", "structured"),
    "stream_member_matches": with_parts("SELECT * FROM member_matches", "member_matches"),
    "stream_auth_matches": with_parts("SELECT * EXCLUDE (auth_number_exact, provider_exact) FROM auth_matches", "auth_matches"),
    "stream_match_events": with_parts("SELECT * FROM events_log", "events_log"),
    "publish_payload": with_parts(
        f"SELECT doc_id AS key, * {_PUBLISHED}", "events_log"),
    "publish_status": with_parts(f"SELECT 'PUBLISHED' AS status, count(*) AS events, count(*) AS received {_PUBLISHED}", "events_log"),
    "match_distribution": with_parts(f"SELECT match_class, count(*) AS cnt, {_weights(2)} FROM member_matches GROUP BY 1", "member_matches"),
    "score_histogram": with_parts(_HISTOGRAM, "member_matches"),
    "event_volume": with_parts("SELECT match_class, entity_type, count(*) AS n FROM events_log GROUP BY ALL", "events_log"),
    "doc_types": _counts("documents", "lang", "document_type"),
    "intake_channels": _counts("documents", "source", "source_channel"),
    "auth_status_share": f"""
        SELECT status, cnt, {percentage('cnt', 'total', 1)} AS pct
        FROM (SELECT o_orderstatus AS status, count(*) AS cnt, sum(count(*)) OVER () AS total FROM orders GROUP BY 1)""",
    "risk_tiers": with_parts(f"SELECT doc_risk_tier, count(*) AS cnt FROM ({_STATUS_SQL}) GROUP BY 1", "parsed", "member_matches"),
    "v_pipeline_kpis": with_parts(
        f"""SELECT (SELECT count(*) FROM member) AS total_members, (SELECT count(*) FROM auth) AS total_authorizations,
            (SELECT count(*) FROM curated) AS total_documents,
            (SELECT {rounded('avg(parse_confidence)', 3)} FROM {_READABLE}) AS avg_confidence,
            (SELECT count(*) FROM member_matches WHERE match_class = 'match') AS high_confidence_matches,
            (SELECT count(*) FROM member_matches WHERE match_class = 'possible_match') AS possible_matches""",
        "member", "auth", "curated", "member_matches"),
    "v_dq_metrics": with_parts(
        f"""SELECT *, {percentage('unreadable_count', 'total_docs')} AS pct_unreadable,
            {percentage('missing_dob_count', 'total_docs')} AS pct_missing_dob,
            {percentage('missing_ssn4_count', 'total_docs')} AS pct_missing_ssn4
        FROM (SELECT count(*) AS total_docs, count(*) FILTER (unreadable_flag) AS unreadable_count,
                     count(*) FILTER (NOT unreadable_flag AND extracted_dob IS NULL) AS missing_dob_count,
                     count(*) FILTER (NOT unreadable_flag AND ({_NO_SSN4})) AS missing_ssn4_count,
                     {rounded('avg(parse_confidence) FILTER (NOT unreadable_flag)', 3)} AS avg_parse_confidence
              FROM curated)""", "curated"),
    "v_doc_match_status": with_parts(_STATUS_SQL, "parsed", "member_matches"),
    "v_match_summary": with_parts(
        f"""SELECT match_class, count(*) AS candidate_count, {_weights(3)},
            {rounded('avg(ssn4_exact)', 3)} AS avg_ssn4_agreement, {rounded('avg(dob_exact)', 3)} AS avg_dob_agreement,
            {rounded('avg(first_name_sim)', 3)} AS avg_first_name_sim, {rounded('avg(last_name_sim)', 3)} AS avg_last_name_sim
        FROM member_matches GROUP BY 1""", "member_matches"),
    "v_score_distribution": with_parts(_HISTOGRAM, "member_matches"),
    "v_auth_match_summary": with_parts(
        f"""SELECT match_class, count(*) AS auth_candidate_count, {rounded('avg(total_weight)', 3)} AS avg_weight,
            count(*) FILTER (auth_number_exact = 1) AS direct_auth_matches,
            count(*) FILTER (provider_exact = 1) AS provider_npi_matches FROM auth_matches GROUP BY 1""", "auth_matches"),
    "v_intake_summary": """SELECT lang AS document_type, source AS source_channel, count(*) AS cnt FROM documents GROUP BY ALL""",
    "v_batch_metrics": with_parts(
        """SELECT pipeline_run_ts::date::varchar AS batch_date, count(*) AS docs_parsed,
            count(*) FILTER (unreadable_flag) AS unreadable FROM parsed GROUP BY 1""", "parsed"),
    "v_batch_extraction_metrics": with_parts(
        f"""SELECT batch_date, docs_extracted, missing_dob, missing_ssn4,
            {percentage('docs_extracted', 'readable', 1)} AS extraction_rate
        FROM (SELECT pipeline_run_ts::date::varchar AS batch_date, count(s.doc_id) AS docs_extracted,
                     count(*) FILTER (s.missing_dob) AS missing_dob, count(*) FILTER (s.missing_ssn4) AS missing_ssn4,
                     count(*) AS readable
              FROM (SELECT doc_id, pipeline_run_ts FROM parsed WHERE NOT unreadable_flag) p
              LEFT JOIN (SELECT doc_id, missing_dob, missing_ssn4 FROM structured) s ON s.doc_id = p.doc_id GROUP BY 1)""",
        "parsed", "structured"),
    "v_batch_match_metrics": with_parts(
        f"""SELECT pipeline_run_ts::date::varchar AS batch_date, match_class, count(*) AS pair_count,
            {rounded('avg(total_weight)', 3)} AS avg_weight FROM member_matches GROUP BY ALL""", "member_matches"),
}

# Rows and checksum of each report view: its columns in order of their names, those with a point as numbers of six decimals.
_VIEW_COLUMNS = {
    "v_pipeline_kpis": "avg_confidence. high_confidence_matches possible_matches total_authorizations total_documents total_members",
    "v_dq_metrics": "avg_parse_confidence. missing_dob_count missing_ssn4_count pct_missing_dob. pct_missing_ssn4. pct_unreadable. total_docs unreadable_count",
    "v_doc_match_status": "best_class best_weight. doc_id doc_risk_tier unreadable_flag",
    "v_match_summary": "avg_dob_agreement. avg_first_name_sim. avg_last_name_sim. avg_ssn4_agreement. avg_weight. candidate_count match_class max_weight. min_weight.",
    "v_score_distribution": "match_class pair_count weight_bucket.",
    "v_auth_match_summary": "auth_candidate_count avg_weight. direct_auth_matches match_class provider_npi_matches",
    "v_intake_summary": "cnt document_type source_channel",
    "v_batch_metrics": "batch_date docs_parsed unreadable",
    "v_batch_extraction_metrics": "batch_date docs_extracted extraction_rate. missing_dob missing_ssn4",
    "v_batch_match_metrics": "avg_weight. batch_date match_class pair_count",
}


def _checksum(view: str, columns: str) -> str:
    values = ", ".join(
        f"coalesce({c.rstrip('.')}::{'decimal(28, 6)' if c.endswith('.') else 'varchar'}::varchar, '-')" for c in columns.split()
    )
    return (
        f"SELECT '{view}' AS \"table\", count(*) AS rows, sum(('0x' || substr(md5(concat_ws('|', {values})), 1, 8))::bigint)::bigint AS checksum"
        f" FROM {view}"
    )


def _over_views() -> str:
    """One WITH over the parts of all views and the views themselves."""
    needs = ("parsed", "structured", "member", "auth", "curated", "member_matches", "auth_matches")
    body = "\nUNION ALL ".join(_checksum(v, c) for v, c in _VIEW_COLUMNS.items())
    parts = with_parts("", *needs)
    # A view's own statement repeats its parts; only what follows them is taken.
    tails = {v: ORACLE[v].removeprefix(with_parts("", *_VIEW_NEEDS[v])) for v in _VIEW_COLUMNS}
    return parts.rstrip() + ",\n" + ",\n".join(f"{v} AS ({t})" for v, t in tails.items()) + "\n" + body


_VIEW_NEEDS = {
    "v_pipeline_kpis": ("member", "auth", "curated", "member_matches"),
    "v_dq_metrics": ("curated",),
    "v_doc_match_status": ("parsed", "member_matches"),
    "v_match_summary": ("member_matches",),
    "v_score_distribution": ("member_matches",),
    "v_auth_match_summary": ("auth_matches",),
    "v_intake_summary": (),
    "v_batch_metrics": ("parsed",),
    "v_batch_extraction_metrics": ("parsed", "structured"),
    "v_batch_match_metrics": ("member_matches",),
}
ORACLE["refresh_views"] = _over_views()
ORACLE |= {name + "_kept": ORACLE[name] for name in ("dq_metrics", "v_match_summary", "v_score_distribution", "v_batch_match_metrics")}
