"""The registered queries as DuckDB SQL over the given tables."""

from __future__ import annotations

MEMBER_KEY = "'M' || lpad({}::varchar, 7, '0')"

# Named subqueries: (what they read, SQL). A query lists the ones it needs.
PARTS: dict[str, tuple[tuple[str, ...], str]] = {}


def _part(name: str, *needs: str):
    def keep(sql: str) -> None:
        PARTS[name] = (needs, sql)

    return keep


_part("member")(f"""
    SELECT {MEMBER_KEY.format('c_custkey')} AS member_id,
           split_part(p_name, ' ', 1) AS first_name, split_part(p_name, ' ', 2) AS last_name,
           lpad(((c_custkey * 7919) % 997)::varchar, 4, '0') AS ssn4,
           DATE '1940-01-01' + ((c_custkey * 37) % 911)::int AS dob
    FROM customer JOIN part ON p_partkey = c_custkey""")

_part("auth")(f"""
    SELECT 'A' || o_orderkey AS auth_id, 'AUTH-' || o_orderkey AS auth_number,
           {MEMBER_KEY.format('o_custkey')} AS member_id, o_orderstatus AS status, o_orderpriority AS provider_name
    FROM orders""")

_part("form", "member")(f"""
    SELECT o_orderkey AS k, m.member_id, '/docs/' || o_orderkey || '.pdf' AS path,
           o_orderdate + to_minutes(o_orderkey % 1440) AS ingest_ts,
           CASE WHEN o_orderkey % 17 = 0 THEN NULL
                WHEN o_orderkey % 4 = 0 THEN substr(first_name, 1, 1) || substr(first_name, 3)
                WHEN o_orderkey % 9 = 0 THEN ' ' || first_name || ' '
                ELSE first_name END AS first_name,
           CASE WHEN o_orderkey % 5 = 0 THEN reverse(last_name) ELSE last_name END AS last_name,
           CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE ssn4 END AS ssn4,
           CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 31 = 0 THEN '13/01/1980'
                WHEN o_orderkey % 13 = 0 THEN (dob + 1)::varchar ELSE dob::varchar END AS dob,
           CASE WHEN o_orderkey % 3 = 0 THEN 'AUTH-' || o_orderkey END AS auth_id,
           CASE WHEN o_orderkey % 19 = 0 THEN m.member_id END AS member_id_on_form,
           o_orderpriority AS provider_name, o_orderdate::date AS received
    FROM orders JOIN member m ON m.member_id = {MEMBER_KEY.format('o_custkey')}""")

_part("parsed", "form")("""
    SELECT path, md5(path) AS doc_id, ingest_ts, date_trunc('hour', ingest_ts) AS pipeline_run_ts, raw_text,
           parse_error_status, page_count,
           parse_error_status IS NOT NULL OR raw_text IS NULL OR length(raw_text) < 50 AS unreadable_flag
    FROM (
        SELECT path, ingest_ts,
               CASE WHEN k % 29 = 0 THEN '' WHEN k % 23 = 0 THEN 'Provider: ' || provider_name
                    ELSE concat_ws(chr(10), 'First name: ' || first_name, 'Last name: ' || last_name,
                         'SSN4: ' || ssn4, 'DOB: ' || dob, 'Auth: ' || auth_id, 'Member: ' || member_id_on_form,
                         'Provider: ' || provider_name, 'Received: ' || received) END AS raw_text,
               CASE WHEN k % 29 = 0 THEN 'CORRUPT' END AS parse_error_status,
               (1 + k % 3)::int AS page_count
        FROM form
        UNION ALL
        SELECT '/notes/' || doc_id || '.tif', TIMESTAMP '1995-01-01' + to_minutes(n_chars), text, NULL,
               (1 + n_chars // 3000)::int
        FROM documents)""")

_FIELD = "nullif(regexp_extract(raw_text, '(^|\\n)%s: ([^\\n]+)', 2), '') AS %s"
_FIELDS = ", ".join(
    _FIELD % pair
    for pair in (
        ("First name", "first_name"), ("Last name", "last_name"), ("DOB", "dob_text"), ("SSN4", "ssn4"),
        ("Member", "member_id_on_form"), ("Auth", "auth_id"), ("Provider", "provider_name"),
    )
)
_part("fields", "parsed")(f"SELECT *, {_FIELDS} FROM parsed")

_part("curated", "fields")("""
    SELECT doc_id, unreadable_flag, dob_text AS extracted_dob, ssn4 AS extracted_ssn4,
           len(list_filter(string_split(raw_text, chr(10)), lambda x: x <> ''))::double
               / len(string_split(raw_text, chr(10))) AS parse_confidence
    FROM fields""")

_part("structured_unchecked", "fields")("""
    SELECT doc_id, path, ingest_ts, pipeline_run_ts, page_count, first_name, last_name,
           try_cast(dob_text AS date) AS dob, ssn4, member_id_on_form, auth_id, provider_name,
           dob_text IS NULL AS missing_dob, ssn4 IS NULL OR ssn4 = '' AS missing_ssn4
    FROM fields WHERE NOT unreadable_flag""")

_part("structured", "structured_unchecked")("""
    SELECT * FROM structured_unchecked
    WHERE first_name IS NOT NULL OR last_name IS NOT NULL OR dob IS NOT NULL OR ssn4 IS NOT NULL""")

_part("auth_with_member", "auth", "member")("""
    SELECT a.*, m.first_name, m.last_name, m.ssn4, m.dob FROM auth a JOIN member m USING (member_id)""")

# An OR of equalities is written as one join per key; the second leaves out what the first found.
_part("member_candidates", "structured", "member")("""
    SELECT d.doc_id, d.pipeline_run_ts, d.first_name AS df, d.last_name AS dl, d.ssn4 AS ds, d.dob AS dd,
           m.member_id, m.first_name AS ef, m.last_name AS el, m.ssn4 AS es, m.dob AS ed
    FROM structured d JOIN member m ON d.ssn4 = m.ssn4
    UNION ALL
    SELECT d.doc_id, d.pipeline_run_ts, d.first_name, d.last_name, d.ssn4, d.dob,
           m.member_id, m.first_name, m.last_name, m.ssn4, m.dob
    FROM structured d JOIN member m ON d.dob = m.dob AND (d.ssn4 IS NULL OR d.ssn4 <> m.ssn4)""")

_AUTH_PAIR = """d.doc_id, d.pipeline_run_ts, d.first_name AS df, d.last_name AS dl, d.ssn4 AS ds, d.dob AS dd,
           a.auth_id, a.first_name AS ef, a.last_name AS el, a.ssn4 AS es, a.dob AS ed,
           (d.auth_id = a.auth_number)::int::double AS auth_number_exact,
           (d.provider_name = a.provider_name)::int::double AS provider_exact"""
_part("auth_candidates", "structured", "auth_with_member")(f"""
    SELECT {_AUTH_PAIR} FROM structured d JOIN auth_with_member a ON d.auth_id = a.auth_number
    UNION ALL
    SELECT {_AUTH_PAIR} FROM structured d JOIN auth_with_member a
      ON d.member_id_on_form = a.member_id AND (d.auth_id IS NULL OR d.auth_id <> a.auth_number)""")


def _similarity(names: str, prefix: str) -> None:
    """Jaro by recursion over the characters of the left string.

    State: characters done, right string with the taken ones blanked out, matched characters, their positions.
    """
    _part(f"{prefix}_steps", names)(f"""
        SELECT a, b, greatest(greatest(length(a), length(b)) // 2 - 1, 0) AS w,
               0::bigint AS i, b AS rest, '' AS hits, []::bigint[] AS spots
        FROM {names} WHERE a <> '' AND b <> ''
        UNION ALL
        SELECT a, b, w, i + 1,
               CASE WHEN p > 0 THEN substr(rest, 1, lo + p - 1) || chr(1) || substr(rest, lo + p + 1) ELSE rest END,
               CASE WHEN p > 0 THEN hits || substr(a, i + 1, 1) ELSE hits END,
               CASE WHEN p > 0 THEN list_append(spots, lo + p) ELSE spots END
        FROM (SELECT *, greatest(0, i - w) AS lo,
                     CASE WHEN greatest(0, i - w) < least(i + w + 1, length(b))
                          THEN instr(substr(rest, greatest(0, i - w) + 1,
                                     least(i + w + 1, length(b)) - greatest(0, i - w)), substr(a, i + 1, 1))
                          ELSE 0 END AS p
              FROM {prefix}_steps WHERE i < length(a))""")
    _part(f"{prefix}_jaro", names, f"{prefix}_steps")(f"""
        SELECT a, b, CASE WHEN a = b THEN 1.0::double WHEN m = 0 THEN 0.0::double
                     ELSE (m / length(a)::double + m / length(b)::double + (m - t / 2.0::double) / m) / 3.0::double END AS jaro
        FROM (SELECT a, b, length(hits)::double AS m,
                     len(list_filter(list_zip(string_split(hits, ''),
                         list_transform(list_sort(spots), lambda p: substr(b, p, 1))), lambda z: z[1] <> z[2]))::double AS t
              FROM {prefix}_steps WHERE i = length(a))
        UNION ALL
        SELECT a, b, CASE WHEN a = b THEN 1.0::double ELSE 0.0::double END FROM {names} WHERE a = '' OR b = ''""")
    same = [f"(substr(a, 1, {n}) = substr(b, 1, {n}) AND length(a) >= {n} AND length(b) >= {n})::int" for n in range(1, 5)]
    _part(f"{prefix}_winkler", f"{prefix}_jaro")(f"""
        SELECT a, b, CASE WHEN a = '' OR b = '' THEN 0.0::double WHEN a = b THEN 1.0::double
                     ELSE least(jaro + ({' + '.join(same)}) * 0.1::double * (1.0::double - jaro), 1.0::double) END AS sim
        FROM {prefix}_jaro""")


_part("lane_names", "member_candidates", "auth_candidates")("""
    SELECT lower(trim(coalesce(df, ''))) AS a, lower(trim(ef)) AS b FROM member_candidates
    UNION SELECT lower(trim(coalesce(dl, ''))), lower(trim(el)) FROM member_candidates
    UNION SELECT lower(trim(coalesce(df, ''))), lower(trim(ef)) FROM auth_candidates
    UNION SELECT lower(trim(coalesce(dl, ''))), lower(trim(el)) FROM auth_candidates""")
_similarity("lane_names", "lane")

_part("business_pairs")("""
    SELECT l_orderkey, l_linenumber, c_name AS x, s_name AS y
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey""")
_part("exact_names", "business_pairs")("SELECT DISTINCT x AS a, y AS b FROM business_pairs")
_similarity("exact_names", "exact")
_part("folded_names", "business_pairs")("SELECT DISTINCT lower(x) AS a, lower(y) AS b FROM business_pairs")
_similarity("folded_names", "folded")

for _lane, _id, _extra in (("member", "member_id", ""), ("auth", "auth_id", ", auth_number_exact, provider_exact")):
    _part(f"{_lane}_pairs", f"{_lane}_candidates", "lane_winkler")(f"""
        SELECT c.doc_id, c.{_id}, c.pipeline_run_ts, f.sim AS first_name_sim, l.sim AS last_name_sim,
               (ds = es)::int::double AS ssn4_exact, (dd = ed)::int::double AS dob_exact{_extra}
        FROM {_lane}_candidates c
        JOIN lane_winkler f ON f.a = lower(trim(coalesce(df, ''))) AND f.b = lower(trim(ef))
        JOIN lane_winkler l ON l.a = lower(trim(coalesce(dl, ''))) AND l.b = lower(trim(el))""")
    _part(f"{_lane}_pairs_faulty", f"{_lane}_pairs")(f"""
        SELECT * REPLACE (CASE WHEN substr({_id}, 2)::bigint % 97 <> 0 THEN {_id} END AS {_id}) FROM {_lane}_pairs""")
    _scored = """
        SELECT *, CASE WHEN total_weight >= {at} THEN 'match' WHEN total_weight >= 4 THEN 'possible_match'
                       ELSE 'non_match' END AS match_class, pipeline_run_ts AS scored_ts
        FROM (SELECT *, w_ssn4 + w_dob + w_first + w_last AS total_weight
              FROM (SELECT *, CASE WHEN ssn4_exact = 1 THEN 4.595::double ELSE -4.595::double END AS w_ssn4,
                           CASE WHEN dob_exact = 1 THEN 3.892::double ELSE -3.892::double END AS w_dob,
                           first_name_sim * 2.0::double - 1.0::double AS w_first,
                           last_name_sim * 2.0::double - 1.0::double AS w_last
                    FROM {pairs}))"""
    _part(f"{_lane}_matches", f"{_lane}_pairs")(_scored.format(at=8, pairs=f"{_lane}_pairs"))
    _part(f"{_lane}_matches_faulty", f"{_lane}_pairs_faulty")(_scored.format(at=2, pairs=f"{_lane}_pairs_faulty"))

_EVENT = """doc_id, {} AS entity_id, '{}' AS entity_type, pipeline_run_ts, match_class, total_weight,
           w_ssn4, w_dob, w_first, w_last, scored_ts"""
_part("events_log", "member_matches", "auth_matches")(f"""
    SELECT {_EVENT.format('member_id', 'member')} FROM member_matches
    UNION ALL SELECT {_EVENT.format('auth_id', 'auth')} FROM auth_matches""")


def with_parts(query: str, *needs: str) -> str:
    """``query`` preceded by the named subqueries it needs, in order of dependence."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in PARTS[name][0]:
            if need != name:
                add(need)
        if name not in order:
            order.append(name)

    for name in needs:
        add(name)
    if not order:
        return query
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({PARTS[n][1]})" for n in order) + "\n" + query


def rounded(value: str, digits: int) -> str:
    return f"round(({value})::decimal(28, 9), {digits})::double"


def percentage(part: str, whole: str, digits: int = 2) -> str:
    """100 * part / whole of two counts, half up, in whole numbers."""
    scale = 10**digits
    return (
        f"CASE WHEN ({whole}) > 0 THEN ((({part})::bigint * {200 * scale} + ({whole})::bigint)"
        f" // (({whole})::bigint * 2))::double / {scale}.0::double END"
    )
