"""DuckDB SQL with the same rows as the queries, where SQL can express them."""

from __future__ import annotations

from tallyline.llm import secrets

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def quality_sql(docs: str = "documents") -> str:
    """Common table expressions up to ``judged``: the measures of each document and its verdict."""
    lengths = {5: 15, 6: 14, 7: 13, 8: 12, 9: 11, 10: 10}
    parts = []
    for n in lengths:
        parts.append(
            f"""g{n} AS (SELECT rid, i, hash AS gram, count(*) OVER (PARTITION BY rid, hash) AS times,
                row_number() OVER (PARTITION BY rid, hash ORDER BY i) AS nth
                FROM (SELECT rid, unnest(range(1, len(words) - {n - 2})) AS i,
                        unnest(list_transform(range(1, len(words) - {n - 2}), lambda i: array_to_string(words[i:i + {n - 1}], ' '))) AS hash
                    FROM w WHERE len(words) >= {n}))"""
        )
    for n in lengths:
        parts.append(
            f"""c{n} AS (SELECT rid, sum(length(words[i])) AS dup_chars_{n} FROM (
                SELECT DISTINCT rid, unnest(range(i, i + {n})) AS i FROM g{n} WHERE nth > 1) JOIN w USING (rid) GROUP BY rid)"""
        )
    over = " OR ".join(f"100 * coalesce(dup_chars_{n}, 0) > {p} * word_chars" for n, p in lengths.items())
    joins = " ".join(f"LEFT JOIN c{n} USING (rid)" for n in lengths)
    return rf"""
        d AS (SELECT row_number() OVER () AS rid, * FROM {docs}),
        w AS (SELECT rid, doc_id, {WORDS} AS words, coalesce(text, '') AS body FROM d),
        {", ".join(parts)},
        r AS (SELECT rid, count(DISTINCT j) AS n_repeat_words FROM (
            SELECT rid, unnest(range(i, i + 8)) AS j FROM g8 WHERE times > 1) GROUP BY rid),
        l AS (SELECT rid, line, row_number() OVER (PARTITION BY rid, line) AS nth
            FROM (SELECT rid, unnest(string_split(body, chr(10))) AS line FROM w)
            WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
        ls AS (SELECT rid, count(*) AS n_lines, count(*) FILTER (nth > 1) AS n_dup_lines, sum(length(line)) AS line_chars,
            coalesce(sum(length(line)) FILTER (nth > 1), 0) AS dup_line_chars FROM l GROUP BY rid),
        m AS (SELECT rid, doc_id, CAST(len(words) AS BIGINT) AS n_words,
                CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
                CAST(length(regexp_replace(body, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols FROM w),
        judged AS (SELECT rid, doc_id, n_words, word_chars, n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
                CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
                n_words < 20 OR 100 * coalesce(n_repeat_words, 0) > 30 * n_words AS base_failed,
                NOT (n_words < 20 OR 100 * coalesce(n_repeat_words, 0) > 30 * n_words
                    OR 100 * coalesce(n_dup_lines, 0) > 30 * coalesce(n_lines, 0)
                    OR 100 * coalesce(dup_line_chars, 0) > 20 * coalesce(line_chars, 0)
                    OR 100 * n_symbols > 10 * n_words OR {over}) AS kept
            FROM m LEFT JOIN ls USING (rid) LEFT JOIN r USING (rid) {joins})"""


def place_sql(value: str) -> str:
    return f"CAST(('0x' || substr(md5('7:' || {value}), 1, 7)) AS BIGINT)"


MIX_SHARDS = 8


def mixing_sql(docs: str = "documents") -> str:
    """Common table expressions up to ``mixed``: what the mix takes of each document."""
    return rf"""
        z AS (SELECT *, CAST(len({WORDS}) AS BIGINT) AS size, md5(coalesce(text, '')) AS digest,
            {place_sql("coalesce(CAST(doc_id AS VARCHAR), '-') || ':' || md5(coalesce(text, ''))")} AS place FROM {docs}),
        s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM z GROUP BY source),
        s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk FROM s0),
        s2 AS (SELECT *, CAST(rk % 3 + 1 AS DOUBLE) AS weight, 3 * source_size AS most FROM s1),
        s3 AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER b, 0))
                / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS own_level
            FROM s2 WINDOW b AS (ORDER BY most / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        s4 AS (SELECT *, max(own_level) FILTER (most >= own_level * weight) OVER () AS lvl FROM s3),
        t AS (SELECT source, source_size, rk, least(CAST(most AS DOUBLE), lvl * weight) AS target FROM s4),
        n AS (SELECT CAST(round(sum(target) / 16) AS BIGINT) AS seats, sum(target) AS total FROM t),
        q1 AS (SELECT source, rk, target, unnest(range(0, CAST(ceil(target / total * seats * 1.5) AS BIGINT) + 8)) AS j, seats, total
            FROM t, n WHERE total > 0),
        q2 AS (SELECT source, row_number() OVER (ORDER BY target / (2 * j + 1) DESC, rk, j) AS seat, seats, total FROM q1),
        cuts AS (SELECT h, unnest(range(0, {MIX_SHARDS} + 1)) AS cut FROM (SELECT 0 AS h)),
        q3 AS (SELECT source, cut, count(*) FILTER (seat <= CAST(round(total * cut / {MIX_SHARDS} / 16) AS BIGINT)) AS upto
            FROM q2, cuts GROUP BY source, cut),
        q AS (SELECT t.source, any_value(source_size) AS source_size, any_value(target) AS target,
                list(least(16 * coalesce(upto, 0), 3 * source_size) ORDER BY cuts.cut) AS stops FROM t, cuts
            LEFT JOIN q3 ON t.source IS NOT DISTINCT FROM q3.source AND q3.cut = cuts.cut GROUP BY t.source),
        e AS (SELECT z.*, source_size, target, stops,
                sum(size) OVER (PARTITION BY z.source ORDER BY place, size, doc_id NULLS FIRST, digest
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS high,
                {place_sql("'start:' || coalesce(z.source, '-')")} % nullif(source_size, 0) AS start
            FROM z JOIN q ON z.source IS NOT DISTINCT FROM q.source),
        g AS (SELECT *, list_transform(stops, lambda s: CAST(CASE WHEN size = 0 THEN 0 ELSE
                s // source_size * size
                + greatest(least(high, start + s % source_size) - greatest(high - size, start), 0)
                + greatest(least(high, start + s % source_size - source_size) - (high - size), 0) END AS BIGINT)) AS upto FROM e),
        mixed AS (SELECT doc_id, size, source_size, target, upto[{MIX_SHARDS + 1}] AS taken,
            array_to_string([upto[h + 1] - upto[h] for h in range(1, {MIX_SHARDS} + 1)], ',') AS shard_words FROM g)"""


def drawn_sql(*values: str) -> str:
    return f"CAST(('0x' || substr(md5(concat_ws(':', {', '.join(values)})), 1, 7)) AS BIGINT)"


URL_FILTER = rf"""WITH
    p AS (SELECT page_id, url, 1704067200 + {drawn_sql("'fetch'", "page_id")} % 31536000 AS fetched_at,
            nullif(rtrim(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '.'), '') AS host,
            regexp_replace(url, '(?s)#.*$', '') AS bare FROM pages),
    h AS (SELECT DISTINCT host AS entry FROM p WHERE host IS NOT NULL),
    parents AS (SELECT DISTINCT regexp_replace(entry, '^[^.]*\.', '') AS entry FROM h),
    domains AS (SELECT entry FROM h UNION SELECT entry FROM parents WHERE len(string_split(entry, '.')) > 2),
    urls AS (SELECT DISTINCT bare AS entry FROM p WHERE {drawn_sql("'pick'", "page_id")} % 5 = 0),
    entries AS (SELECT 'domain' AS kind, entry, turn, 1704067200 + {drawn_sql("'domain'", "entry", "turn")} % 31536000 AS since FROM domains, range(4) r(turn)
        UNION ALL SELECT 'url', entry, 0, 1704067200 + {drawn_sql("'url'", "entry", "0")} % 31536000 FROM urls WHERE entry IS NOT NULL),
    dated AS (SELECT kind, entry, since, bool_or(turn % 2 = 0) AS listed FROM entries GROUP BY ALL),
    spans AS (SELECT *, lead(since) OVER (PARTITION BY kind, entry ORDER BY since) AS until FROM dated),
    met AS (SELECT DISTINCT page_id, url, fetched_at, kind, entry, since FROM p JOIN spans
        ON ((kind = 'domain' AND (host = entry OR ends_with(host, '.' || entry))) OR (kind = 'url' AND bare = entry))
        AND listed AND since <= fetched_at AND (until IS NULL OR fetched_at < until)),
    v AS (SELECT page_id, count(*) AS n, min(kind || ':' || entry) AS entry, min(since) AS since FROM met GROUP BY page_id)
    SELECT page_id, url, fetched_at, coalesce(n, 0) AS n_active, entry, since, coalesce(n, 0) > 0 AS blocked FROM p LEFT JOIN v USING (page_id)"""

def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _matches_sql(name: str, pattern: str) -> str:
    """Matches of a pattern with their positions, from the lengths of what is between them."""
    p = _quoted(pattern)
    return f"""{name} AS (SELECT rid, k, m[k] AS hit, coalesce(list_sum(list_transform(g[:k], lambda x: length(x))), 0)
                + coalesce(list_sum(list_transform(m[:k - 1], lambda x: length(x))), 0) AS start, v[k] AS value
            FROM (SELECT rid, m, v, string_split_regex(body, {p}) AS g, unnest(range(1, len(m) + 1)) AS k
                FROM (SELECT rid, body, regexp_extract_all(body, {p}) AS m,
                    regexp_extract_all(body, {p}, {2 if name == "assign" else 0}) AS v FROM d)))"""


def secrets_sql(docs: str = "documents") -> str:
    """Common table expressions up to ``spans``: spans of all kinds by row, the random ones by the same battery and limits."""
    cases = " ".join(
        f"WHEN regexp_full_match(hit, {_quoted(pattern)}) THEN {number if alphabet else 'NULL'}"
        for number, (_, pattern, alphabet) in enumerate(secrets.ENCODINGS)
    )
    alphabets = ", ".join(_quoted(alphabet or "") for _, _, alphabet in secrets.ENCODINGS)
    classes = " + ".join(f"CAST(length(hit) >= {least} AS INTEGER)" for least in secrets.LENGTHS[1:])
    series = "0.0"
    for factor in reversed(secrets.ERFC):
        series = f"(({series} + {factor}) * t)"
    above = ", ".join(f"count(*) FILTER (p >= {t}) AS above_{k}" for k, t in enumerate(secrets.LIMITS))
    choices = ", ".join(
        f"CASE WHEN greatest(above_{k} - upper - upper * (0.5 - {t}) / 0.5, 0) + 1 <= {secrets.FALSE_SHARE} * above_{k} THEN {t} END"
        for k, t in enumerate(secrets.LIMITS)
    )
    return rf"""
        d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body FROM {docs}),
        {_matches_sql("assign", secrets.ASSIGN)},
        {_matches_sql("access", secrets.ACCESS)},
        {_matches_sql("hex", secrets.HEX)},
        {_matches_sql("token", secrets.TOKEN)},
        base AS (SELECT rid, start, 0 AS place, start + length(hit) AS stop FROM assign WHERE length(value) >= {secrets.LEAST_VALUE}
            UNION ALL SELECT rid, start, 1, start + length(hit) FROM access UNION ALL SELECT rid, start, 2, start + length(hit) FROM hex),
        e AS (SELECT *, CASE {cases} END AS enc FROM token),
        u AS (SELECT DISTINCT hit, enc, [{alphabets}][enc + 1] AS alphabet, enc * {len(secrets.LENGTHS)} + {classes} AS stratum
            FROM e WHERE enc IS NOT NULL),
        c AS (SELECT hit, stratum, CAST(length(alphabet) AS DOUBLE) AS a, CAST(length(hit) AS DOUBLE) AS n,
                list_transform(range(1, length(hit) + 1), lambda i:
                    instr(alphabet, substr(CASE WHEN enc = {secrets._number("letters")} THEN lower(hit) ELSE hit END, i, 1))) AS x FROM u),
        s AS (SELECT *, list_sum(list_transform(range(1, CAST(a AS BIGINT) + 1), lambda v: len(list_filter(x, lambda w: w = v)) ** 2)) AS squares,
                2.0 * len(list_filter(x, lambda v: 2 * v > a)) * (n - len(list_filter(x, lambda v: 2 * v > a))) AS product,
                len(list_filter(range(2, len(x) + 1), lambda i: (2 * x[i] > a) <> (2 * x[i - 1] > a))) AS changes,
                list_sum(list_transform(range(2, len(x) + 1), lambda i: (2 * x[i] - a - 1) * (2 * x[i - 1] - a - 1))) AS away FROM c),
        z AS (SELECT *, product * (product - n) / (n * n * (n - 1)) AS spread,
                abs(((a * squares / n - n) - (a - 1)) / sqrt(2.0 * (a - 1) * (n - 1) / n)) AS chi,
                abs(away * 3.0 / (a * a - 1.0) / sqrt(n - 1)) AS serial FROM s),
        f AS (SELECT *, greatest(chi, CASE WHEN spread > 0 THEN abs((changes - product / n) / sqrt(spread)) END, serial) / sqrt(2) AS far FROM z),
        q AS (SELECT hit, stratum, CASE WHEN spread > 0 THEN 1 - (1 - {series} * exp(-far * far)) ** 3 ELSE 0 END AS p
            FROM (SELECT *, 1 / (1 + {secrets.ERFC_SCALE} * far) AS t FROM f)),
        counted AS (SELECT stratum, count(*) FILTER (p >= 0.5) AS upper, {above} FROM q GROUP BY stratum),
        lim AS (SELECT stratum, coalesce({choices}) AS lowest FROM counted),
        random AS (SELECT rid, start, 3 AS place, start + length(hit) AS stop FROM token JOIN q USING (hit) JOIN lim USING (stratum) WHERE p >= lowest
            AND NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = token.rid AND b.start < token.start + length(hit) AND token.start < b.stop)),
        spans AS (SELECT *, ['assign', 'access', 'hex', 'random'][place + 1] || ':' || start || ':' || stop AS name FROM (FROM base UNION ALL FROM random))"""


TERMS = (
    r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)


def search_sql(docs: str = "documents", items: str = "benchmark", top: int = 10) -> str:
    """Common table expressions up to ``ranked``: every document scored for every item."""
    return f"""
        t AS (SELECT rid, doc_id, unnest({TERMS}) AS term FROM (SELECT row_number() OVER () AS rid, doc_id, text FROM {docs})),
        c AS (SELECT rid, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM t GROUP BY rid, term),
        n AS (SELECT rid, CAST(sum(tf) AS BIGINT) AS n FROM c GROUP BY rid),
        z AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM n),
        df AS (SELECT term, count(*) AS df FROM c GROUP BY term),
        q AS (SELECT DISTINCT qid, item_id, unnest({TERMS}) AS term FROM (SELECT row_number() OVER () AS qid, item_id, text FROM {items})),
        w AS (SELECT qid, item_id, term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w FROM q JOIN df USING (term), z),
        s AS (SELECT qid, any_value(item_id) AS item_id, rid, any_value(c.doc_id) AS doc_id,
                CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words)))) AS BIGINT) AS score
            FROM w JOIN c USING (term) JOIN n USING (rid), z GROUP BY qid, rid),
        ranked AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank,
                doc_id, score FROM s WHERE score > 0 QUALIFY rank <= {top})"""


WARC = """WITH
    d AS (SELECT page_id, url, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
    r AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS response FROM d),
    t AS (SELECT *, payload_bytes >= 1000 AND response IS NOT NULL AND page_id IS DISTINCT FROM response AS again FROM r)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN again THEN response END AS refers_to, url FROM t"""


def _escapes(text: str) -> str:
    """Characters that escaping adds to a text."""
    controls = r"<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>"
    return f"length({text}) - length(replace({text}, chr(92), '')) + len(regexp_extract_all({text}, '{controls}'))"


CHAT = f"""WITH
    said AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
    sized AS (SELECT *, 8 + length(role) + {_escapes("role")} + length(role) - length(replace(role, chr(10), ''))
        + length(text) + {_escapes("text")} AS chars FROM said)
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
        CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
        CAST(sum(chars) AS BIGINT) AS formatted_chars
    FROM sized GROUP BY conv_id"""


SQL: dict[str, str] = {
    "op1_warc_round_trip": WARC,
    "op4_chat_prefix_tree": CHAT,
    "op3_temporal_url_filter": URL_FILTER,
    "op6_source_mixing": f"WITH {mixing_sql()} SELECT doc_id, size, source_size, target, taken, shard_words FROM mixed",
    "op9_quality_rules": f"""WITH {quality_sql()}
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged""",
    "op11_secret_scan": f"""WITH {secrets_sql()}
        SELECT any_value(d.doc_id) AS doc_id, count(*) FILTER (place = 0) AS n_assign, count(*) FILTER (place = 1) AS n_access,
            count(*) FILTER (place = 2) AS n_hex,
            sha256(coalesce(string_agg(name, ',' ORDER BY start, place) FILTER (place < 3), '')) AS base_sha256,
            coalesce(string_agg(name, ',' ORDER BY start, place), '') AS spans
        FROM d LEFT JOIN spans USING (rid) GROUP BY rid""",
    "op12_ranked_search": f"WITH {search_sql()} SELECT item_id, rank, doc_id, score FROM ranked",
}
