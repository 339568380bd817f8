"""The SQL twins of the queries that SQL can express."""

from __future__ import annotations

CHAT_FORMAT = r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
),
escaped AS (
    SELECT *,
        regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') AS body,
        regexp_replace(replace(regexp_replace(role, '<(\\*)n>', '<\\\1n>', 'g'), chr(10), '<n>'), '<(\\*)\|', '<\\\1|', 'g')
            AS head
    FROM rows
)
SELECT
    conv_id,
    count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length('<|im_start|>' || head || chr(10) || body || '<|im_end|>' || chr(10))) AS BIGINT) AS formatted_chars
FROM escaped
GROUP BY conv_id
"""

MIX = r"""
WITH sizes AS (
    SELECT doc_id, source, md5(coalesce(text, '')) AS hash,
        row_number() OVER (PARTITION BY doc_id, source, md5(coalesce(text, ''))) - 1 AS copy,
        CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
    FROM documents
),
sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source
),
weighed AS (
    SELECT *, list_extract([5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE], (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1) AS weight,
        1.5::DOUBLE * sum(source_size) OVER () AS need
    FROM sources
),
levels AS (
    SELECT (need - coalesce(sum(2.0::DOUBLE * source_size) OVER before, 0)) / sum(weight) OVER after AS level
    FROM weighed WHERE source_size > 0
    WINDOW before AS (ORDER BY weight / source_size DESC, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
        after AS (ORDER BY weight / source_size DESC, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
),
targets AS (
    SELECT source, source_size,
        CASE WHEN source_size > 0 THEN least(2.0::DOUBLE * source_size, (SELECT max(level) FROM levels) * weight) ELSE 0 END
            AS target
    FROM weighed
),
preferred AS (
    SELECT sizes.*, source_size, target,
        CASE WHEN size > 0 THEN pow(2.0::DOUBLE, greatest(-128.0::DOUBLE, least(128.0::DOUBLE,
            round(log2(sqrt(size / 256.0::DOUBLE)) * 16))) / 16) ELSE 1.0 END AS pref
    FROM sizes JOIN targets ON sizes.source IS NOT DISTINCT FROM targets.source
),
classes AS (
    SELECT source, pref, max(target) AS target, sum(size) AS mass FROM preferred GROUP BY ALL HAVING sum(size) > 0
),
reached AS (
    SELECT source, greatest(max(level), 0) AS level
    FROM (SELECT source, (target - coalesce(sum(2.0::DOUBLE * mass) OVER before, 0)) / sum(mass * pref) OVER after AS level
          FROM classes
          WINDOW before AS (PARTITION BY source ORDER BY pref DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
              after AS (PARTITION BY source ORDER BY pref DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    GROUP BY source
),
wanted AS (
    SELECT preferred.*, least(2.0::DOUBLE, coalesce(level, 0) * pref) AS copies,
        (('0x' || substr(md5(concat_ws(':', coalesce(CAST(doc_id AS VARCHAR), 'null'), hash, copy)), 1, 13))::BIGINT
            + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
    FROM preferred LEFT JOIN reached ON preferred.source IS NOT DISTINCT FROM reached.source
),
ranked AS (
    SELECT *, floor(copies) AS whole,
        CASE WHEN copies > floor(copies)
            THEN u / (1 - u) / ((copies - floor(copies)) / (1 - (copies - floor(copies)))) END AS odds
    FROM wanted
),
placed AS (
    SELECT *, target - sum(size * whole) OVER (PARTITION BY source) AS rest,
        sum(CASE WHEN odds IS NOT NULL THEN size END) OVER (
            PARTITION BY source ORDER BY odds NULLS LAST, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier
    FROM ranked
)
SELECT doc_id, size, source_size, target,
    CAST(size * (whole + CASE
        WHEN odds IS NOT NULL AND 2 * coalesce(earlier, 0) + size <= 2 * rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed
"""

URL_FILTER = r"""
WITH rules(verdict, host, path) AS (
    VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
        ('block', 'net', '/es/'), ('block', 'net', '/fr/')
),
split AS (
    SELECT page_id,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
    FROM pages
),
fits AS (
    SELECT page_id, max_by(rules.host || rules.path, length(rules.host || rules.path)) AS rule,
        max_by(verdict, length(rules.host || rules.path)) AS verdict
    FROM (SELECT DISTINCT * FROM split) s JOIN rules
        ON (s.host = rules.host OR ends_with(s.host, '.' || rules.host)) AND starts_with(s.path, rules.path)
    GROUP BY page_id
)
SELECT split.page_id, split.host, split.path, rule, coalesce(verdict, 'allow') AS verdict
FROM split LEFT JOIN fits ON split.page_id = fits.page_id
"""

QUALITY_RULES = r"""
WITH docs AS (
    SELECT doc_id, coalesce(source, '') AS host, source IS NULL AS no_host, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines,
        row_number() OVER () AS row_no
    FROM documents
),
grams AS (
    SELECT row_no, i, array_to_string(words[i:i + 4], ' ') AS gram
    FROM (SELECT row_no, words, unnest(range(1, len(words) - 3)) AS i FROM docs)
),
covered AS (
    SELECT row_no, count(DISTINCT i + j) AS n
    FROM (SELECT row_no, i, unnest(range(5)) AS j
          FROM (SELECT *, count(*) OVER (PARTITION BY row_no, gram) AS times FROM grams) WHERE times > 1)
    GROUP BY row_no
),
lines AS (
    SELECT row_no, host, no_host, line, max(n) AS n, sum(n) AS all_n
    FROM (SELECT row_no, host, no_host,
              regexp_replace(trim(regexp_replace(
                  translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+', ' ', 'g'
              )), '^ | $', '', 'g') AS line,
              len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS n
          FROM (SELECT row_no, host, no_host, unnest(lines) AS l FROM docs))
    GROUP BY ALL
),
bodies AS (
    SELECT docs.row_no, docs.host, docs.no_host, coalesce(md5(string_agg(line, chr(10) ORDER BY line)), '') AS body
    FROM docs LEFT JOIN lines USING (row_no) GROUP BY ALL
),
frequent AS (
    SELECT host, no_host, line
    FROM (SELECT lines.host, lines.no_host, line, count(DISTINCT body) AS n FROM lines JOIN bodies USING (row_no) GROUP BY ALL)
    JOIN (SELECT host, no_host, count(DISTINCT body) AS of FROM bodies GROUP BY ALL) USING (host, no_host)
    WHERE n > 20 AND n * 100 > of * 2
),
hits AS MATERIALIZED (SELECT row_no, host, no_host, line, all_n FROM lines JOIN frequent USING (host, no_host, line)),
lost AS (SELECT row_no, CAST(sum(all_n) AS BIGINT) AS n FROM hits GROUP BY row_no),
counts AS (
    SELECT row_no, doc_id, CAST(len(words) AS BIGINT) AS n_words,
        CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        coalesce(covered.n, 0) AS n_repeat_words, coalesce(lost.n, 0) AS boilerplate_words
    FROM docs LEFT JOIN covered USING (row_no) LEFT JOIN lost USING (row_no)
),
judged AS MATERIALIZED (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
        NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * (n_words - boilerplate_words) >= 30 * n_words AS passed
    FROM counts
),
gone AS (
    SELECT row_no, host, no_host, line FROM hits
    ANTI JOIN (SELECT host, no_host, line FROM hits SEMI JOIN (SELECT row_no FROM judged WHERE passed) USING (row_no))
        USING (host, no_host, line)
),
alike AS (
    SELECT row_no, doc_id FROM judged
    JOIN (SELECT row_no, count(*) AS n_gone FROM gone GROUP BY row_no) USING (row_no)
    JOIN (SELECT row_no, count(*) AS n_lines FROM lines GROUP BY row_no) USING (row_no)
    WHERE NOT passed AND NOT base_failed AND n_gone * 100 >= n_lines * 75
),
holders AS (
    SELECT DISTINCT arg_min(row_no, doc_id) AS row_no FROM gone JOIN alike USING (row_no) GROUP BY host, no_host, line
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, boilerplate_words,
    passed OR holders.row_no IS NOT NULL AS kept
FROM judged LEFT JOIN holders USING (row_no)
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS words
    FROM documents
),
sets AS (
    SELECT doc_id, list_distinct(CASE WHEN len(words) = 1 THEN words
        ELSE list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) END) AS shingles
    FROM docs
),
members AS MATERIALIZED (SELECT doc_id, unnest(shingles) AS shingle, len(shingles) AS n FROM sets),
links AS MATERIALIZED (
    SELECT a.doc_id AS x, b.doc_id AS y
    FROM members a JOIN members b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
        AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
ways AS MATERIALIZED (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached(doc_id, other) AS (
    SELECT DISTINCT x, x FROM ways
    UNION
    SELECT reached.doc_id, ways.y FROM reached JOIN ways ON ways.x = reached.other
),
least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, CAST(len(shingles) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id,
    doc_id = coalesce(component_id, doc_id) AS kept
FROM sets LEFT JOIN least USING (doc_id)
"""

# crc32 as 256 remainders by byte, folded over the bytes of every distinct key
CRC_TABLE = r"""
remainders AS MATERIALIZED (
    SELECT list(list_reduce(range(8), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)
        ORDER BY i) AS r
    FROM (SELECT unnest(range(256)) AS i)
)
"""


def crc32(key: str) -> str:
    """The crc32 of a text column, where ``remainders`` is joined."""
    code = f"hex(encode({key}))"
    octets = f"list_transform(range(len({code}) // 2), lambda k: CAST('0x' || substr({code}, 2 * k + 1, 2) AS BIGINT))"
    return (
        f"xor(list_reduce({octets}, lambda c, b: xor(c >> 8, r[xor(c & 255, b) + 1]), CAST(4294967295 AS BIGINT)), 4294967295)"
    )


FEATURE_WORDS = r"""regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

RESAMPLE = rf"""
WITH {CRC_TABLE.strip()},
found AS MATERIALIZED (
    SELECT 'd' AS side, doc_id, row_number() OVER () AS row_no, {FEATURE_WORDS} AS words FROM documents
    UNION ALL SELECT 't', NULL, NULL, {FEATURE_WORDS} FROM benchmark
),
counted AS MATERIALIZED (
    SELECT side, row_no, word, count(*) AS n FROM (SELECT side, row_no, unnest(words) AS word FROM found) GROUP BY ALL
),
hashed AS MATERIALIZED (
    SELECT word, {crc32("word")} % 10000 AS bucket FROM (SELECT DISTINCT word FROM counted), remainders
),
buckets AS (
    SELECT bucket, coalesce(sum(n) FILTER (WHERE side = 'd'), 0)::DOUBLE AS s,
        coalesce(sum(n) FILTER (WHERE side = 't'), 0)::DOUBLE AS t
    FROM counted JOIN hashed USING (word) GROUP BY bucket
),
gains AS (
    SELECT bucket, CAST(floor(1000 * ln(((t + 1) * (sum(s) OVER () + 10000)) / ((s + 1) * (sum(t) OVER () + 10000)))) AS BIGINT) AS gain
    FROM buckets
),
weights AS (
    SELECT row_no, CAST(sum(n * gain) AS BIGINT) AS weight
    FROM counted JOIN hashed USING (word) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY row_no
),
scored AS (
    SELECT doc_id, row_no, CAST(len(words) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
    FROM (SELECT *, CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT)::DOUBLE AS h
          FROM found WHERE side = 'd') LEFT JOIN weights USING (row_no)
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, row_no) AS place,
        count(*) FILTER (WHERE n_features >= 20) OVER () AS long
    FROM scored
)
SELECT doc_id, n_features, weight, score,
    CASE WHEN n_features >= 20 AND place <= 10 * long // 100 THEN place END AS rank
FROM ranked
"""

TOP_K = r"""
WITH vectors AS (
    SELECT vec_id, row_number() OVER () AS row_no, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, q.row_no, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM vectors q JOIN vectors c ON q.row_no != c.row_no
    WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY row_no ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank,
    vec_id, score
FROM scored QUALIFY rank <= 5
"""


def _step(state: int, keeps: dict[str, int], wants: int, role: str) -> str:
    """The cheapest way from a grammar state over a turn without inserting: delete it, keep it or re-role it."""
    kept = " ".join(
        f"WHEN initial = '{c}' THEN {{'c': cut + f[{to}].c, 'a': 'K' || f[{to}].a, 'l': list_prepend(role || ':' || text, f[{to}].l)}}"
        for c, to in keeps.items()
    )
    return f"""list_sort(list_filter([
            {{'c': 3 + f[{state}].c, 'a': 'D' || f[{state}].a, 'l': f[{state}].l}},
            CASE WHEN faulty THEN NULL {kept} END,
            CASE WHEN NOT faulty THEN {{'c': 2 + cut + f[{wants}].c, 'a': 'R' || f[{wants}].a,
                'l': list_prepend('{role}:' || text, f[{wants}].l)}} END
        ], lambda o: o IS NOT NULL))[1]"""


def _inserted(own: str, after: str, role: str) -> str:
    return f"""list_sort([{own}, {{'c': 2 + {after}.c, 'a': 'I' || {after}.a, 'l': list_prepend('{role}:', {after}.l)}}])[1]"""


# f lists the grammar states: nothing yet, after system, after user, after assistant
TURN_REPAIR = rf"""
WITH RECURSIVE {CRC_TABLE.strip()},
keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
    FROM conversations
),
kinds AS (SELECT keyed.*, {crc32("key")} % 20 AS kind FROM keyed, remainders),
damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
    FROM kinds, range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)
),
ordered AS (
    SELECT *, left(role, 1) AS initial, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS stripped,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS place
    FROM damaged
),
faults AS (
    SELECT *, stripped = '' AS blank,
        stripped != '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 AS duplicate,
        lag(initial) OVER (PARTITION BY conv_id ORDER BY place) || initial AS pair,
        count(*) OVER (PARTITION BY conv_id) AS of
    FROM ordered
),
turns AS MATERIALIZED (
    SELECT *, blank OR duplicate AS faulty,
        CASE WHEN NOT blank AND NOT duplicate AND NOT suffix(stripped, '.') AND NOT suffix(stripped, '!') AND NOT suffix(stripped, '?')
            THEN 1 ELSE 0 END AS cut
    FROM faults
),
counts AS (
    SELECT conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps,
        count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate, CAST(sum(cut) AS BIGINT) AS truncated,
        count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM turns GROUP BY conv_id
),
repair(conv_id, place, f) AS (
    SELECT conv_id, of + 1, [
        {{'c': 0, 'a': '', 'l': []::VARCHAR[]}}, {{'c': 4, 'a': 'II', 'l': ['user:', 'assistant:']}},
        {{'c': 2, 'a': 'I', 'l': ['assistant:']}}, {{'c': 0, 'a': '', 'l': []::VARCHAR[]}}]
    FROM (SELECT DISTINCT conv_id, of FROM turns)
    UNION ALL
    SELECT conv_id, place, [
        {_inserted("g[1]", "h3", "user")}, {_inserted("g[2]", "h3", "user")}, h3, {_inserted("g[4]", "h3", "user")}]
    FROM (
        SELECT conv_id, place, g, {_inserted("g[3]", "g[4]", "assistant")} AS h3
        FROM (
            SELECT turns.conv_id, turns.place, [
                {_step(1, {"s": 2, "u": 3}, 3, "user")},
                {_step(2, {"u": 3}, 3, "user")},
                {_step(3, {"a": 4}, 4, "assistant")},
                {_step(4, {"u": 3}, 3, "user")}] AS g
            FROM repair JOIN turns
                ON turns.conv_id IS NOT DISTINCT FROM repair.conv_id AND turns.place = repair.place - 1
        )
    )
)
SELECT every.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(f[1].c, 0) AS BIGINT) AS cost,
    coalesce(f[1].a, '') AS audit, sha256(coalesce(array_to_string(f[1].l, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) every
LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM every.conv_id
LEFT JOIN repair ON repair.conv_id IS NOT DISTINCT FROM every.conv_id AND repair.place = 1
"""

QUERIES: dict[str, str] = {
    "op3_chat_format": CHAT_FORMAT,
    "op4_quality_rules": QUALITY_RULES,
    "op5_mix_sources": MIX,
    "op7_url_filter": URL_FILTER,
    "op9_minhash_near_dedup": NEAR_DUPLICATES,
    "op11_bit_sliced_top_k": TOP_K,
    "op12_turn_repair": TURN_REPAIR,
    "op13_target_resample": RESAMPLE,
}
