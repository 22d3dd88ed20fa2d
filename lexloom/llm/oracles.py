"""SQL counterparts of the queries that SQL can express, written from their contracts (DuckDB)."""

from __future__ import annotations

from . import audit, linededup, mixing, quality, secrets

WORDS = r"[^\x20\x09-\x0D]+"


def _either_case(pattern: str) -> str:
    """The pattern with every ASCII letter in either case."""
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in pattern)


def _secrets() -> str:
    """Pieces between matches and matches take turns; sums of their lengths are positions."""
    parts = []
    for place, rule in enumerate(secrets.RULES):
        pattern = rule.pattern
        while "(?i:" in pattern:  # folding in this engine is not limited to ASCII
            start = pattern.index("(?i:")
            depth, end = 1, start + 4
            while depth:
                depth += {"(": 1, ")": -1}.get(pattern[end], 0)
                end += 1
            pattern = pattern[:start] + "(?:" + _either_case(pattern[start + 4 : end - 1]) + ")" + pattern[end:]
        pattern = pattern.replace("'", "''")
        parts.append(
            f"""SELECT doc_id, {place} AS place, '{rule.kind}' AS kind, i,
                list_sum(list_transform(gaps[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[:i - 1], lambda x: length(x))), 0) AS start,
                length(hits[i]) AS size, length(parts[i]) AS part, {rule.least} AS least
            FROM (SELECT doc_id, string_split_regex(text, '{pattern}') AS gaps, regexp_extract_all(text, '{pattern}') AS hits,
                    regexp_extract_all(text, '{pattern}', {rule.group}) AS parts
                FROM documents WHERE regexp_matches(text, '{pattern}')) t, unnest(range(1, len(hits) + 1)) AS u(i)"""
        )
    base = len(secrets.BASE_RULES)
    counts = ", ".join(
        f"count(*) FILTER (place = {place}) AS n_{rule.kind}" for place, rule in enumerate(secrets.BASE_RULES)
    )
    return f"""
    WITH found AS ({" UNION ALL ".join(parts)}),
    spans AS (SELECT doc_id, place, start, kind || ':' || start || ':' || (start + size) AS span FROM found WHERE part >= least)
    SELECT d.doc_id, {counts},
        sha256(coalesce(string_agg(span, ',' ORDER BY start, place) FILTER (place < {base}), '')) AS base_sha256,
        coalesce(string_agg(span, ',' ORDER BY start, place), '') AS spans
    FROM documents d LEFT JOIN spans s USING (doc_id) GROUP BY d.doc_id"""


def _quality() -> str:
    lengths = sorted({*quality.NGRAM_SHARES, quality.BASE_WINDOW})
    covered = " UNION ALL ".join(
        f"""SELECT {n} AS n, doc_id, count(*) AS words, sum(length(w[j])) AS chars FROM (
            SELECT DISTINCT doc_id, unnest(range(i, i + {n})) AS j FROM (
                SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i:i + {n - 1}]) AS times
                FROM words, unnest(range(1, len(w) - {n} + 2)) AS u(i)) t WHERE times > 1) c
        JOIN words USING (doc_id) GROUP BY doc_id"""
        for n in lengths
    )
    shares = " OR ".join(
        f"coalesce(max(c.chars) FILTER (c.n = {n}), 0) > {share} * any_value(m.word_chars)"
        for n, share in quality.NGRAM_SHARES.items()
    )
    return rf"""
    WITH words AS (SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w FROM documents),
    lines AS (SELECT doc_id, line, length(line) AS chars, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) > 1 AS dup
        FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents) t, unnest(range(1, len(l) + 1)) AS u(i), (SELECT l[i] AS line)
        WHERE regexp_matches(line, '{WORDS}')),
    dups AS (SELECT doc_id, count(*) FILTER (dup) AS n_dup_lines, sum(chars) AS chars, coalesce(sum(chars) FILTER (dup), 0) AS dup_chars
        FROM lines GROUP BY doc_id),
    measures AS (SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
        coalesce(chars, 0) AS line_chars, coalesce(dup_chars, 0) AS dup_chars FROM words LEFT JOIN dups USING (doc_id)),
    covered AS ({covered}),
    judged AS (SELECT m.doc_id, any_value(n_words) AS n_words, any_value(word_chars) AS word_chars, any_value(n_symbols) AS n_symbols,
        any_value(n_dup_lines) AS n_dup_lines, coalesce(max(c.words) FILTER (c.n = {quality.BASE_WINDOW}), 0) AS n_repeat_words,
        ({shares}) OR any_value(dup_chars) > {quality.LINE_SHARE} * any_value(line_chars)
            OR any_value(n_symbols) > {quality.SYMBOLS_PER_WORD} * any_value(n_words) AS bad
        FROM measures m LEFT JOIN covered c USING (doc_id) GROUP BY m.doc_id)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
        n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.BASE_PERCENT} * n_words AS base_failed,
        NOT base_failed AND NOT bad AS kept FROM judged"""


def _mix() -> str:
    """Every quotient is listed seat by seat; targets come from pouring over until none is above its limit."""
    block, shards, seed = mixing.BLOCK, mixing.SHARDS, mixing.SEED
    hashed = lambda *parts: f"('0x' || substr(md5(concat_ws('|', '{seed}', {', '.join(parts)})), 1, 15))::BIGINT"
    weights = ", ".join(map(str, mixing.WEIGHTS))
    return rf"""
    WITH RECURSIVE rows AS MATERIALIZED (
        SELECT doc_id, source, text_hash, size, o, o % {shards} AS shard FROM (
            SELECT doc_id, source, md5(text) AS text_hash, len(regexp_extract_all(coalesce(text, ''), '{WORDS}')) AS size,
                {hashed("doc_id", "md5(text)")} AS o FROM documents) t),
    sources AS MATERIALIZED (SELECT source, source_size, rank, [{weights}][(rank % {len(mixing.WEIGHTS)} + 1)::INT]::DOUBLE AS weight,
            2.0 * source_size AS cap FROM (
        SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM rows GROUP BY source) t),
    poured(step, rank, weight, cap, target, total) AS (
        SELECT 0, rank, weight, cap, 0.0::DOUBLE, 1.5 * sum(source_size) OVER () FROM sources
        UNION ALL
        SELECT step + 1, rank, weight, cap, CASE WHEN full_ THEN cap ELSE weight * level END, total FROM (
            SELECT step, rank, weight, cap, total, target >= cap AS full_,
                (total - coalesce(sum(cap) FILTER (target >= cap) OVER (), 0)) / sum(weight) FILTER (target < cap) OVER () AS level
            FROM poured WHERE step < 30) t WHERE level IS NOT NULL),
    targets AS MATERIALIZED (SELECT s.source, s.source_size, s.rank, least(s.cap, p.target) AS target FROM sources s JOIN poured p USING (rank)
        QUALIFY step = max(step) OVER ()),
    seats AS (SELECT rank, quota FROM (SELECT rank, count(*) AS quota FROM (
        SELECT rank, row_number() OVER (ORDER BY target / (2.0 * k + 1.0) DESC, rank) AS place
        FROM targets, unnest(range(0, (target / {block})::BIGINT + 50)) AS u(k) WHERE target > 0) t
        WHERE place <= (SELECT round(sum(target) / {block}) FROM targets) GROUP BY rank) t),
    cells AS (SELECT source, shard, sum(size) AS cell_size FROM rows GROUP BY source, shard),
    claims AS (SELECT t.rank, c.shard, c.cell_size, t.source_size, t.target, s.quota AS seats
        FROM cells c JOIN targets t ON c.source IS NOT DISTINCT FROM t.source LEFT JOIN seats s USING (rank)),
    won AS (SELECT rank, shard, count(*) AS quota FROM (
        SELECT rank, shard, seats, row_number() OVER (PARTITION BY rank ORDER BY cell_size / (2.0 * k + 1.0) DESC, shard) AS place
        FROM claims, unnest(range(0, (2 * cell_size // {block} + 50)::BIGINT)) AS u(k) WHERE cell_size > 0) t
        WHERE place <= seats GROUP BY rank, shard),
    runs AS (SELECT rank, shard, cell_size, source_size, target, n, q // n AS rounds, q % n AS run, {hashed("rank", "shard")} % n AS begin_ FROM (
        SELECT *, greatest(1, ceil(cell_size / {block})::BIGINT) AS n, least(coalesce(quota, 0), 2 * ceil(cell_size / {block})::BIGINT) AS q
        FROM claims LEFT JOIN won USING (rank, shard)) t),
    placed AS (SELECT r.*, t.rank, coalesce(sum(size) OVER (PARTITION BY t.rank, shard ORDER BY o, doc_id, text_hash, size
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
        FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, p.source, source_size::BIGINT AS source_size, target,
        (rounds * size
            + greatest(0, least(start + size, least(cell_size, (begin_ + run) * {block})) - greatest(start, begin_ * {block}))
            + least(greatest(0, greatest(0, begin_ + run - n) * {block} - start), size))::BIGINT AS taken
    FROM placed p JOIN runs USING (rank, shard)"""


_TOPK = """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))),
    scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
    SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) t WHERE rank <= 5"""

_JACCARD = rf"""
    WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORDS}') AS w FROM documents),
    sets AS MATERIALIZED (SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN w ELSE w[i:i + 3] END AS shingle
        FROM words, unnest(range(1, greatest(2, len(w) - 2))) AS u(i) WHERE len(w) > 0),
    sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
    links AS MATERIALIZED (SELECT a, b FROM (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM sets x JOIN sets y USING (shingle) WHERE x.doc_id <> y.doc_id GROUP BY ALL) t
        JOIN sizes s ON s.doc_id = a JOIN sizes r ON r.doc_id = b WHERE 100 * common >= 85 * (s.n + r.n - common)),
    reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, b FROM reach JOIN links ON reach.other = links.a)
    SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id
    FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id"""

_LINES = rf"""
    WITH lines AS MATERIALIZED (SELECT doc_id, i, line, len(regexp_extract_all(line, '{WORDS}')) AS words,
            row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS place
        FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents) t, unnest(range(1, len(l) + 1)) AS u(i), (SELECT l[i] AS line)
        WHERE regexp_matches(line, '{WORDS}')),
    windows AS (SELECT a.doc_id, a.place, n, string_agg(b.line, chr(10) ORDER BY b.place) AS content
        FROM lines a, unnest(range(1, {linededup.MIN_WORDS} + 1)) AS u(n)
        JOIN lines b ON b.doc_id = a.doc_id AND b.place BETWEEN a.place AND a.place + n - 1
        GROUP BY a.doc_id, a.place, n HAVING count(*) = n AND sum(b.words) >= {linededup.MIN_WORDS}),
    later AS (SELECT doc_id, place, n FROM (SELECT *, row_number() OVER (PARTITION BY n, content ORDER BY doc_id, place) AS k FROM windows) t WHERE k > 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(place, place + n)) AS place FROM later),
    ranges AS (SELECT doc_id, string_agg(low || ',' || high, ',' ORDER BY low) AS deleted FROM (
        SELECT doc_id, min(place) AS low, max(place) + 1 AS high FROM (
            SELECT doc_id, place, place - row_number() OVER (PARTITION BY doc_id ORDER BY place) AS run FROM gone) t GROUP BY doc_id, run) t GROUP BY doc_id),
    every AS (SELECT doc_id, i, l[i] AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents) t, unnest(range(1, len(l) + 1)) AS u(i)),
    kept AS (SELECT e.doc_id, string_agg(e.line, chr(10) ORDER BY e.i) AS text FROM every e LEFT JOIN lines l USING (doc_id, i)
        LEFT JOIN gone g ON g.doc_id = e.doc_id AND g.place = l.place WHERE g.place IS NULL GROUP BY e.doc_id),
    counts AS (SELECT l.doc_id, count(*) AS n_lines, count(g.place) AS n_gone FROM lines l LEFT JOIN gone g USING (doc_id, place) GROUP BY l.doc_id)
    SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(deleted, '') AS deleted,
        CASE WHEN d.text IS NULL THEN NULL WHEN n_gone > 0 AND n_gone = n_lines THEN sha256('') ELSE sha256(coalesce(kept.text, '')) END AS kept_sha256
    FROM documents d LEFT JOIN kept USING (doc_id) LEFT JOIN counts USING (doc_id) LEFT JOIN ranges USING (doc_id)"""

_AUDIT = rf"""
    WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS w FROM documents),
    failed AS MATERIALIZED (SELECT doc_id, part, [len(w) < {audit.MIN_WORDS}, 100 * len(list_distinct(w)) < {audit.DISTINCT_PERCENT} * len(w),
            100 * len(regexp_extract_all(t, '[A-Z]')) > {audit.CAPITAL_PERCENT} * length(t), regexp_matches(t, '{audit.SYMBOLS}'),
            coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS f FROM texts),
    marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
    counts AS MATERIALIZED (SELECT part, f, count(*) AS docs, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
        FROM failed LEFT JOIN marks USING (doc_id) GROUP BY part, f),
    letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
    orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letters a, letters b, letters c, letters d, letters e
        WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
    walked AS (SELECT part, filter_order, step, filter_order[step] AS x, docs, good, toxic, f[ascii(filter_order[step]) - 64] AS fails,
            len(list_filter(f, lambda y: y)) AS n_fails,
            list_bool_or(list_transform(range(1, step), lambda k: f[ascii(filter_order[k]) - 64])) AS earlier
        FROM counts, orders, unnest(range(1, 6)) AS u(step)),
    told AS (SELECT part, filter_order, step, x, coalesce(sum(docs) FILTER (NOT fails AND NOT coalesce(earlier, false)), 0) AS kept,
            coalesce(sum(docs) FILTER (fails AND NOT coalesce(earlier, false)), 0) AS removed, coalesce(sum(docs) FILTER (fails AND earlier), 0) AS redundant,
            coalesce(sum(docs) FILTER (fails AND n_fails = 1), 0) AS unique_fails, coalesce(sum(good) FILTER (fails AND NOT coalesce(earlier, false)), 0) AS good_lost,
            coalesce(sum(toxic) FILTER (fails AND NOT coalesce(earlier, false)), 0) AS toxic_lost FROM walked GROUP BY part, filter_order, step, x)
    SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
        unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
        (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley FROM told"""

ORACLES = {
    "op1_secrets": _secrets(),
    "op2_quality": _quality(),
    "op3_mix": _mix(),
    "op4_topk": _TOPK,
    "op6_jaccard": _JACCARD,
    "op8_lines": _LINES,
    "op12_audit": _AUDIT,
}
