"""The registered queries as plain SQL over the same tables."""

from __future__ import annotations

from ..functions.hangul import LEADS, TAILS, VOWELS
from ..functions.text import CJK_BLOCKS, ENTITIES, HIDDEN_LINKS
from .catalog import DIM, LATIN, SYLLABLES

# White space as one class: the SQL engine's \s knows ASCII only.
WS = (
    r"[\t\n\x{0B}\f\r \x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)
NL = "chr(10)"
ORACLES: dict[str, str] = {}


def strip(x: str) -> str:
    return f"regexp_replace(replace({x}, {NL}, ''), '^{WS}+|{WS}+$', '', 'g')"


def collapse(x: str) -> str:
    return f"regexp_replace({x}, '{WS}+', ' ', 'g')"


def words_of(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WS}+'), lambda w: w <> '')"


def digits_apart(x: str) -> str:
    return rf"regexp_replace({x}, '(\p{{Nd}})', ' \1 ', 'g')"


def hash32(*parts: str) -> str:
    return f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8) AS BIGINT)"


def exploded(source: str, keys: str, array: str, out: str, pos: str) -> str:
    """Rows of an array with positions from 0."""
    return (
        f"SELECT {keys}, unnest(_a) AS {out}, CAST(generate_subscripts(_a, 1) - 1 AS BIGINT) AS {pos} "
        f"FROM (SELECT {keys}, {array} AS _a FROM {source})"
    )


def number_text(x: str, digits: int = 5) -> str:
    return f"CAST(CAST(round({x}, {digits}) AS DECIMAL(18,{digits})) AS VARCHAR)"


# Shared parts: each may use the ones it names.
PARTS = {
    "lines": exploded("documents", "doc_id", f"string_split(text, {NL})", "line", "line_no"),
    "line_tokens": f"SELECT doc_id, line_no, {words_of(digits_apart(strip('line')))} AS tokens FROM lines",
    "tok": exploded("line_tokens", "doc_id, line_no", "tokens", "word", "pos"),
    "counts": "SELECT word, count(*) AS cnt FROM tok GROUP BY word",
    "doc_tokens": f"SELECT doc_id, source, {words_of('text')} AS tokens FROM documents",
    "doc_tok": exploded("doc_tokens", "doc_id, source", "tokens", "word", "pos"),
    "doc_counts": "SELECT word, count(*) AS cnt FROM doc_tok GROUP BY word",
    "vocab": "SELECT CAST(row_number() OVER (ORDER BY cnt DESC, word) - 1 AS BIGINT) AS id, word, cnt FROM counts WHERE cnt >= 5",
    "prefixes": (
        "SELECT substr(word, 1, n) AS word, CAST(sum(cnt) AS BIGINT) AS freq FROM "
        "(SELECT word, cnt, unnest(range(1, least(length(word), 11) + 1)) AS n FROM counts) GROUP BY 1"
    ),
    "cohesion": (
        "SELECT p.word, p.freq, CASE WHEN length(p.word) = 1 THEN 0.0 ELSE "
        "pow(p.freq / CAST(f.freq AS DOUBLE), 1.0 / (length(p.word) - 1)) END AS cohesion_forward "
        "FROM prefixes p JOIN prefixes f ON f.word = substr(p.word, 1, 1)"
    ),
    "entropy": (
        "SELECT left(word, length(word) - 1) AS word, greatest(0.0, ln(sum(freq)) - sum(freq * ln(freq)) / sum(freq)) "
        "AS right_branching_entropy FROM prefixes WHERE length(word) > 1 GROUP BY 1"
    ),
    "scores": (
        "SELECT c.word, c.freq, cohesion_forward, coalesce(right_branching_entropy, 0.0) AS right_branching_entropy, "
        "cohesion_forward * exp(coalesce(right_branching_entropy, 0.0)) AS score FROM cohesion c LEFT JOIN entropy e ON e.word = c.word "
        "WHERE c.freq >= 100 AND length(c.word) <= 10 AND cohesion_forward >= 0.05"
    ),
    "lexicon": (
        "SELECT word, CASE WHEN length(word) <= 2 THEN 'J' ELSE 'N' END AS tag FROM doc_counts WHERE cnt >= 20 AND length(word) <= 6"
    ),
    "heads": (
        "SELECT t.word AS token, max(l.word ORDER BY l.word) AS any_word, arg_max(l.word, length(l.word)) AS head, "
        "arg_max(l.tag, length(l.word)) AS tag FROM (SELECT word, unnest(range(1, length(word) + 1)) AS n FROM counts) t "
        "JOIN lexicon l ON l.word = substr(t.word, 1, n) GROUP BY 1"
    ),
    "tagged": (
        "SELECT doc_id, line_no, pos, CASE WHEN head IS NULL THEN [struct_pack(m := t.word, t := 'UNK')] "
        "WHEN head = t.word THEN [struct_pack(m := head, t := h.tag)] "
        "ELSE [struct_pack(m := head, t := h.tag), struct_pack(m := substr(t.word, length(head) + 1), t := coalesce(r.tag, 'UNK'))] END AS parts "
        "FROM tok t LEFT JOIN heads h ON h.token = t.word LEFT JOIN lexicon r ON r.word = substr(t.word, length(head) + 1)"
    ),
    "sentences": (
        "SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS BIGINT) AS sent_no, sentence FROM ("
        f"SELECT doc_id, k, {strip('s')} AS sentence FROM ("
        + exploded("documents", "doc_id", rf"string_split(regexp_replace(text, '([.!?]){WS}+', '\1' || {NL}, 'g'), {NL})", "s", "k")
        + ")) WHERE sentence <> ''"
    ),
    "sized": f"SELECT doc_id, sent_no, {words_of('sentence')} AS tokens FROM sentences",
    "placed": (
        "SELECT doc_id, sent_no, tokens, len(tokens) AS n_tokens, CAST(coalesce(sum(len(tokens)) OVER "
        "(PARTITION BY doc_id ORDER BY sent_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before FROM sized"
    ),
    "framed_tok": exploded("placed", "doc_id, sent_no, before", "tokens", "token", "k"),
    "segmented": "SELECT doc_id, sent_no, (before + k) // 125 AS seg, count(*) AS n_tokens FROM framed_tok GROUP BY ALL",
    "packed": "SELECT doc_id, (before + k) // 125 AS seg, list(token ORDER BY sent_no, k) AS tokens FROM framed_tok GROUP BY doc_id, (before + k) // 125",
    "train": f"SELECT * FROM embeddings WHERE {hash32('7', 'vec_id')} % 1000 >= 200",
    "test": f"SELECT * FROM embeddings WHERE {hash32('7', 'vec_id')} % 1000 < 200",
    "sims": (
        "SELECT t.vec_id, r.vec_id AS nearest, t.label AS label, r.label AS predicted, "
        "round(list_cosine_similarity(CAST(t.embedding AS DOUBLE[]), CAST(r.embedding AS DOUBLE[])), 12) AS cosine FROM test t, train r"
    ),
    "nearest": "SELECT * FROM sims QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY cosine DESC, nearest) = 1",
    "word_vecs": (
        "SELECT word, [" + ", ".join(f"{hash32('7', 'word', str(i))} / 4294967296.0 - 0.5" for i in range(DIM))
        + "] AS vec FROM doc_counts WHERE cnt >= 5"
    ),
}

NEEDS = {
    "line_tokens": ["lines"], "tok": ["line_tokens"], "counts": ["tok"], "doc_tok": ["doc_tokens"], "doc_counts": ["doc_tok"],
    "vocab": ["counts"], "prefixes": ["counts"], "cohesion": ["prefixes"], "entropy": ["prefixes"], "scores": ["cohesion", "entropy"],
    "lexicon": ["doc_counts"], "heads": ["counts", "lexicon"], "tagged": ["tok", "heads", "lexicon"],
    "sized": ["sentences"], "placed": ["sized"], "framed_tok": ["placed"], "segmented": ["framed_tok"], "packed": ["framed_tok"],
    "sims": ["train", "test"], "nearest": ["sims"], "word_vecs": ["doc_counts"],
}


def sql(uses: str, final: str, recursive: bool = False, **own: str) -> str:
    """A statement from shared parts (and their needs), own parts, and the final SELECT."""
    order: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in order:
            order.append(name)

    for name in uses.split():
        add(name)
    parts = [f"{n} AS MATERIALIZED ({PARTS[n]})" for n in order] + [f"{n} AS ({q})" for n, q in own.items()]
    head = ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n" if parts else ""
    return head + final


# ---------------------------------------------------------------- sources and sinks

ORACLES["s01_lines"] = sql("lines", "SELECT doc_id, line_no, line FROM lines")
ORACLES["s02_labelled_lines"] = sql(
    "lines",
    f"""SELECT l.doc_id, line_no,
      CASE WHEN line_no % 5 = 4 THEN line ELSE regexp_replace(line, '^{WS}+', '') END AS line,
      CASE WHEN line_no % 5 = 4 THEN NULL ELSE CAST(quality AS VARCHAR) END AS label,
      CASE WHEN line_no % 5 = 4 THEN 'corrupt' ELSE 'ok' END AS status
    FROM lines l JOIN labels b ON b.doc_id = l.doc_id""",
)


def plain(x: str) -> str:
    """What follows on wiki marks: quotes, tags, entities, spacing."""
    out = rf"regexp_replace({x}, '''{{2,}}|={{2,}}', '', 'g')"
    out = f"regexp_replace({out}, '<[^>]*>', ' ', 'g')"
    for entity, sign in ENTITIES:
        quoted = sign.replace("'", "''")
        out = f"replace({out}, '{entity}', '{quoted}')"
    return f"trim({collapse(out)})"


def markup(x: str) -> str:
    """The supplied pages hold no wiki marks."""
    return plain(rf"regexp_replace({x}, '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', ' ', 'g')")


# Character by character: the open marks and the text since each of them as two lists.
NESTED = rf"""WITH RECURSIVE given AS (SELECT page_id, url, CAST(page_id % 20 + 1 AS INT) AS n,
    regexp_replace(substr(html, 1, 200), '[\[\]{{}}|<>&=''\n]', ' ', 'g') AS s FROM pages),
  written AS (SELECT page_id, repeat('{{{{a|', n) || s || repeat('}}}}', n) || ' b ' || repeat('[[c|', n) || url || repeat(']]', n) || repeat('{{|', n) || s
    || repeat('|}}', n) || '[[File:x|[[y|' || url || ']]]] {{{{open ' || s || chr(1) || chr(2) || 'z' || chr(3) || chr(4) || ' ]]' AS t FROM given),
  walk AS (SELECT page_id, t, 1 AS k, [''] AS marks, [''] AS texts FROM written
    UNION ALL SELECT page_id, t, k + size,
      CASE WHEN opens THEN list_append(marks, two) WHEN closes THEN marks[:-2] ELSE marks END,
      CASE WHEN opens THEN list_append(texts, '')
        WHEN closes THEN list_append(texts[:-3], texts[-2] || CASE WHEN marks[-1] <> '[[' THEN ' '
          WHEN regexp_matches(texts[-1], '^({"|".join(HIDDEN_LINKS)}):') THEN '' ELSE list_extract(string_split(texts[-1], '|'), -1) END)
        ELSE list_append(texts[:-2], texts[-1] || substr(t, k, size)) END
    FROM (SELECT *, two IN ('{{{{', '{{|', '[[') AS opens,
        (marks[-1], two) IN (('{{{{', '}}}}'), ('{{|', '|}}'), ('[[', ']]')) AND NOT (two = '|}}' AND substr(t, k + 2, 1) = '}}') AS closes,
        CASE WHEN two IN ('{{{{', '{{|', '[[', '}}}}', ']]') OR (two = '|}}' AND substr(t, k + 2, 1) <> '}}') THEN 2 ELSE 1 END AS size
      FROM (SELECT *, substr(t, k, 2) AS two FROM walk WHERE k <= length(t))))
  SELECT page_id, {plain("replace(replace(whole, chr(1) || chr(2), '[['), chr(3) || chr(4), ']]')")} AS text FROM (
    SELECT page_id, array_to_string(list_transform(range(1, len(marks) + 1), lambda i: marks[i] || texts[i]), '') AS whole FROM walk WHERE k > length(t))"""
ORACLES["r09_nested_markup"] = NESTED
ORACLES["s03_wiki_xml"] = f"SELECT url AS title, {markup('html')} AS text FROM pages"
ORACLES["s04_ratings"] = (
    f"SELECT CAST(d.doc_id AS VARCHAR) AS id, {strip(collapse('text'))} AS line, CAST(quality AS VARCHAR) AS label "
    "FROM documents d JOIN labels b ON b.doc_id = d.doc_id"
)
ORACLES["s05_qa_json"] = (
    f"SELECT CAST(conv_id AS VARCHAR) AS title, {strip(collapse('text'))} AS line FROM conversations "
    "UNION ALL SELECT CAST(conv_id AS VARCHAR), 'who says ' || turn FROM conversations "
    "UNION ALL SELECT CAST(conv_id AS VARCHAR), role FROM conversations"
)
ORACLES["s06_review_json"] = f"SELECT {strip(collapse('text'))} || '␞' || source AS line FROM documents"
ORACLES["s07_pairs_csv"] = (
    "SELECT text AS question1, role || ' ' || text AS question2, CAST(turn % 2 AS VARCHAR) AS is_duplicate FROM conversations"
)
vec_text = "list_aggregate(list_transform(vec, lambda v: " + number_text("round(v, 4)") + "), 'string_agg', ' ')"
ORACLES["s08_read_vectors"] = sql("word_vecs", f"SELECT word, {vec_text} AS vec FROM word_vecs")
ORACLES["s09_write_lines"] = sql(
    "line_tokens", "SELECT array_to_string(tokens, ' ') AS line, count(*) AS cnt FROM line_tokens GROUP BY 1"
)
ORACLES["s10_labelled_strings"] = sql(
    "lines", "SELECT l.doc_id, line_no, line || '␞' || quality AS line FROM lines l JOIN labels b ON b.doc_id = l.doc_id"
)
ORACLES["s11_write_vocab"] = sql("vocab", "SELECT id, word AS token FROM vocab")
ORACLES["s12_model_table"] = sql("counts", "SELECT word, cnt FROM counts")
ORACLES["s13_shards"] = sql(
    "lines",
    "SELECT doc_id, line_no, o AS ordinal, o // 1000 AS shard FROM "
    "(SELECT doc_id, line_no, CAST(row_number() OVER (ORDER BY doc_id, line_no) - 1 AS BIGINT) AS o FROM lines)",
)

# ---------------------------------------------------------------- rows

ORACLES["r01_strip"] = sql(
    "lines", f"SELECT doc_id, line_no, {strip('chr(9) || line || chr(32) || chr(12288)')} AS line FROM lines"
)
ORACLES["r02_drop_blank"] = sql(
    "lines", f"SELECT * FROM (SELECT doc_id, line_no, {strip("regexp_replace(line, '[n-zA-Z., ]', '', 'g')")} AS line FROM lines) WHERE line <> ''"
)
ORACLES["r03_with_label"] = sql(
    "lines",
    f"SELECT l.doc_id, line_no, {collapse(strip('line'))} AS line, CAST(quality AS VARCHAR) AS label "
    "FROM lines l JOIN labels b ON b.doc_id = l.doc_id",
)
ORACLES["r04_collapse_spaces"] = f"SELECT doc_id, {collapse('text')} AS text FROM documents"
# Run-length form: number the runs of equal characters, keep three of each run of word characters.
ORACLES["r05_limit_repeats"] = sql(
    "lines",
    f"""SELECT l.doc_id, l.line_no, {strip(collapse("coalesce(k.line, '')"))} AS line FROM lines l LEFT JOIN kept k
      ON k.doc_id = l.doc_id AND k.line_no = l.line_no""",
    chars=exploded("lines", "doc_id, line_no", "string_split(line, '')", "c", "pos"),
    marked="SELECT *, CASE WHEN lag(c) OVER w = c THEN 0 ELSE 1 END AS fresh FROM chars WINDOW w AS (PARTITION BY doc_id, line_no ORDER BY pos)",
    runs="SELECT *, sum(fresh) OVER (PARTITION BY doc_id, line_no ORDER BY pos) AS run FROM marked",
    ranked="SELECT *, row_number() OVER (PARTITION BY doc_id, line_no, run ORDER BY pos) AS k FROM runs",
    kept=r"""SELECT doc_id, line_no, string_agg(c, '' ORDER BY pos) AS line FROM ranked
      WHERE k <= 3 OR NOT regexp_matches(c, '^[\p{L}\p{M}\p{Nd}\p{Pc}]$') GROUP BY doc_id, line_no""",
)
ORACLES["r06_split_digits"] = sql(
    "lines", f"SELECT doc_id, line_no, array_to_string({words_of(digits_apart('line'))}, ' ') AS line FROM lines"
)


def letters(c: str) -> str:
    code = f"(unicode({c}) - 44032)"
    return (
        f"CASE WHEN {c} BETWEEN '가' AND '힣' THEN substr('{LEADS}', {code} // 588 + 1, 1) || "
        f"substr('{VOWELS}', {code} % 588 // 28 + 1, 1) || substr('{TAILS}', {code} % 28 + 1, 1) "
        f"WHEN {c} BETWEEN 'ㄱ' AND 'ㅎ' THEN {c} || '--' WHEN {c} BETWEEN 'ㅏ' AND 'ㅣ' THEN '-' || {c} || '-' ELSE {c} END"
    )


HANGUL_LINE = f"translate(lower(line), '{LATIN}', '{SYLLABLES}')"


def jamo(x: str) -> str:
    spelled = f"list_transform(string_split({x}, ''), lambda c: {letters('c')})"
    return collapse(f"array_to_string({spelled}, '')")


ORACLES["r07_to_jamo"] = sql("lines", f"SELECT doc_id, line_no, {jamo(HANGUL_LINE)} AS line FROM lines")


def cleaned(x: str) -> str:
    out = rf"regexp_replace({x}, '[\t\n\r\p{{Zs}}]', ' ', 'g')"
    out = rf"regexp_replace({out}, '[\p{{Cc}}\p{{Cf}}\x{{FFFD}}]', '', 'g')"
    out = rf"regexp_replace({out}, '([{CJK_BLOCKS}])', ' \1 ', 'g')"
    return f"trim(regexp_replace({out}, ' +', ' ', 'g'))"


ORACLES["r08_clean_text"] = f"SELECT doc_id, {cleaned('text')} AS text FROM documents"
ORACLES["r09_strip_markup"] = f"SELECT page_id, {markup('html')} AS text FROM pages"
PERIODS = {
    "every": f"SELECT lower(regexp_replace(regexp_replace(unnest({words_of('text')}), '^[(\"'']+', ''), '[)\"'',;:!?]+$', '')) AS token FROM documents",
    "bare": "SELECT CASE WHEN ends_with(token, '.') THEN left(token, length(token) - 1) ELSE token END AS word, ends_with(token, '.') AS period FROM every",
    "periods": r"""SELECT word, count(*) FILTER (period) AS n_period, count(*) FILTER (NOT period) AS n_plain FROM bare
      WHERE regexp_matches(word, '\p{L}') AND NOT regexp_matches(word, '[\p{Nd}]|\.$') GROUP BY word""",
    "measured": """SELECT *, length(word) - length(replace(word, '.', '')) AS inner_, CAST(n_period AS DOUBLE) AS k, CAST(n_period + n_plain AS DOUBLE) AS n,
      sum(n_period) OVER () / CAST(sum(n_period + n_plain) OVER () AS DOUBLE) AS p FROM periods""",
    "scored": """SELECT word, n_period, n_plain, -2 * (k * ln(p) + (n - k) * ln(1 - p) - k * ln(0.99) - (n - k) * ln(1 - 0.99)) * exp(inner_ - length(word))
      * (inner_ + 1) * pow(CAST(length(word) - inner_ AS DOUBLE), -CAST(n_plain AS DOUBLE)) AS score FROM measured WHERE n_period > 0""",
    "abbreviated": "SELECT * FROM scored WHERE score >= 0.3",
}
ORACLES["r10_abbreviations"] = sql("", "SELECT word, n_period, n_plain, round(score, 4) AS score FROM abbreviated", **PERIODS)
ORACLES["r10_learned_sentences"] = sql(
    "lines",
    f"""SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY line_no, sentence_no) - 1 AS BIGINT) AS sent_no, sentence FROM (
      SELECT doc_id, line_no, s AS sentence_no, {strip("string_agg(part, ' ' ORDER BY k)")} AS sentence FROM numbered GROUP BY doc_id, line_no, s)
      WHERE sentence <> ''""",
    **PERIODS,
    cut_=exploded("lines", "doc_id, line_no", rf"string_split(regexp_replace(line, '([.!?]){WS}+', '\1' || chr(2), 'g'), chr(2))", "part", "k"),
    ended=rf"""SELECT *, nullif(regexp_extract(part, '(^|[\s("''])([^\s("'']+)\.$', 2), '') AS last FROM cut_""",
    told=r"""SELECT e.*, coalesce(regexp_matches(last, '^\p{Lu}$'), false) OR a.word IS NOT NULL AS on_ FROM ended e
      LEFT JOIN abbreviated a ON a.word = lower(regexp_replace(regexp_replace(last, '^[("'']+', ''), '[)"'',;:!?]+$', ''))""",
    numbered="SELECT *, coalesce(sum(CASE WHEN on_ THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, line_no ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM told",
)
ORACLES["r10_sentences"] = sql("sentences", "SELECT doc_id, sent_no, sentence FROM sentences")


def spelled(parts: str) -> str:
    """Tagged parts of a line in order, digits apart."""
    return f"array_to_string({words_of(digits_apart(f'array_to_string({parts}, chr(32))'))}, ' ')"


ORACLES["r11_format_pos"] = sql(
    "tagged lines",
    f"""SELECT l.doc_id, l.line_no, coalesce({spelled("list_transform(p, lambda x: x.m || '/' || x.t)")}, '') AS tagged,
      coalesce({spelled("list_transform(p, lambda x: split_part(x.m || '/' || x.t, '/', 1))")}, '') AS plain
    FROM lines l LEFT JOIN grouped g ON g.doc_id = l.doc_id AND g.line_no = l.line_no""",
    grouped="SELECT doc_id, line_no, flatten(list(parts ORDER BY pos)) AS p FROM tagged GROUP BY doc_id, line_no",
)

# ---------------------------------------------------------------- tokenizers

ORACLES["t01_tokenize"] = sql(
    "line_tokens", "SELECT doc_id, line_no, array_to_string(tokens, ' ') AS tokens, CAST(len(tokens) AS BIGINT) AS n FROM line_tokens"
)
ORACLES["t02_lexicon_tokens"] = sql(
    "tagged lines",
    """SELECT l.doc_id, l.line_no, coalesce(array_to_string(list_transform(p, lambda x: x.m || '/' || x.t), ' '), '') AS tagged
    FROM lines l LEFT JOIN grouped g ON g.doc_id = l.doc_id AND g.line_no = l.line_no""",
    grouped="SELECT doc_id, line_no, flatten(list(parts ORDER BY pos)) AS p FROM tagged GROUP BY doc_id, line_no",
)
ORACLES["t03_merge_lexicon"] = sql(
    "counts", "SELECT word, 'NNP' AS tag FROM counts WHERE cnt >= 50 UNION ALL SELECT word, 'NNG' FROM counts WHERE cnt >= 10 AND cnt < 50"
)
ORACLES["t04_l_tokens"] = sql(
    "lines scores",
    """SELECT l.doc_id, l.line_no, coalesce(g.tokens, '') AS tokens FROM lines l LEFT JOIN
      (SELECT doc_id, line_no, string_agg(CASE WHEN cut IS NULL OR cut >= length(word) THEN word
         ELSE substr(word, 1, cut) || ' ' || substr(word, cut + 1) END, ' ' ORDER BY pos) AS tokens
       FROM spaced s LEFT JOIN best b ON b.token = s.word GROUP BY doc_id, line_no) g
    ON g.doc_id = l.doc_id AND g.line_no = l.line_no""",
    spaced=exploded("lines", "doc_id, line_no", words_of("line"), "word", "pos"),
    starts="SELECT DISTINCT word, unnest(range(2, least(length(word), 10) + 1)) AS n FROM spaced WHERE length(word) > 2",
    best="""SELECT t.word AS token, arg_max(n, struct_pack(a := s.score, b := n)) AS cut FROM starts t
      JOIN scores s ON s.word = substr(t.word, 1, n) WHERE s.score > 0 GROUP BY 1""",
)
ORACLES["t05_wordpiece"] = sql(
    "lines",
    """SELECT l.doc_id, l.line_no, coalesce(g.tokens, '') AS tokens FROM lines l LEFT JOIN
      (SELECT doc_id, line_no, string_agg(pieces, ' ' ORDER BY pos) AS tokens FROM spaced s JOIN cutup c ON c.word = s.word
       GROUP BY doc_id, line_no) g ON g.doc_id = l.doc_id AND g.line_no = l.line_no""",
    recursive=True,
    spaced=exploded(
        "lines", "doc_id, line_no",
        "list_filter(regexp_split_to_array(regexp_replace(" + cleaned(strip("line")) + r", '([\p{P}$+<=>^`|~])', ' \1 ', 'g'), ' +'), lambda w: w <> '')",
        "word", "pos",
    ),
    types="SELECT word, count(*) AS cnt FROM spaced GROUP BY word",
    sizes="SELECT word, cnt, unnest(range(1, least(length(word), 6) + 1)) AS n FROM types",
    pieces="""SELECT token FROM (SELECT substr(word, 1, n) AS token, cnt FROM sizes
      UNION ALL SELECT '##' || substr(word, length(word) - n + 1), cnt FROM sizes) GROUP BY token HAVING sum(cnt) >= 20""",
    spots="SELECT word, unnest(range(1, length(word) + 1)) AS spot FROM types WHERE length(word) <= 200",
    ends="SELECT word, spot, unnest(range(1, least(8, length(word) - spot + 1) + 1)) AS n FROM spots",
    steps="""SELECT e.word, spot, max(n) AS n FROM ends e JOIN pieces p
      ON p.token = CASE WHEN spot = 1 THEN '' ELSE '##' END || substr(e.word, spot, n) GROUP BY e.word, spot""",
    walk="""SELECT word, 1 AS spot, '' AS made FROM types
      UNION ALL SELECT w.word, w.spot + s.n, trim(w.made || ' ' || CASE WHEN w.spot = 1 THEN '' ELSE '##' END || substr(w.word, w.spot, s.n))
      FROM walk w JOIN steps s ON s.word = w.word AND s.spot = w.spot""",
    cutup="""SELECT t.word, coalesce(max(made), '[UNK]') AS pieces FROM types t
      LEFT JOIN walk w ON w.word = t.word AND w.spot = length(t.word) + 1 GROUP BY t.word""",
)
# Unigram pieces: marked words, the table of short pieces, and the pieces inside every word.
MARKED = {
    "spaced": exploded("lines", "doc_id, line_no", words_of("line"), "word", "pos"),
    "marked": "SELECT '▁' || word AS word, count(*) AS cnt FROM spaced GROUP BY 1",
}
SHORT = {
    "spots": "SELECT word, cnt, unnest(range(1, length(word) + 1)) AS spot FROM marked",
    "subs": "SELECT word, cnt, spot, unnest(range(1, least(4, length(word) - spot + 1) + 1)) AS n FROM spots",
    "parts": "SELECT substr(word, spot, n) AS piece, CAST(sum(cnt) AS BIGINT) AS n FROM subs GROUP BY 1 HAVING sum(cnt) >= 50",
    "scored": "SELECT piece, round(ln(n / CAST((SELECT sum(n) FROM parts) AS DOUBLE)), 6) AS score FROM parts",
    "edges": """SELECT s.word, s.cnt, spot - 1 AS a, spot - 1 + n AS b, coalesce(score, (SELECT min(score) - 10 FROM scored)) AS score, p.piece
      FROM subs s LEFT JOIN scored p ON p.piece = substr(s.word, spot, n) WHERE p.piece IS NOT NULL OR n = 1""",
}
ORACLES["t06_short_pieces"] = sql(
    "lines",
    """SELECT l.doc_id, l.line_no, coalesce(g.tokens, '') AS tokens FROM lines l LEFT JOIN
      (SELECT doc_id, line_no, string_agg(made, ' ' ORDER BY pos) AS tokens FROM spaced s JOIN cutup c ON c.word = '▁' || s.word
       GROUP BY doc_id, line_no) g ON g.doc_id = l.doc_id AND g.line_no = l.line_no""",
    recursive=True,
    **MARKED,
    **SHORT,
    into_="SELECT word, b, list(struct_pack(a := a, score := score) ORDER BY a) AS es FROM edges GROUP BY word, b",
    walk="""SELECT word, CAST(0 AS BIGINT) AS upto, [CAST(0 AS DOUBLE)] AS best, [''] AS path FROM marked
      UNION ALL SELECT word, upto + 1, list_append(best, vals[k]),
        list_append(path, CASE WHEN es[k].a = 0 THEN '' ELSE path[es[k].a + 1] || ' ' END || substr(word, es[k].a + 1, upto + 1 - es[k].a))
      FROM (SELECT *, list_position(vals, list_max(vals)) AS k FROM (
        SELECT w.word, w.upto, w.best, w.path, i.es, list_transform(i.es, lambda e: w.best[e.a + 1] + e.score) AS vals
        FROM walk w JOIN into_ i ON i.word = w.word AND i.b = w.upto + 1))""",
    cutup="SELECT word, path[length(word) + 1] AS made FROM walk WHERE upto = length(word)",
)
ORACLES["a05_seeds"] = sql(
    "lines",
    """SELECT piece, CAST(sum(cnt) AS BIGINT) AS n FROM (SELECT substr(word, spot, n) AS piece, cnt,
        CASE WHEN spot > 1 THEN substr(word, spot - 1, 1) END AS l, CASE WHEN spot + n <= length(word) THEN substr(word, spot + n, 1) END AS r FROM every)
      GROUP BY piece HAVING sum(cnt) > 1 AND (bool_or(l IS NULL) OR min(l) < max(l)) AND (bool_or(r IS NULL) OR min(r) < max(r))""",
    **MARKED,
    spots=SHORT["spots"],
    every="SELECT word, cnt, spot, unnest(range(2, length(word) - spot + 2)) AS n FROM spots",
)


def log_sums(state: str, place: str) -> str:
    """One more entry of a list of logarithms: the sum over the pieces that lead there."""
    return f"""SELECT word, upto + 1, list_append(known, list_max(vals) + ln(list_sum(list_transform(vals, lambda v: exp(v - list_max(vals))))))
      FROM (SELECT w.word, w.upto, w.known, list_transform(i.es, lambda e: w.known[e.a + 1] + e.score) AS vals
        FROM {state} w JOIN {place} i ON i.word = w.word AND i.b = w.upto + 1)"""


ORACLES["a05_expected_counts"] = sql(
    "lines",
    """SELECT piece, round(sum(round(exp(f.known[a + 1] + score + g.known[length(e.word) - b + 1] - f.known[length(e.word) + 1]) * 1000000) * cnt) / 1000000, 2) AS n
    FROM edges e JOIN whole f ON f.word = e.word JOIN whole_back g ON g.word = e.word WHERE piece IS NOT NULL GROUP BY piece""",
    recursive=True,
    **MARKED,
    **SHORT,
    into_="SELECT word, b, list(struct_pack(a := a, score := score) ORDER BY a) AS es FROM edges GROUP BY word, b",
    out_of="SELECT word, length(word) - a AS b, list(struct_pack(a := length(word) - b, score := score) ORDER BY a) AS es FROM edges GROUP BY word, length(word) - a",
    ahead=f"SELECT word, CAST(0 AS BIGINT) AS upto, [CAST(0 AS DOUBLE)] AS known FROM marked UNION ALL {log_sums('ahead', 'into_')}",
    behind=f"SELECT word, CAST(0 AS BIGINT) AS upto, [CAST(0 AS DOUBLE)] AS known FROM marked UNION ALL {log_sums('behind', 'out_of')}",
    whole="SELECT word, known FROM ahead WHERE upto = length(word)",
    whole_back="SELECT word, known FROM behind WHERE upto = length(word)",
)
ORACLES["t07_encode_ids"] = sql(
    "line_tokens tok vocab",
    """SELECT l.doc_id, l.line_no, coalesce(g.ids, '') AS ids FROM line_tokens l LEFT JOIN
      (SELECT doc_id, line_no, string_agg(CAST(coalesce(v.id + 1, 0) AS VARCHAR), ' ' ORDER BY pos) AS ids
       FROM tok t LEFT JOIN vocab v ON v.word = t.word GROUP BY doc_id, line_no) g
    ON g.doc_id = l.doc_id AND g.line_no = l.line_no""",
)

# ---------------------------------------------------------------- statistics

ORACLES["a01_vocab_count"] = sql("counts", "SELECT word, cnt FROM counts WHERE cnt >= 5")
ORACLES["a02_lm_vocab"] = sql(
    "counts",
    """SELECT * FROM (VALUES (CAST(0 AS BIGINT), '<S>'), (1, '</S>'), (2, '<UNK>')) v(id, token)
    UNION ALL SELECT CAST(row_number() OVER (ORDER BY cnt DESC, word) + 2 AS BIGINT), word FROM counts""",
)
ORACLES["a03_char_coverage"] = sql(
    "lines",
    """SELECT ch, cnt FROM (SELECT ch, cnt, coalesce(sum(cnt) OVER (ORDER BY cnt DESC, ch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
      sum(cnt) OVER () AS total FROM chars) WHERE before < total * 0.9995""",
    chars="SELECT ch, count(*) AS cnt FROM (SELECT unnest(string_split(line, '')) AS ch FROM lines) WHERE ch NOT IN ('', ' ') GROUP BY ch",
)
ORACLES["a06_bert_vocab"] = sql(
    "counts",
    """SELECT CAST(i AS BIGINT) AS id, t AS token FROM (VALUES (0, '[PAD]'), (1, '[UNK]'), (2, '[CLS]'), (3, '[SEP]'), (4, '[MASK]')) v(i, t)
    UNION ALL SELECT CAST(row_number() OVER (ORDER BY cnt DESC, piece) + 4 AS BIGINT),
      CASE WHEN starts_with(piece, '▁') THEN replace(piece, '▁', '') ELSE '##' || piece END
    FROM (SELECT CASE WHEN cnt % 2 = 0 THEN '▁' || word ELSE word END AS piece, cnt FROM counts WHERE cnt >= 10)
    WHERE piece NOT IN ('', '▁', '<unk>', '<s>', '</s>')""",
)
ORACLES["a07_prefix_counts"] = sql("prefixes", "SELECT word, freq FROM prefixes")
ORACLES["a08_cohesion"] = sql("cohesion", "SELECT word, freq, round(cohesion_forward, 6) AS cohesion_forward FROM cohesion")
ORACLES["a09_entropy"] = sql("entropy", "SELECT word, round(right_branching_entropy, 6) AS right_branching_entropy FROM entropy")
ORACLES["a10_word_scores"] = sql(
    "scores",
    """SELECT word, freq, round(cohesion_forward, 6) AS cohesion_forward,
      round(right_branching_entropy, 6) AS right_branching_entropy, round(score, 6) AS score FROM scores""",
)


def spacing_parts(line: str, prefix: str) -> dict[str, str]:
    """Characters of each line with a flag for the space after them, and the windows around the gaps."""
    units = rf"regexp_extract_all({line}, '[^\t\n\x{{0B}}\f\r \x{{1C}}-\x{{1F}}\x{{85}}\x{{A0}}\x{{1680}}\x{{2000}}-\x{{200A}}\x{{2028}}\x{{2029}}\x{{202F}}\x{{205F}}\x{{3000}}]{WS}*')"
    return {
        f"{prefix}unit": exploded("lines", "doc_id, line_no", units, "u", "pos"),
        f"{prefix}gap": f"""SELECT doc_id, line_no, pos, u, CASE WHEN length(u) > 1 THEN 1 ELSE 0 END AS sp,
          coalesce(lag(substr(u, 1, 1)) OVER w, chr(2)) AS a, substr(u, 1, 1) AS b,
          coalesce(lead(substr(u, 1, 1)) OVER w, chr(2)) AS c, coalesce(lead(substr(u, 1, 1), 2) OVER w, chr(2)) AS d
          FROM {prefix}unit WINDOW w AS (PARTITION BY doc_id, line_no ORDER BY pos)""",
    }


CONTEXT_ROWS = "[('20', a || b), ('11', b || c), ('02', c || d), ('21', a || b || c), ('12', b || c || d)]"
SPACING_MODEL = {
    "win": "SELECT a, b, c, d, sum(sp) AS s, count(*) AS n FROM gap WHERE c <> chr(2) GROUP BY a, b, c, d",
    "model": f"""SELECT x[1] AS ctx_kind, x[2] AS ctx, CAST(sum(s) AS BIGINT) AS n_space, CAST(sum(n) AS BIGINT) AS n_total
      FROM (SELECT unnest({CONTEXT_ROWS}) AS x, s, n FROM win) WHERE NOT contains(x[2], chr(2)) GROUP BY 1, 2""",
}
ORACLES["a11_spacing_train"] = sql(
    "lines", "SELECT ctx_kind, ctx, n_space, n_total FROM model", **spacing_parts("line", ""), **SPACING_MODEL
)
ORACLES["a12_spacing_apply"] = sql(
    "lines",
    """SELECT doc_id, line_no, string_agg(CASE WHEN sp = 0 AND p >= 0.5 THEN u || ' ' ELSE u END, '' ORDER BY pos) AS line
    FROM lgap g LEFT JOIN prob q ON q.a = g.a AND q.b = g.b AND q.c = g.c AND q.d = g.d GROUP BY doc_id, line_no""",
    **spacing_parts("line", ""),
    **SPACING_MODEL,
    **spacing_parts(strip(r"regexp_replace(line, '([en]) +', '\1', 'g')"), "l"),
    lwin="SELECT DISTINCT a, b, c, d FROM lgap WHERE c <> chr(2)",
    prob=f"""SELECT a, b, c, d, sum(n_space) / CAST(sum(n_total) AS DOUBLE) AS p FROM (SELECT a, b, c, d, unnest({CONTEXT_ROWS}) AS x FROM lwin)
      JOIN model m ON m.ctx_kind = x[1] AND m.ctx = x[2] WHERE n_total >= 10 GROUP BY a, b, c, d""",
)


def cells(window: int) -> dict[str, str]:
    return {
        "inside": "SELECT t.doc_id, t.line_no, v.id, v.word, row_number() OVER (PARTITION BY t.doc_id, t.line_no ORDER BY t.pos) AS k FROM tok t JOIN vocab v ON v.word = t.word",
        "shifted": f"SELECT doc_id, line_no, id, word, k, unnest(range(1, {window} + 1)) AS d FROM inside",
        "near": "SELECT a.word AS w1, b.word AS w2, a.id AS i, b.id AS j, 1.0 / a.d AS x FROM shifted a JOIN inside b ON b.doc_id = a.doc_id AND b.line_no = a.line_no AND b.k = a.k + a.d",
        "cell": "SELECT w1, w2, i, j, sum(x) AS x FROM (SELECT w1, w2, i, j, CAST(x AS DOUBLE) AS x FROM near UNION ALL SELECT w2, w1, j, i, CAST(x AS DOUBLE) FROM near) GROUP BY w1, w2, i, j",
    }


ORACLES["a13_cooccurrence"] = sql("tok vocab", "SELECT w1, w2, round(x, 6) AS x FROM cell", **cells(15))
ORACLES["a14_shuffle"] = sql(
    "counts",
    f"SELECT word, cnt, CAST(row_number() OVER (ORDER BY {hash32('7', 'word')}, word) - 1 AS BIGINT) AS ordinal FROM counts",
)
ORACLES["a15_pmi"] = sql(
    "tok vocab",
    """SELECT c.i, c.j, round(x, 6) AS x, round(ln(x * (SELECT CAST(sum(CAST(x AS DECIMAL(28,10))) AS DOUBLE) FROM cell) / (r.total * s.total)), 6) AS pmi,
      c.i % 16 AS row_shard, c.j % 16 AS col_shard FROM cell c JOIN side r ON r.i = c.i JOIN side s ON s.i = c.j""",
    **cells(5),
    side="SELECT i, CAST(sum(CAST(x AS DECIMAL(28,10))) AS DOUBLE) AS total FROM cell GROUP BY i",
)
ORACLES["a15_marginals"] = sql("tok vocab", "SELECT w1 AS word, round(sum(x), 6) AS total FROM cell GROUP BY w1", **cells(5))
ORACLES["a16_tfidf"] = sql(
    "doc_tok",
    """SELECT doc_id, t.word, tf, round(tf * ln((1 + (SELECT count(*) FROM documents)) / CAST(1 + df AS DOUBLE)), 6) AS weight FROM terms t
    JOIN (SELECT word, count(*) AS df FROM terms GROUP BY word) d ON d.word = t.word""",
    terms="SELECT doc_id, word, count(*) AS tf FROM doc_tok GROUP BY doc_id, word",
)

# ---------------------------------------------------------------- embeddings

NGRAMS = {
    "starts": "SELECT word, cnt, '<' || word || '>' AS w, unnest(range(1, length(word) + 1)) AS s FROM base",
    "grams": "SELECT word, cnt, substr(w, s, n) AS ngram FROM (SELECT *, unnest(range(3, least(6, length(w) - s + 1) + 1)) AS n FROM starts)",
}
ORACLES["m07_char_ngrams"] = sql(
    "counts",
    "SELECT ngram, CAST(sum(cnt) AS BIGINT) AS cnt, count(*) AS n_words FROM grams GROUP BY ngram",
    base="SELECT word, cnt FROM counts WHERE cnt >= 5",
    **NGRAMS,
)


def mean_text(weight: str, table: str = "rows_v", column: str = "v") -> str:
    """Weighted positional means of a vector as text."""
    means = [number_text(f"sum({column}[{i}] * {weight}) / sum({weight})") for i in range(1, DIM + 1)]
    return " || ' ' || ".join(means)


def ngram_rows(base: str, name: str) -> dict[str, str]:
    """The n-grams of the words of a table, with the table's other columns."""
    return {
        f"{name}_at": f"SELECT *, '<' || word || '>' AS w, unnest(range(1, length(word) + 1)) AS s FROM {base}",
        f"{name}_cut": f"SELECT *, unnest(range(3, least(6, length(w) - s + 1) + 1)) AS n FROM {name}_at",
        name: f"SELECT *, substr(w, s, n) AS ngram FROM {name}_cut",
    }


def mean_floats(column: str, weight: str) -> str:
    """Weighted positional means of a vector, kept as 32-bit numbers."""
    return "[" + ", ".join(f"CAST(sum({column}[{i}] * {weight}) / sum({weight}) AS FLOAT)" for i in range(1, DIM + 1)) + "]"


float_text = " || ' ' || ".join(number_text(f"CAST(vec[{i}] AS DOUBLE)") for i in range(1, DIM + 1))
SHAPE = f"CAST({DIM} AS BIGINT) AS dim, true AS sound"
# Numbers that both sides work out; ``trained`` tells what the other side found of its own vectors.
ORACLES["m01_lsa_words"] = sql(
    "tok vocab",
    f"""SELECT DISTINCT w1 AS word, {SHAPE}, (SELECT CAST(round(sum(ln(1 + x) * ln(1 + x))) AS BIGINT) FROM cell) AS total, true AS trained FROM cell""",
    **cells(15),
)
ORACLES["m02_lsa_docs"] = sql(
    "doc_tok",
    f"SELECT DISTINCT doc_id, {SHAPE}, (SELECT CAST(round(sum(w * w)) AS BIGINT) FROM weights) AS total, true AS trained FROM doc_tok",
    terms="SELECT doc_id, word, count(*) AS tf FROM doc_tok GROUP BY doc_id, word",
    weights="""SELECT tf * ln((1 + (SELECT count(*) FROM documents)) / CAST(1 + df AS DOUBLE)) AS w FROM terms t
      JOIN (SELECT word, count(*) AS df FROM terms GROUP BY word) d ON d.word = t.word""",
)
ORACLES["m03_lda"] = sql(
    "doc_counts",
    """SELECT doc_id, CAST(30 AS BIGINT) AS k, true AS whole,
      (SELECT CAST(round(exp(ln(sum(cnt)) - sum(cnt * ln(cnt)) / sum(cnt))) AS BIGINT) FROM doc_counts) AS alone, true AS trained FROM documents""",
)
ORACLES["m04_word2vec"] = sql("vocab", f"SELECT word, {SHAPE}, true AS trained FROM vocab")
ORACLES["m05_glove"] = sql(
    "tok vocab",
    f"SELECT DISTINCT w1 AS word, {SHAPE}, (SELECT CAST(round(sum(w * t * t) - sum(w * t) * sum(w * t) / sum(w)) AS BIGINT) FROM weighed) AS spread, true AS trained FROM cell",
    **cells(15),
    weighed="SELECT ln(x) AS t, least(1.0, pow(x / 10.0, 0.75)) AS w FROM cell",
)
ORACLES["m06_pmi_factors"] = sql(
    "tok vocab",
    f"SELECT DISTINCT w1 AS word, {SHAPE}, (SELECT CAST(pow(count(DISTINCT w1), 2) AS BIGINT) FROM cell) AS pairs, true AS trained FROM cell",
    **cells(5),
)
ORACLES["m07_fasttext"] = ORACLES["m04_word2vec"]
ORACLES["m08_jamo_fasttext"] = sql(
    "lines",
    f"SELECT word, {SHAPE}, true AS trained FROM (SELECT unnest({words_of(jamo(HANGUL_LINE))}) AS word FROM lines) GROUP BY word HAVING count(*) >= 5",
)
ORACLES["m09_paragraph_vectors"] = f"SELECT DISTINCT lang, {SHAPE}, true AS trained FROM documents"
ORACLES["m07_subword_vectors"] = sql(
    "word_vecs",
    f"SELECT word, {float_text} AS vec FROM composed",
    weighted="SELECT v.word, vec, CAST(cnt AS DOUBLE) AS cnt FROM word_vecs v JOIN doc_counts c ON c.word = v.word",
    **ngram_rows("weighted", "known"),
    gram_vecs=f"SELECT ngram, {mean_floats('vec', 'cnt')} AS vec FROM known GROUP BY ngram",
    **ngram_rows("doc_counts", "every"),
    composed=f"SELECT word, {mean_floats('g.vec', '1.0')} AS vec FROM every e JOIN gram_vecs g ON g.ngram = e.ngram GROUP BY word",
)
ORACLES["m08_jamo_subwords"] = sql(
    "lines",
    f"SELECT ngram, {float_text} AS vec FROM gram_vecs",
    spelled=f"SELECT unnest({words_of(jamo(HANGUL_LINE))}) AS word FROM lines",
    jamo_counts="SELECT word, CAST(count(*) AS DOUBLE) AS cnt FROM spelled GROUP BY word HAVING count(*) >= 5",
    vecs="SELECT word, cnt, [" + ", ".join(f"{hash32('7', 'word', str(i))} / 4294967296.0 - 0.5" for i in range(DIM)) + "] AS vec FROM jamo_counts",
    **ngram_rows("vecs", "known"),
    gram_vecs=f"SELECT ngram, {mean_floats('vec', 'cnt')} AS vec FROM known GROUP BY ngram",
)


ORACLES["m09_tag_vectors"] = sql(
    "doc_tok word_vecs",
    f"SELECT source, {mean_text('1.0', column='vec')} AS vec FROM doc_tok t JOIN word_vecs v ON v.word = t.word GROUP BY source",
)

# ---------------------------------------------------------------- sentence vectors

ORACLES["v01_sentence_vectors"] = sql(
    "doc_tok word_vecs",
    """SELECT d.doc_id, m.vec FROM documents d LEFT JOIN means m ON m.doc_id = d.doc_id""",
    means=f"SELECT doc_id, {mean_text('1.0', column='vec')} AS vec FROM doc_tok t JOIN word_vecs v ON v.word = t.word GROUP BY doc_id",
)
ORACLES["v02_weighted_vectors"] = sql(
    "doc_tok word_vecs",
    """SELECT d.doc_id, m.vec FROM documents d LEFT JOIN means m ON m.doc_id = d.doc_id""",
    weighted="SELECT word, 1e-4 / (1e-4 + cnt / CAST((SELECT sum(cnt) FROM doc_counts) AS DOUBLE)) AS weight FROM doc_counts",
    means=f"""SELECT doc_id, {mean_text('weight', column='vec')} AS vec FROM doc_tok t JOIN word_vecs v ON v.word = t.word
      JOIN weighted w ON w.word = t.word GROUP BY doc_id""",
)
ORACLES["v03_nearest_label"] = sql(
    "nearest",
    "SELECT vec_id, nearest, round(cosine, 6) AS cosine, CAST(label AS BIGINT) AS label, CAST(predicted AS BIGINT) AS predicted FROM nearest",
)
ORACLES["v04_confusion"] = sql(
    "nearest", "SELECT CAST(label AS BIGINT) AS label, CAST(predicted AS BIGINT) AS predicted, count(*) AS cnt FROM nearest GROUP BY 1, 2"
)
ORACLES["v04_accuracy"] = sql(
    "nearest", "SELECT count(*) AS n, round(avg(CASE WHEN label = predicted THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM nearest"
)
ORACLES["v06_split"] = (
    f"SELECT doc_id, CASE WHEN {hash32('7', 'doc_id')} % 1000 < 200 THEN 'test' ELSE 'train' END AS split FROM documents"
)

# ---------------------------------------------------------------- sets

ORACLES["u01_merge"] = " UNION ALL ".join(
    f"SELECT CAST({rank} AS BIGINT) AS source_rank, '{name}' AS source, {k1} AS k1, CAST({k2} AS BIGINT) AS k2, "
    f"array_to_string({words_of('text')}, ' ') AS text FROM {name}"
    for rank, (name, k1, k2) in enumerate([("documents", "doc_id", "0"), ("conversations", "conv_id", "turn"), ("benchmark", "item_id", "0")])
)

# ---------------------------------------------------------------- training records

ORACLES["p01_framing"] = sql("framed_tok", "SELECT doc_id, before + k AS pos, token, sent_no FROM framed_tok")
ORACLES["p02_sentence_segments"] = sql("segmented", "SELECT doc_id, sent_no, CAST(n_tokens AS BIGINT) AS n_tokens, seg FROM segmented")
ORACLES["p02_turn_segments"] = f"""SELECT conv_id, turn, n_tokens, CAST(coalesce(sum(n_tokens) OVER
    (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) // 125 AS seg
    FROM (SELECT conv_id, turn, CAST(len({words_of('text')}) AS BIGINT) AS n_tokens FROM conversations)"""
ORACLES["p02_packed"] = sql("packed", "SELECT doc_id, seg, array_to_string(tokens, ' ') AS tokens FROM packed")
# One row of a document's walk: where it starts (t), and what the hashes choose there.
STEP = f"""SELECT doc_id, n, r, t, stop, CASE WHEN rnd THEN least(al, 63) ELSE al END AS al, rnd FROM (
      SELECT *, own[CASE WHEN len(own) > 1 THEN 1 + {hash32("7", "'end'", "doc_id", "r")} % (len(own) - 1) ELSE 1 END] AS al,
        len(own) = 1 OR {hash32("7", "'side'", "doc_id", "r")} % 2 = 0 AS rnd FROM (
        SELECT w.doc_id, w.r, w.t, n, least(w.t + 125, n) AS stop,
          list_append(list_transform(list_filter(e, lambda x: x > w.t AND x < least(w.t + 125, n)), lambda x: x - w.t), least(w.t + 125, n) - w.t) AS own
        FROM {{walk}} w JOIN doc_ends d ON d.doc_id = w.doc_id))"""
PAIR_PARTS = {
    "ordered": "SELECT doc_id, seg, tokens, row_number() OVER (ORDER BY doc_id, seg) - 1 AS o FROM packed",
    "per_doc": "SELECT doc_id, count(*) AS n, min(o) AS first FROM ordered GROUP BY doc_id",
    "doc_ends": "SELECT doc_id, list(before + n_tokens ORDER BY sent_no) AS e, max(before + n_tokens) AS n FROM placed WHERE n_tokens > 0 GROUP BY doc_id",
    "streams": "SELECT doc_id, list(token ORDER BY sent_no, k) AS s FROM framed_tok GROUP BY doc_id",
    "walk(doc_id, r, t)": f"""SELECT doc_id, CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM doc_ends UNION ALL
      SELECT doc_id, r + 1, CASE WHEN rnd THEN t + al ELSE stop END FROM ({STEP.format(walk="walk")}) WHERE CASE WHEN rnd THEN t + al ELSE stop END < n""",
    "drawn": f"""SELECT x.doc_id, x.r AS seg, t, al, stop, rnd, c.n, first,
      {hash32("7", "'partner'", "x.doc_id", "x.r")} % ((SELECT count(*) FROM packed) - c.n) AS skip
      FROM ({STEP.format(walk="walk")}) x JOIN per_doc c ON c.doc_id = x.doc_id""",
    "cut_pair": """SELECT d.doc_id, d.seg, rnd, list_slice(s, t + 1, t + al) AS a,
      CASE WHEN rnd THEN list_slice(q.tokens, 1, 125 - al) ELSE list_slice(s, t + al + 1, stop) END AS b
      FROM drawn d JOIN streams USING (doc_id) LEFT JOIN ordered q ON q.o = CASE WHEN skip >= first THEN skip + n ELSE skip END""",
}
ORACLES["p03_sentence_pairs"] = sql(
    "packed",
    "SELECT doc_id, seg, array_to_string(a, ' ') AS a, array_to_string(b, ' ') AS b, CAST(rnd AS INTEGER) AS is_random_next FROM cut_pair",
    recursive=True,
    **PAIR_PARTS,
)


def masks(copies: str, source: str = "packed") -> dict[str, str]:
    keys = ("doc_id", "seg", "copy")
    return {
        "copied": f"SELECT doc_id, seg, copy, tokens FROM {source}, (SELECT unnest({copies}) AS copy)",
        "spots": exploded("copied", "doc_id, seg, copy", "tokens", "token", "pos"),
        "hashed": f"SELECT *, {hash32('7', chr(39) + 'pick' + chr(39), *keys, 'pos')} AS h, {hash32('7', chr(39) + 'how' + chr(39), *keys, 'pos')} % 10 AS how, "
        "count(*) OVER (PARTITION BY doc_id, seg, copy) AS n FROM spots",
        "placed_masks": "SELECT *, CASE WHEN token IN ('[CLS]', '[SEP]') THEN NULL ELSE row_number() OVER (PARTITION BY doc_id, seg, copy ORDER BY token IN ('[CLS]', '[SEP]'), h, pos) END AS r FROM hashed",
        "chosen": "SELECT *, coalesce(r <= least(20, greatest(1, CAST(floor(n * 0.15 + 0.5) AS INTEGER))), false) AS masked FROM placed_masks",
    }


ORACLES["p04_masks"] = sql(
    "packed",
    """SELECT doc_id, seg, string_agg(CASE WHEN NOT masked OR how = 8 THEN token ELSE '[MASK]' END, ' ' ORDER BY pos) AS tokens,
      string_agg(CAST(pos AS VARCHAR), ' ' ORDER BY pos) FILTER (masked) AS positions, string_agg(token, ' ' ORDER BY pos) FILTER (masked) AS labels
    FROM chosen GROUP BY doc_id, seg""",
    **masks("[1]"),
)
ORACLES["p05_copies"] = sql(
    "packed",
    """SELECT doc_id, seg, CAST(copy AS BIGINT) AS copy, string_agg(CAST(pos AS VARCHAR), ' ' ORDER BY pos) FILTER (masked) AS positions
    FROM chosen GROUP BY doc_id, seg, copy""",
    **masks("[1, 2, 3, 4, 5]"),
)


ORACLES["p03_own_tokens"] = sql("framed_tok", "SELECT doc_id, count(*) AS n_tokens FROM framed_tok GROUP BY doc_id")
ORACLES["p05_training_records"] = sql(
    "packed",
    """SELECT c.doc_id, c.seg, CAST(c.copy AS BIGINT) AS copy,
      string_agg(CASE WHEN NOT masked OR how = 8 THEN c.token WHEN how < 8 THEN '[MASK]' ELSE v.token END, ' ' ORDER BY pos) AS tokens,
      string_agg(CASE WHEN pos < len(a) + 2 THEN '0' ELSE '1' END, ' ' ORDER BY pos) AS segment_ids,
      string_agg(CAST(pos AS VARCHAR), ' ' ORDER BY pos) FILTER (masked) AS positions,
      string_agg(c.token, ' ' ORDER BY pos) FILTER (masked) AS labels, CAST(any_value(rnd) AS INTEGER) AS is_random_next
    FROM drawn_words c LEFT JOIN words v ON v.id = c.word_id JOIN cut_pair p ON p.doc_id = c.doc_id AND p.seg = c.seg
    GROUP BY c.doc_id, c.seg, c.copy""",
    recursive=True,
    **PAIR_PARTS,
    records="SELECT doc_id, seg, flatten([['[CLS]'], a, ['[SEP]'], b, ['[SEP]']]) AS tokens FROM cut_pair",
    **masks("[1, 2, 3, 4, 5]", "records"),
    words="""SELECT row_number() OVER (ORDER BY count(*) DESC, token) - 1 AS id, token FROM framed_tok GROUP BY token""",
    drawn_words=f"SELECT *, {hash32('7', chr(39) + 'word' + chr(39), 'doc_id', 'seg', 'copy', 'pos')} % (SELECT count(*) FROM words) AS word_id FROM chosen",
)


def windows(passes: int) -> dict[str, str]:
    return {
        "stream": "SELECT doc_id, list(token ORDER BY sent_no, k) AS t FROM framed_tok GROUP BY doc_id",
        "ways": "SELECT doc_id, 'forward' AS direction, t FROM stream UNION ALL SELECT doc_id, 'backward', list_reverse(t) FROM stream",
        "wins": "SELECT doc_id, direction, s // 128 AS win, list_slice(t, s + 1, s + 256) AS tokens FROM (SELECT *, unnest(range(0, len(t), 128)) AS s FROM ways)",
        "copies": f"SELECT *, unnest(range(1, {passes} + 1)) AS pass FROM wins",
    }


ORACLES["p06_windows"] = sql(
    "framed_tok",
    f"""SELECT doc_id, direction, CAST(win AS BIGINT) AS win, CAST(pass AS BIGINT) AS pass, md5(array_to_string(tokens, ' ')) AS tokens,
      CAST(len(tokens) AS BIGINT) AS n, {hash32('7', 'pass', 'doc_id', 'direction', 'win')} AS order_key FROM copies""",
    **windows(10),
)
WKEYS = ("doc_id", "direction", "win", "pass")
ORACLES["p07_span_masks"] = sql(
    "framed_tok",
    """SELECT c.doc_id, c.direction, CAST(c.win AS BIGINT) AS win, CAST(c.pass AS BIGINT) AS pass, coalesce(p.positions, '') AS positions
    FROM copies c LEFT JOIN placed_spans p ON p.doc_id = c.doc_id AND p.direction = c.direction AND p.win = c.win AND p.pass = c.pass""",
    **windows(10),
    spanned=f"SELECT doc_id, direction, win, pass, len(tokens) AS n, {hash32('7', chr(39) + 'span' + chr(39), *WKEYS)} % 5 + 1 AS span FROM copies",
    blocks="SELECT *, unnest(range(0, n, span * 6)) AS s FROM spanned",
    begun=f"""SELECT *, s + {hash32('7', chr(39) + 'start' + chr(39), *WKEYS, 's')} % (span * 5 + 1) AS b,
      {hash32('7', chr(39) + 'rank' + chr(39), *WKEYS, 's')} AS h FROM blocks""",
    fits="SELECT *, row_number() OVER (PARTITION BY doc_id, direction, win, pass ORDER BY h, b) AS r FROM begun WHERE b + span <= n",
    spots="SELECT doc_id, direction, win, pass, unnest(range(b, b + span)) AS pos FROM fits WHERE r <= 45 // span",
    placed_spans="SELECT doc_id, direction, win, pass, string_agg(CAST(pos AS VARCHAR), ' ' ORDER BY pos) AS positions FROM spots GROUP BY doc_id, direction, win, pass",
)

ORACLES["v03_approximate"] = sql("test", "SELECT count(*) AS n, true AS enough FROM test")
ORACLES["v05_probe_fit"] = sql("train", "SELECT CAST(label AS BIGINT) AS label, count(*) AS n, true AS trained FROM train GROUP BY label")
