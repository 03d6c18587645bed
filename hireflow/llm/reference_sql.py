"""SQL that gives the rows of the queries that SQL can express, for tables of test size."""

from __future__ import annotations

from hireflow.llm import contamination, divergence, jaccard_join, suffix_dedup, url_markov

_SPACES = "[\\x20\\x09-\\x0D]+"
_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str, separators: str = _SPACES) -> str:
    return f"list_filter(string_split_regex({text}, '{separators}'), lambda x: x <> '')"


def _divergence() -> str:
    d = divergence
    whole = "coalesce(text, '')"
    classes, rest = [], "t"
    counts = []
    for i, pattern in enumerate(d.CLASSES):
        pattern = pattern.replace("'", "''")
        classes.append(f"regexp_replace({rest}, '{pattern}', '', 'g') AS t{i}")
        counts.append(f"length({rest}) - length(t{i})")
        rest = f"t{i}"
    counts.append(f"length({rest})")
    left = "".join(
        f", c{i} AS (SELECT *, {column} FROM {'c%d' % (i - 1) if i else 'texts'})"
        for i, column in enumerate(classes)
    )
    common = d.COMMON
    share = "CASE WHEN sum(n) OVER (PARTITION BY id) > 0 THEN n / sum(n) OVER (PARTITION BY id) END"

    def distance(name: str, mine: str, theirs: str) -> str:
        part = "CASE WHEN {0} > 0 THEN {0} * log2(2 * {0} / ({0} + {1})) ELSE 0 END"
        return f"""{name} AS (
            SELECT id, sqrt(greatest(sum({part.format('p', 'q')} + {part.format('q', 'p')}) / 2, 0)) AS distance
            FROM (SELECT m.id, m.p, r.q FROM (SELECT id, ref, bin, {share} AS p FROM {mine}) m
                  JOIN (SELECT id AS ref, bin, {share} AS q FROM {theirs}) r USING (ref, bin))
            GROUP BY id)"""

    return f"""
    WITH texts AS (SELECT row_number() OVER () AS id, doc_id, lang, {whole} AS t FROM documents){left},
    classes AS (SELECT id, lang, unnest(range({len(counts)})) AS bin, unnest([{', '.join(counts)}]) AS n FROM c{len(d.CLASSES) - 1}),
    words AS (SELECT id, doc_id, lang, t, {_words('t')} AS w FROM texts),
    word AS (SELECT id, lang, unnest(w) AS word, unnest(range(len(w))) AS place FROM words),
    windows AS (SELECT *, count(*) OVER (PARTITION BY id, win) AS times FROM (
        SELECT id, place, [word, lead(word) OVER o, lead(word, 2) OVER o] AS win, lead(word, 2) OVER o AS last
        FROM word WINDOW o AS (PARTITION BY id ORDER BY place)) WHERE last IS NOT NULL),
    repeated AS (SELECT id, count(DISTINCT p) AS n FROM (
        SELECT id, unnest(range(place, place + 3)) AS p FROM windows WHERE times > 1) GROUP BY id),
    lines AS (SELECT id, count(*) - count(DISTINCT line) AS n FROM (
        SELECT id, unnest(string_split(t, chr(10))) AS line FROM words)
        WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY id),
    base AS (SELECT id, doc_id, lang, w, len(w) AS n_words, length(t) AS n_chars,
               CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
               length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
               coalesce(l.n, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
        FROM words LEFT JOIN lines l USING (id) LEFT JOIN repeated r USING (id)),
    per_lang AS (SELECT lang, word, count(*) AS n FROM word GROUP BY ALL),
    own AS (SELECT lang FROM per_lang WHERE lang IS NOT NULL AND lang <> '{d.ALL}' GROUP BY lang
            HAVING sum(n) >= {d.SHARE} * (SELECT sum(n) FROM per_lang)),
    all_words AS (SELECT lang, word, n FROM per_lang WHERE lang IN (FROM own)
        UNION ALL SELECT '{d.ALL}', word, sum(n) FROM per_lang GROUP BY word),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS bin,
                 sum(n) OVER (PARTITION BY lang) AS total FROM all_words),
    word_ref AS (SELECT lang AS id, bin, n FROM ranked WHERE bin <= {common}
        UNION ALL SELECT lang, {common + 1}, any_value(total) - sum(n) FROM ranked WHERE bin <= {common} GROUP BY lang),
    class_ref AS (SELECT lang AS id, bin, sum(n) AS n FROM classes WHERE lang IN (FROM own) GROUP BY ALL
        UNION ALL SELECT '{d.ALL}', bin, sum(n) FROM classes GROUP BY bin),
    judged AS (SELECT *, CASE WHEN lang IN (FROM own) THEN lang ELSE '{d.ALL}' END AS ref FROM base),
    mine_words AS (
        SELECT j.id, j.ref, r.bin, count(w.word) AS n
        FROM judged j JOIN ranked r ON r.lang = j.ref AND r.bin <= {common}
        LEFT JOIN word w ON w.id = j.id AND w.word = r.word GROUP BY ALL
        UNION ALL
        SELECT j.id, j.ref, {common + 1}, j.n_words - count(r.word)
        FROM judged j LEFT JOIN word w ON w.id = j.id
        LEFT JOIN ranked r ON r.lang = j.ref AND r.bin <= {common} AND r.word = w.word
        GROUP BY j.id, j.ref, j.n_words),
    mine_classes AS (SELECT j.id, j.ref, c.bin, c.n FROM judged j JOIN classes c USING (id)),
    {distance('word_distance', 'mine_words', 'word_ref')},
    {distance('class_distance', 'mine_classes', 'class_ref')},
    verdict AS (SELECT j.*, j.n_words < {d.LEAST_WORDS} OR 100 * n_repeat_words > {d.MOST_REPEATED} * j.n_words AS base_failed,
        j.n_words >= {d.GUARD_WORDS} AND n_chars >= {d.GUARD_CHARS}
        AND (c.distance > {d.CHAR_LIMIT} + {d.CHAR_SLACK} / sqrt(n_chars)
             OR w.distance > {d.WORD_LIMIT} + {d.WORD_SLACK} / sqrt(j.n_words)) AS far
        FROM judged j LEFT JOIN word_distance w USING (id) LEFT JOIN class_distance c USING (id))
    SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
           CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
           base_failed, NOT base_failed AND NOT coalesce(far, FALSE) AS kept
    FROM verdict"""


def _contamination() -> str:
    n = contamination.WINDOW
    words = _words(_LOWER.format("text"), contamination.SEPARATORS)
    return f"""
    WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {words} AS w FROM benchmark),
    windows AS (SELECT DISTINCT item, least(len(w), {n}) AS n, array_to_string(w[s:s + {n - 1}], ' ') AS win
        FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {n - 1}, 1) + 1)) AS s FROM items WHERE len(w) > 0)),
    docs AS (SELECT row_number() OVER () AS id, doc_id, {words} AS w FROM documents),
    places AS (SELECT id, n, s, array_to_string(w[s:s + n - 1], ' ') AS win
        FROM (SELECT id, w, n, unnest(range(1, len(w) - n + 2)) AS s
              FROM docs, (SELECT DISTINCT n FROM windows))),
    hits AS (SELECT id, s, n, item FROM places JOIN windows USING (n, win)),
    covered AS (SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY id),
    found AS (SELECT id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT id, item FROM hits) GROUP BY id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN covered USING (id) LEFT JOIN found USING (id)"""


def _suffix_dedup() -> str:
    n = suffix_dedup.LENGTH
    return f"""
    WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    strings AS (SELECT doc_id, p, substr(h, 2 * p + 1, {2 * n}) AS s
        FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2 - {n} + 1)) AS p FROM docs)),
    firsts AS (SELECT s, min((doc_id, p)) AS place FROM strings GROUP BY s HAVING count(*) > 1),
    repeats AS (SELECT doc_id, p FROM strings JOIN firsts USING (s) WHERE (doc_id, p) <> place),
    runs AS (SELECT doc_id, run, min(p) AS a, max(p) + {n} AS b FROM (
        SELECT doc_id, p, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM (
            SELECT doc_id, p, CASE WHEN p > lag(p, 1, -{2 * n}) OVER (PARTITION BY doc_id ORDER BY p) + {n}
                              THEN 1 ELSE 0 END AS fresh FROM repeats)) GROUP BY ALL),
    kept AS (SELECT doc_id, a, substr(h, 2 * upto + 1, 2 * (a - upto)) AS part FROM (
            SELECT doc_id, a, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS upto FROM (
                SELECT doc_id, a, b FROM runs UNION ALL SELECT doc_id, len(h) // 2, len(h) // 2 + 1 FROM docs))
        JOIN docs USING (doc_id)),
    pieces AS (SELECT doc_id, string_agg(part, '' ORDER BY a) AS h FROM kept GROUP BY doc_id),
    totals AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id)
    SELECT doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
           coalesce(n_spans, 0) AS n_spans, sha256(unhex(p.h)) AS kept_sha256
    FROM docs d JOIN pieces p USING (doc_id) LEFT JOIN totals USING (doc_id)"""


def _jaccard_join() -> str:
    n, alike = jaccard_join.WORDS, jaccard_join.ALIKE
    return f"""
    WITH RECURSIVE docs AS (SELECT doc_id, {_words(_LOWER.format('text'))} AS w FROM documents),
    tokens AS (SELECT DISTINCT doc_id, array_to_string(w[s:s + {n - 1}], ' ') AS token
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {n - 1}, 1) + 1)) AS s FROM docs WHERE len(w) > 0)),
    sizes AS (SELECT doc_id, count(*) AS n FROM tokens GROUP BY doc_id),
    pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
        FROM tokens x JOIN tokens y USING (token) WHERE x.doc_id <> y.doc_id GROUP BY ALL),
    links AS (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
        WHERE 100 * shared >= {alike} * (x.n + y.n - shared)),
    reach(a, b) AS (SELECT doc_id, doc_id FROM docs UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
    SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.first AS component_id
    FROM docs d LEFT JOIN sizes s USING (doc_id)
    JOIN (SELECT a AS doc_id, min(b) AS first FROM reach GROUP BY a) r USING (doc_id)"""


def url_markov_sql(rules: list[url_markov.Rule]) -> str:
    u = url_markov
    order = sorted(rules, key=lambda r: (-len(r.text), r.verdict != "block", r.text))
    fits = [
        f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
        for r in order
    ]
    rule = " ".join(f"WHEN {f} THEN '{r.text}'" for f, r in zip(fits, order))
    verdict = " ".join(f"WHEN {f} THEN '{r.verdict}'" for f, r in zip(fits, order))
    start, end = f"chr({ord(u.START)})", f"chr({ord(u.END)})"
    held = ", ".join(f"'{x}'" for x in u.HELD_OUT)
    levels = []
    for k in range(u.ORDER + 1):
        low = "1.0 / (SELECT count(DISTINCT right(gram, 1)) + 1 FROM counts)"
        mixed = ", ".join(
            f"CASE WHEN {x}_n > 0 THEN ({x} + {x}_kinds * {f'l.{x}_p' if k else low}) / ({x}_n + {x}_kinds)"
            f" ELSE {f'l.{x}_p' if k else low} END AS {x}_p"
            for x in ("allow", "block")
        )
        join = f"JOIN p{k - 1} l ON l.gram = right(t.gram, {k})" if k else ""
        levels.append(
            f"""t{k} AS (SELECT right(gram, {k + 1}) AS gram, sum(allow) AS allow, sum(block) AS block FROM counts GROUP BY 1),
    n{k} AS (SELECT *, sum(allow) OVER c AS allow_n, sum(CAST(allow > 0 AS INT)) OVER c AS allow_kinds,
                  sum(block) OVER c AS block_n, sum(CAST(block > 0 AS INT)) OVER c AS block_kinds
           FROM t{k} WINDOW c AS (PARTITION BY left(gram, {k}))),
    p{k} AS (SELECT t.gram, {mixed} FROM n{k} t {join})"""
        )
    return f"""
    WITH parts AS (SELECT row_number() OVER () AS id, page_id, coalesce(url, '') AS url,
            {_LOWER.format("regexp_extract(url, '://([^/?#]*)', 1)")} AS host,
            coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
    ruled AS (SELECT *, CASE {rule} END AS rule, CASE {verdict} END AS verdict,
                left(md5(host), 1) IN ({held}) AS held FROM parts),
    chars AS (SELECT id, verdict, held, repeat({start}, {u.ORDER})
                || regexp_replace({_LOWER.format('url')}, '^[a-z]*://', '') || {end} AS c FROM ruled),
    grams AS (SELECT id, verdict, held, substr(c, i, {u.ORDER + 1}) AS gram
        FROM (SELECT *, unnest(range(1, length(c) - {u.ORDER} + 1)) AS i FROM chars)),
    counts AS (SELECT gram, count(*) FILTER (verdict = 'allow' AND NOT held) AS allow,
                 count(*) FILTER (verdict = 'block' AND NOT held) AS block FROM grams GROUP BY gram),
    {', '.join(levels)},
    scores AS (SELECT id, avg(ln(allow_p) - ln(block_p)) AS score FROM grams JOIN p{u.ORDER} USING (gram) GROUP BY id),
    scored AS (SELECT * FROM ruled JOIN scores USING (id)),
    steps AS (SELECT floor(score / {u.STEP}) AS step, count(*) FILTER (verdict = 'allow') AS allow,
                count(*) FILTER (verdict = 'block') AS block FROM scored WHERE held AND verdict IS NOT NULL GROUP BY 1),
    errors AS (SELECT least(step, greatest(0, coalesce(lag(step) OVER (ORDER BY step) + 1, least(step, 0)))) AS step,
                 coalesce(sum(allow) OVER b, 0) / sum(allow) OVER ()
                 + 1 - coalesce(sum(block) OVER b, 0) / sum(block) OVER () AS error,
                 sum(allow) OVER () > 0 AND sum(block) OVER () > 0 AS both_kinds FROM steps
        WINDOW b AS (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    best AS (SELECT step * {u.STEP} AS step FROM errors WHERE both_kinds ORDER BY round(error, 9), abs(step), step LIMIT 1)
    SELECT page_id, host, path, rule, coalesce(verdict,
        CASE WHEN score >= coalesce((SELECT step FROM best), 0) THEN 'allow' ELSE 'block' END) AS verdict
    FROM scored"""


DIVERGENCE = _divergence()
CONTAMINATION = _contamination()
SUFFIX_DEDUP = _suffix_dedup()
JACCARD_JOIN = _jaccard_join()

SOURCE_AUDIT = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
),
terms AS (
  SELECT d, lang, source, term, count(*) AS n
  FROM (
    SELECT d, lang, source,
      unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM docs
  )
  GROUP BY ALL
),
kept AS (SELECT lang, term FROM terms GROUP BY ALL HAVING count(*) >= 10),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
spread AS (SELECT DISTINCT lang, source FROM docs),
counts AS (
  SELECT lang, source, term, sum(n) AS n FROM terms JOIN kept USING (lang, term) GROUP BY ALL
),
filled AS (
  SELECT lang, source, term, coalesce(n, 0) AS n
  FROM spread JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)
),
shares AS (
  SELECT lang, source, term, n,
    CAST(1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS BIGINT) AS p
  FROM filled JOIN sizes USING (lang)
),
usual AS (
  SELECT lang, term,
    CAST(1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS BIGINT) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM counts GROUP BY ALL) JOIN sizes USING (lang)
),
far AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL
),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM spread a JOIN spread b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source
),
marked AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value
  FROM shares JOIN usual USING (lang, term)
  WHERE n > 0 AND p > q
),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM marked)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
