"""The same answers in plain SQL, written independently of the operators.

Each string runs on the given tables in an ANSI engine with list functions.
"""

from __future__ import annotations

from litwire import fixed
from litwire.plans import queries as q

_SPACE = r"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


def squeeze(x: str) -> str:
    return _SPACE.format(x=x)


def norm(x: str) -> str:
    return (
        rf"array_to_string(list_filter(regexp_extract_all(lower({x}), '[\p{{L}}\p{{N}}_]+'), "
        "lambda w: w not in ('the', 'a', 'an')), ' ')"
    )


RECORDS = (
    "r AS (SELECT doc_id, text, lang, source, n_chars, "
    + squeeze("split_part(text, chr(10), 1)")
    + " AS title, "
    + squeeze("substr(text, length(split_part(text, chr(10), 1)) + 2)")
    + " AS body FROM documents)"
)


def cut(x: str, n: int) -> str:
    return f"CASE WHEN length({x}) <= {n} THEN {x} ELSE rtrim(substr({x}, 1, {n - 1})) || '…' END"


def sentences(x: str) -> str:
    marked = (
        f"regexp_replace(regexp_replace({squeeze(x)}, '([.!?。！？;])\\s+', '\\1' || chr(1), 'g'), '；', '；' || chr(1), 'g')"
    )
    return (
        f"list_filter(list_transform(string_split({marked}, chr(1)), lambda s: trim(s)), "
        f"lambda s: length(s) >= {fixed.MIN_SENTENCE_CHARS})"
    )


def lcs(a: str, b: str) -> str:
    """Bit-parallel common subsequence, 62 bits per word, with carry."""
    full = (1 << 62) - 1
    words = f"((length({a}) + 61) // 62)"
    masks = (
        f"list_transform(string_split({b}, ''), lambda c: list_transform(range({words}), lambda w: "
        f"coalesce(list_sum(list_transform(range(62), lambda i: CASE WHEN {a}[(w * 62 + i + 1)::INT] = c "
        "THEN (1::BIGINT << i::INT) ELSE 0::BIGINT END)), 0)::BIGINT))"
    )
    start = f"list_transform(range({words}), lambda w: {full}::BIGINT)"
    step = (
        "list_reduce(list_transform(range(len(v)), lambda w: [v[w + 1], v[w + 1] & m[w + 1]]), "
        f"lambda acc, p: list_append(list_concat([(p[1] + p[2] + acc[1]) >> 62], acc[2:]), "
        f"((p[1] + p[2] + acc[1]) & {full}::BIGINT) | (p[1] - p[2])), [0::BIGINT])[2:]"
    )
    last = f"list_reduce({masks}, lambda v, m: {step}, {start})"
    return f"(62 * {words} - list_sum(list_transform({last}, lambda v: bit_count(v)))::BIGINT)"


def scored(pairs: str, low: int) -> str:
    """Pairs (x, y, nx, ny, ...) with their ratio; the edit distance, never
    more than the insertions and deletions, rules most of them out first."""
    return (
        f"near AS MATERIALIZED (SELECT * FROM ({pairs}) WHERE 200 * least(length(nx), length(ny)) >= {low} * (length(nx) + length(ny)) "
        f"AND levenshtein(nx, ny) <= (length(nx) + length(ny)) * (1 - {low} / 100.0) + 0.000001), "
        "sized AS (SELECT *, CASE WHEN length(nx) <= length(ny) THEN nx ELSE ny END AS s_, CASE WHEN length(nx) <= length(ny) THEN ny ELSE nx END AS l_ FROM near), "
        f"pairs AS MATERIALIZED (SELECT * FROM (SELECT *, CASE WHEN nx = ny THEN 100.0::DOUBLE ELSE 200.0::DOUBLE * {lcs('s_', 'l_')} / (length(nx) + length(ny)) END AS score FROM sized) WHERE score >= {low})"
    )


TITLES = f"{RECORDS}, t AS (SELECT min(doc_id) AS ord, norm FROM (SELECT doc_id, {norm('title')} AS norm FROM r) WHERE norm <> '' GROUP BY norm)"
TITLE_PAIRS = "SELECT a.ord AS x, b.ord AS y, a.norm AS nx, b.norm AS ny FROM t a JOIN t b ON a.ord < b.ord"

# Leaders in order: only titles with an earlier neighbour can follow.
LEADERS = (
    "adj AS (SELECT y, list(x ORDER BY x) AS xs, row_number() OVER (ORDER BY y) AS i FROM pairs GROUP BY y), "
    "walk AS (SELECT 0::BIGINT AS i, []::BIGINT[] AS lost, []::BIGINT[] AS led UNION ALL "
    "SELECT w.i + 1, CASE WHEN len(list_filter(a.xs, lambda z: NOT list_contains(w.lost, z))) > 0 THEN list_append(w.lost, a.y) ELSE w.lost END, "
    "CASE WHEN len(list_filter(a.xs, lambda z: NOT list_contains(w.lost, z))) > 0 THEN list_append(w.led, list_filter(a.xs, lambda z: NOT list_contains(w.lost, z))[1]) ELSE w.led END "
    "FROM walk w JOIN adj a ON a.i = w.i + 1), "
    "done AS (SELECT lost, led FROM walk ORDER BY i DESC LIMIT 1), "
    "follow AS (SELECT unnest(lost) AS ord, unnest(led) AS leader FROM done), "
    "lead AS (SELECT t.ord, coalesce(f.leader, t.ord) AS leader, t.norm FROM t LEFT JOIN follow f ON f.ord = t.ord)"
)


def _hits(column: str, terms: list[str]) -> str:
    return " + ".join(f"contains({column}, '{t}')::INT" for t in terms)


def _relevance() -> str:
    parts = []
    for profile, terms in q.TERMS.items():
        negative = rf"regexp_matches(lower(body), '\b(negative|tested negative|no evidence of)\b.{{0,80}}{profile}')"
        th, bh = _hits("lower(title)", terms), _hits("lower(body)", terms)
        parts.append(
            f"SELECT doc_id, '{profile}' AS profile_id, ({th})::INT AS title_hits, ({bh})::INT AS body_hits, "
            f"greatest(0, least(100, ({th}) * 45 + ({bh}) * 8) - CASE WHEN {negative} AND ({th}) = 0 THEN 40 ELSE 0 END)::INT AS score_points FROM r"
        )
    return f"WITH {RECORDS}, s AS ({' UNION ALL '.join(parts)}) SELECT *, score_points / 100.0::DOUBLE AS relevance_score FROM s WHERE score_points >= 18"


def _any(terms: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower(text), '{t}')" for t in terms) + ")"


def _quote(t: str) -> str:
    return f'"{t}"' if " " in t else t


def _matches(negatives: bool) -> str:
    parts = []
    for group, terms, topics, negs in q.GROUPS:
        ok = _any(terms)
        if topics:
            ok += " AND " + _any(topics)
        if negatives:
            ok += " AND NOT " + _any(negs or ["oun"])
        parts.append(f"SELECT doc_id, '{group}' AS group_id FROM documents WHERE {ok}")
    return " UNION ALL ".join(parts)


def _plan_counts() -> str:
    rows = []
    for group, terms, topics, negs in q.GROUPS:
        wanted = "(" + " OR ".join(map(_quote, terms)) + ")"
        about = "(" + " OR ".join(map(_quote, topics)) + ")"
        news = wanted + (f" {about}" if topics else "") + "".join(f" -{_quote(n)}" for n in (negs or ["oun"]))
        rows.append(f"('{group}', '{wanted + (f' AND {about}' if topics else '')}', '{news}')")
    return (
        f"SELECT p.group_id, scholarly_query, news_query, count(m.doc_id) AS n_docs FROM (VALUES {', '.join(rows)}) p(group_id, scholarly_query, news_query) "
        f"LEFT JOIN ({_matches(False)}) m ON m.group_id = p.group_id GROUP BY ALL"
    )


def _words(pattern: str) -> str:
    inner = pattern.removeprefix(r"\b").removesuffix(r"\b")
    return rf"(?i)(^|[^\p{{L}}\p{{N}}_]){inner}($|[^\p{{L}}\p{{N}}_])"


KIND = f"CASE WHEN regexp_matches(concat_ws(' ', lang, title, left(body, 500)), '{_words(q.TYPE_WORDS)}') THEN 'review' ELSE 'research' END"

AVAILABLE = (
    "WITH s AS (SELECT l_orderkey AS k, min(l_shipdate)::DATE AS online_date, max(l_shipdate)::DATE AS print_date FROM lineitem GROUP BY 1), "
    "d AS (SELECT o_orderkey, o_orderdate::DATE AS created_date, online_date, print_date FROM orders LEFT JOIN s ON k = o_orderkey), "
    "c AS (SELECT *, DATE '1997-06-30' AS lo, DATE '1998-06-30' AS hi FROM d), "
    "x AS (SELECT *, CASE WHEN online_date BETWEEN lo AND hi THEN 'online_date' WHEN created_date BETWEEN lo AND hi THEN 'created_date' WHEN print_date BETWEEN lo AND hi THEN 'print_date' END AS i, "
    "CASE WHEN online_date <= hi THEN 'online_date' WHEN created_date <= hi THEN 'created_date' WHEN print_date <= hi THEN 'print_date' END AS p FROM c) "
    "SELECT o_orderkey, strftime(CASE coalesce(i, p) WHEN 'online_date' THEN online_date WHEN 'created_date' THEN created_date ELSE print_date END, '%Y-%m-%d') AS availability_date, "
    "coalesce(i, p) AS availability_date_basis, i IS NOT NULL AS in_window FROM x WHERE coalesce(i, p) IS NOT NULL"
)

SHOWN = (
    "CASE o_orderkey % 6 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN 'on ' || strftime(o_orderdate, '%Y/%-m/%-d') || ' in print' "
    "WHEN 2 THEN 'issue ' || strftime(o_orderdate, '%Y-%m') WHEN 3 THEN strftime(o_orderdate, '%Y') WHEN 4 THEN strftime(o_orderdate, '%Y') || '-13-01' ELSE 'no date' END"
)
PARSED = (
    f"WITH a AS (SELECT o_orderkey, {SHOWN} AS shown FROM orders), "
    r"b AS (SELECT *, string_split(replace(regexp_extract(shown, '(19|20)\d{2}([-/]\d{1,2})?([-/]\d{1,2})?'), '/', '-'), '-') AS p FROM a) "
    "SELECT o_orderkey, shown, coalesce(strftime(try_cast(p[1] || '-' || lpad(coalesce(p[2], '1'), 2, '0') || '-' || lpad(coalesce(p[3], '1'), 2, '0') AS DATE), '%Y-%m-%d'), 'none') AS parsed FROM b"
)

PAGE_TITLE = squeeze("regexp_extract(html, '(?is)<title>(.*?)</title>', 1)")
LINK = (
    f"WITH {TITLES}, p AS (SELECT page_id, {PAGE_TITLE} AS title FROM pages), pn AS (SELECT page_id, title, {norm('title')} AS norm FROM p), "
    "u AS (SELECT DISTINCT norm FROM pn WHERE norm <> ''), "
    + scored("SELECT u.norm AS x, t.ord AS y, u.norm AS nx, t.norm AS ny FROM u, t", fixed.LINK_RATIO)
    + ", best AS (SELECT x, y, score, row_number() OVER (PARTITION BY x ORDER BY score DESC, y) AS rn FROM pairs), "
    f"linked AS (SELECT page_id, regexp_matches(title, '{_words(q.GUARD_WORDS)}') AS is_event, b.y, b.score FROM pn LEFT JOIN best b ON b.x = pn.norm AND b.rn = 1) "
)


def _glossary(x: str) -> str:
    order = sorted(q.GLOSSARY, key=lambda e: -len(e[0]))
    for i, (source, _) in enumerate(order):
        x = f"regexp_replace({x}, '{source}', '[T{i:04d}]', 'gi')"
    return x


def _restored(x: str) -> str:
    order = sorted(q.GLOSSARY, key=lambda e: -len(e[0]))
    for i, (_, target) in enumerate(order):
        x = f"replace(replace({x}, '[T{i:04d}]', '{target}'), '[t{i:04d}]', '{target}')"
    return x


def _listing() -> str:
    return "'" + "' || chr(10) || '".join(f"{s}' || chr(9) || '{t}" for s, t in q.GLOSSARY) + "'"


def _memory_key(field: str, text: str) -> str:
    return f"sha256({field} || '|' || {text} || '|' || sha256({_listing()}))"


MEMORY = f"m AS (SELECT {_memory_key(repr('title'), 'title')} AS key, '译' || min(title) AS text, 1::BIGINT AS seq FROM r WHERE doc_id % 3 = 0 GROUP BY 1)"


def _chinese(x: str) -> str:
    return f"(len(regexp_extract_all({x}, '[一-鿿]')) > length({x}) * 0.2)"


RESOLVED = (
    f"f AS (SELECT doc_id, unnest(['title', 'source']) AS field, unnest([title, source]) AS src FROM r), "
    f"k AS (SELECT *, {_memory_key('field', 'src')} AS key FROM f), "
    "j AS (SELECT k.*, m.text AS mem FROM k LEFT JOIN m ON m.key = k.key), "
    "route AS (SELECT *, CASE WHEN src = '' THEN 'empty_source' WHEN mem IS NOT NULL THEN 'from_memory' ELSE 'unresolved' END AS route, "
    # Made-up answers: numbers of the source must survive, and "bad" never passes.
    r"list_filter(regexp_extract_all(regexp_replace(replace(src, ',', ''), '(\d)\s+(\d{3})(\D|$)', '\1\2\3', 'g'), '[A-Za-z]\d|\d+(?:\.\d+)?%?'), lambda s: NOT regexp_matches(s, '^[A-Za-z]')) AS nums FROM j), "
    "told AS (SELECT *, route = 'unresolved' AND field = 'title' AND doc_id % 2 = 0 AND len(list_filter(nums, lambda v: v <> doc_id::VARCHAR)) = 0 AS one, "
    "route = 'unresolved' AND field = 'title' AND doc_id % 5 <> 0 AND len(list_filter(nums, lambda v: v <> doc_id::VARCHAR)) = 0 AS two FROM route), "
    "res AS (SELECT doc_id, field, key, CASE WHEN route <> 'unresolved' THEN route WHEN one THEN 'passed_model' WHEN two THEN 'passed_second' ELSE 'translation_unavailable' END AS status, "
    "CASE WHEN route = 'from_memory' THEN mem WHEN one THEN '病毒标题编号' || doc_id WHEN two THEN '后备标题编号' || doc_id ELSE '' END AS translated FROM told)"
)


def _numbers(x: str) -> str:
    joined = rf"regexp_replace(replace({squeeze(x)}, ',', ''), '(\d)\s+(\d{{3}})(\D|$)', '\1\2\3', 'g')"
    return rf"list_filter(regexp_extract_all({joined}, '[A-Za-z]\d|\d+(?:\.\d+)?%?'), lambda s: NOT regexp_matches(s, '^[A-Za-z]'))"


WHOLE = "CASE WHEN doc_id % 7 = 0 THEN text || ' (doi:10.1234/AB.' || doc_id || ').' ELSE text END"

NUMBERS_KEPT = (
    "WITH a AS (SELECT u.conv_id, u.turn, u.text || ' 1,' || lpad(u.conv_id::VARCHAR, 3, '0') || ' cases, ' || length(x.text) || '% of them' AS src, "
    "'共报告1' || lpad(u.conv_id::VARCHAR, 3, '0') || '例，其中占' || CASE WHEN u.conv_id % 3 = 0 THEN length(x.text) + 1 ELSE length(x.text) END || '%' AS dst "
    "FROM conversations u JOIN conversations x ON x.conv_id = u.conv_id AND x.turn = u.turn + 1 WHERE u.role = 'user' AND x.role = 'assistant'), "
    f"b AS (SELECT conv_id, turn, {_numbers('src')} AS s, {_numbers('dst')} AS d FROM a), "
    "c AS (SELECT conv_id, turn, list_sort(list_distinct(list_filter(s, lambda v: NOT list_contains(d, v)))) AS missing FROM b) "
    "SELECT conv_id, turn, CASE WHEN len(missing) > 0 THEN 'number_loss' ELSE 'ok' END AS reason, array_to_string(missing, '|') AS missing FROM c"
)

STRIPPED = "regexp_replace(html, '<[^>]+>', ' ', 'g')"
DECODED = "replace(replace(replace(replace({x}, '&copy;', '©'), '&middot;', '·'), '&quot;', '\"'), '&amp;', '&')"
EDGE = r"'^[\s,;:.\-–—]+|[\s,;:.\-–—]+$'"


def _plain(x: str) -> str:
    """Boilerplate rule: stock phrases in order, then edge punctuation."""
    x = squeeze(x)
    for pattern in fixed.BOILERPLATE:
        x = f"regexp_replace({x}, '{pattern}', ' ', 'gi')"
    return squeeze(f"regexp_replace({x}, {EDGE}, '', 'g')")


def _n_words(x: str) -> str:
    return rf"len(regexp_extract_all({x}, '[^\x00-\x20]+'))"


def _marked(html: str) -> str:
    """A page with chr(1) between blocks and chr(2), chr(3) around links; article tags count as block tags."""
    x = f"regexp_replace(translate({html}, chr(1) || chr(2) || chr(3), '   '), '(?s)<!--.*?-->', ' ', 'g')"
    for tag in fixed.UNSEEN_TAGS:
        x = rf"regexp_replace({x}, '(?is)<{tag}\b[^>]*>.*?</{tag}\s*>', chr(1), 'g')"
    x = rf"regexp_replace({x}, '(?i)</?({'|'.join(fixed.BLOCK_TAGS)})\b[^>]*>', chr(1), 'g')"
    return rf"regexp_replace(regexp_replace({x}, '(?i)<a\b[^>]*>', chr(2), 'g'), '(?i)</a\s*>', chr(3), 'g')"


LINKED = "array_to_string(regexp_extract_all(t, chr(2) || '([^' || chr(2) || chr(3) || ']*)', 1), ' ')"
TRANSLATED = "translate(t, chr(2) || chr(3), '  ')"
ARTICLE = squeeze(DECODED.format(x="regexp_replace(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '<[^>]+>', ' ', 'g')"))
VISIBLE = squeeze(
    DECODED.format(
        x="regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', ' ', 'g'), '(?s)<(script|style|nav|footer)[ >].*?</(script|style|nav|footer)>', ' ', 'g'), '<[^>]+>', ' ', 'g')"
    )
)

EVENT_WINDOWS = (
    "SELECT strftime(s, '%Y-%m-%d') AS window_start, strftime(s + INTERVAL 7 DAY, '%Y-%m-%d') AS window_end, event_type, count(*) AS n FROM "
    "(SELECT event_type, unnest(generate_series(ts::DATE - INTERVAL 7 DAY, ts::DATE, INTERVAL 1 DAY)) AS s FROM events) GROUP BY ALL"
)

FEED_DATE = "strftime(DATE '2024-01-01' + (doc_id % 300)::INT, '%Y-%m-%d')"


def _feed(doi: str, title: str, abstract: str, authors: str, journal: str, day: str, url: str, where: str = "true") -> str:
    return (
        f"WITH {RECORDS} SELECT {doi} AS doi, {title} AS title, md5({abstract}) AS abstract_md5, {authors} AS authors, "
        f"{journal} AS journal, {day} AS online_date, {url} AS url FROM r WHERE {where}"
    )


def _news_feed(source: str, url: str, excerpt: str, publisher: str, language: str) -> str:
    return (
        f"WITH {RECORDS} SELECT '{source}' AS source, title, '{url}' || doc_id AS url, {FEED_DATE} AS published_date, "
        f"md5({excerpt}) AS excerpt_md5, {publisher} AS publisher, {language} AS language FROM r"
    )


FALLBACK = f"WITH {RECORDS}, e AS (SELECT *, {sentences('body')} AS ev, {KIND} AS kind FROM r)"
_MISSING, _FULL = fixed.NOT_IN_EVIDENCE, fixed.READ_FULL_TEXT
RESEARCH = [
    cut("ev[1]", 260),
    f"CASE WHEN len(ev) > 1 THEN {cut('ev[2]', 220)} ELSE '{_MISSING}' END",
    f"CASE WHEN len(ev) > 2 THEN {cut('array_to_string(ev[3:4], chr(32))', 320)} ELSE '{_MISSING}' END",
    f"CASE WHEN len(ev) > 4 THEN {cut('ev[5]', 220)} ELSE '{_FULL}' END",
    f"'{fixed.EVIDENCE_LIMIT}'",
]
REVIEW = [
    cut("ev[1]", 260),
    f"CASE WHEN len(ev) > 1 THEN {cut('array_to_string(ev[2:3], chr(32))', 320)} ELSE '{_MISSING}' END",
    f"CASE WHEN len(ev) > 3 THEN {cut('ev[4]', 220)} ELSE '{_FULL}' END",
    f"'{fixed.EVIDENCE_LIMIT}'",
    f"CASE WHEN len(ev) > 4 THEN {cut('ev[5]', 220)} ELSE '{fixed.READ_FULL_TEXT_FUTURE}' END",
]
NEWS_FIVE = (
    f"WITH {RECORDS}, e AS (SELECT *, {sentences('body')} AS ev FROM r) SELECT doc_id, '{fixed.NEWS_NOT_REPORTED}' AS time_text, "
    f"CASE WHEN len(ev) = 0 THEN '{fixed.NEWS_NO_LOCATION}' ELSE '{fixed.NEWS_NOT_IN_EVIDENCE}' END AS location_text, "
    f"CASE WHEN len(ev) = 0 THEN '{fixed.NEWS_NO_EVENT}' ELSE {cut('ev[1]', 260)} END AS event_text, "
    f"CASE WHEN len(ev) = 0 THEN '{fixed.NEWS_NO_IMPACT}' WHEN len(ev) > 1 THEN {cut('array_to_string(ev[2:3], chr(32))', 300)} ELSE '{fixed.NEWS_NOT_IN_EVIDENCE}' END AS impact_text, "
    f"CASE WHEN len(ev) = 0 THEN '{fixed.NEWS_NO_STATUS}' WHEN len(ev) > 3 THEN {cut('array_to_string(ev[4:5], chr(32))', 280)} ELSE '{fixed.NEWS_VERIFY}' END AS status_text FROM e"
)


def _summary() -> str:
    named = ", ".join(f"{e} AS f{i}" for i, e in enumerate(RESEARCH, 1))

    def joined(width: int) -> str:
        return " || ' ' || ".join(f"'{label}：' || {cut(f'f{i}', width)}" for i, label in enumerate(fixed.RESEARCH_LABELS, 1))

    return (
        f"{FALLBACK}, n AS (SELECT doc_id, {named} FROM e WHERE len(ev) > 0), w AS (SELECT doc_id, {joined(72)} AS wide, {joined(48)} AS slim FROM n) "
        f"SELECT doc_id, CASE WHEN length(wide) <= 300 THEN wide ELSE {cut('slim', 300)} END AS summary FROM w"
    )


GROUPED = (
    f"WITH {RECORDS}, k AS (SELECT *, CASE WHEN {norm('title')} <> '' THEN 'title:' || {norm('title')} || '|author:' ELSE 'record:' || doc_id END AS key FROM r)"
)

FIRST_WORDS = (
    f"w AS (SELECT item_id, text, {norm('text')} AS nt, array_to_string(list_slice(string_split({norm('text')}, ' '), 1, {q.WORK_WORDS}), ' ') AS head FROM benchmark), "
    f"d AS (SELECT doc_id, {norm('text')} AS nd, {norm('left(text, 2500)')} AS nh FROM documents), "
    "c AS (SELECT item_id, doc_id, nt, nh FROM w JOIN d ON contains(' ' || nd || ' ', ' ' || head || ' '))"
)

CONFLICTS = (
    f"WITH {RECORDS}, p AS (SELECT doc_id, lang, source || '.' || (doc_id // 200) AS key, {norm('title')} AS n FROM r WHERE title <> ''), "
    "h AS (SELECT key, arg_min(n, doc_id) AS hn FROM p GROUP BY key), "
    "z AS (SELECT p.*, hn, CASE WHEN length(n) <= length(hn) THEN n ELSE hn END AS s_, CASE WHEN length(n) <= length(hn) THEN hn ELSE n END AS l_ FROM p JOIN h USING (key)), "
    f"s AS (SELECT *, CASE WHEN n = hn THEN 100.0 WHEN n = '' OR hn = '' OR 200 * least(length(n), length(hn)) < 58 * (length(n) + length(hn)) THEN 0.0 ELSE 200.0::DOUBLE * {lcs('s_', 'l_')} / (length(n) + length(hn)) END AS title_score FROM z), "
    f"known AS (SELECT key, lang, min(doc_id) AS since FROM s WHERE title_score >= {fixed.CONFLICT_RATIO} GROUP BY ALL) "
    "SELECT doc_id FROM s LEFT JOIN known USING (key, lang) "
    f"WHERE title_score < {fixed.CONFLICT_RATIO} AND NOT coalesce(since < doc_id, false)"
)

BAND = (
    f"WITH {RECORDS}, t AS (SELECT source AS b, min(doc_id) AS ord, norm FROM (SELECT doc_id, source, {norm('title')} AS norm FROM r) WHERE norm <> '' GROUP BY ALL), "
    + scored("SELECT a.b AS b, a.ord AS x, c.ord AS y, a.norm AS nx, c.norm AS ny FROM t a JOIN t c ON a.b = c.b AND a.ord < c.ord", fixed.REVIEW_LOW)
    + f", g AS (SELECT b, x, y, row_number() OVER (PARTITION BY b, x ORDER BY y) AS pos, dense_rank() OVER (PARTITION BY b ORDER BY x) AS group_no FROM pairs WHERE score < {fixed.REVIEW_HIGH}) "
    "SELECT b AS source, group_no, pos, y AS doc_id FROM g WHERE pos <= 5 AND group_no <= 8 UNION ALL "
    "SELECT DISTINCT b, group_no, 0, x FROM g WHERE group_no <= 8"
)


TERM_TABLE = (
    "g AS (SELECT DISTINCT 'even' AS p, unnest(regexp_extract_all(lower(text), '[a-z]{6,}')) AS s FROM benchmark UNION SELECT DISTINCT 'odd', unnest(regexp_extract_all(lower(text), '[a-z]{12,}')) FROM conversations), "
    "h AS (SELECT *, CAST('0x' || substr(md5(s), 1, 12) AS BIGINT) AS pos FROM g), "
    "e AS (SELECT *, '词' || pos AS t, '[T' || right('000' || n, greatest(4, length(n::VARCHAR))) || ']' AS tok FROM (SELECT *, row_number() OVER (PARTITION BY p ORDER BY length(s) DESC, pos) - 1 AS n FROM h)), "
    "d AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'even' ELSE 'odd' END AS p, text, title FROM r)"
)
BY_PROFILE = (
    f"WITH {RECORDS}, {TERM_TABLE}, m AS (SELECT doc_id, list([s, tok, t] ORDER BY length(s) DESC, pos) AS l FROM d JOIN e ON d.p = e.p AND contains(lower(text), s) GROUP BY doc_id), "
    "x AS (SELECT d.doc_id, d.p, coalesce(l, []) AS l, list_reduce(list_prepend([text], coalesce(l, [])), lambda a, q: [regexp_replace(a[1], '(?i)' || q[1], q[2], 'g')])[1] AS hidden FROM d LEFT JOIN m USING (doc_id)) "
    "SELECT doc_id, p AS profile_id, len(l) AS n_terms, md5(hidden) AS protected_md5, md5(list_reduce(list_prepend([hidden], l), lambda a, q: [replace(replace(a[1], q[2], q[3]), lower(q[2]), q[3])])[1]) AS restored_md5 FROM x"
)
REPAIRED_BY_PROFILE = (
    f"WITH {RECORDS}, {TERM_TABLE}, m AS (SELECT doc_id, list([s, t] ORDER BY pos) AS l FROM d JOIN e ON d.p = e.p AND contains(lower(title), s) GROUP BY doc_id), "
    "x AS (SELECT doc_id, list_reduce(list_prepend(['汉坦病毒 , ' || title || ' ; 汉坦病毒 。'], coalesce(l, [])), lambda a, q: [regexp_replace(a[1], '(?i)' || q[1], q[2], 'g')])[1] AS x FROM d LEFT JOIN m USING (doc_id)), "
    f"c AS (SELECT doc_id, replace(replace(replace(replace(replace(x, ' ,', '，'), ',', '，'), ' ;', '；'), ';', '；'), ' :', '：') AS x FROM x) SELECT doc_id, {squeeze(chr(39).join(['regexp_replace(x, ', chr(92) + 's+([。！？；，])', ', ', chr(92) + '1', ', ', 'g', ')']))} AS repaired FROM c"
)

# Records by title and language; then one at a time, each joining its first leader of like title and the same language
# (where both are known). A leader without language takes that of its first follower with one.
PAPERS = (
    f"WITH RECURSIVE {RECORDS}, p AS (SELECT doc_id, title, body, {norm('title')} AS n, coalesce({norm('lang')}, '') AS author FROM r WHERE title <> ''), "
    "i AS (SELECT *, min(doc_id) OVER (PARTITION BY n, author, CASE WHEN n = '' THEN doc_id END) AS g FROM p), "
    "t AS (SELECT min(g) AS ord, n AS norm, author FROM i GROUP BY n, author), "
    + scored("SELECT a.ord AS x, b.ord AS y, a.norm AS nx, b.norm AS ny, a.author AS ax, b.author AS ay FROM t a JOIN t b ON a.ord < b.ord AND a.norm <> ''", 94)
    + ", adj AS (SELECT y, any_value(ay) AS ay, list({'x': x, 'ax': ax} ORDER BY x) AS xs, row_number() OVER (ORDER BY y) AS i FROM pairs GROUP BY y), "
    "walk AS (SELECT 0::BIGINT AS i, []::BIGINT[] AS lost, []::BIGINT[] AS led, []::STRUCT(o BIGINT, a VARCHAR)[] AS took UNION ALL "
    "SELECT i, CASE WHEN c IS NULL THEN lost ELSE list_append(lost, y) END, CASE WHEN c IS NULL THEN led ELSE list_append(led, c.x) END, "
    "CASE WHEN c IS NOT NULL AND c.ax = '' AND ay <> '' AND NOT list_contains([d.o FOR d IN took], c.x) THEN list_append(took, {'o': c.x, 'a': ay}) ELSE took END FROM ("
    "SELECT w.i + 1 AS i, lost, led, took, y, ay, list_filter(a.xs, lambda z: NOT list_contains(lost, z.x) AND (ay = '' OR z.ax = ay OR (z.ax = '' AND "
    "coalesce([d.a FOR d IN took IF d.o = z.x][1], ay) = ay)))[1] AS c FROM walk w JOIN adj a ON a.i = w.i + 1)), "
    "done AS (SELECT lost, led FROM walk ORDER BY i DESC LIMIT 1), follow AS (SELECT unnest(lost) AS ord, unnest(led) AS leader FROM done), "
    "placed AS (SELECT i.*, coalesce(f.leader, t.ord) AS leader FROM i JOIN t ON t.norm = i.n AND t.author = i.author LEFT JOIN follow f ON f.ord = t.ord) "
    "SELECT leader AS head_doc, arg_min(title, doc_id) AS title, md5(first(body ORDER BY length(body) DESC, g, doc_id)) AS abstract_md5, count(*) AS n_records FROM placed GROUP BY leader"
)


def oracle_sql() -> dict[str, str]:
    link_anchor = r"(?i)href=\"([^\"]+)\"[^>]*>([^<]{1,180})</a>".replace('\\"', '"')
    terms = "[" + ", ".join(f"'{t}'" for t in q.LINK_TERMS) + "]"
    return {
        "flagship": (
            f"WITH {RECORDS}, s AS ({_relevance().split(', s AS (', 1)[1].rsplit(') SELECT *', 1)[0]}), "
            f"k AS (SELECT r.*, s.profile_id, s.score_points / 100.0::DOUBLE AS sc, 'paper-' || left(sha256(CASE WHEN {norm('title')} <> '' THEN 'title:' || {norm('title')} || '|author:' ELSE 'record:' || doc_id END), 16) AS pid FROM s JOIN r USING (doc_id) WHERE s.score_points >= 18), "
            "g AS (SELECT profile_id, pid, min(doc_id) AS ord, count(*) AS n, arg_min(source, doc_id) AS source, first(body ORDER BY length(body) DESC, doc_id) AS body, max(sc) AS sc, max(n_chars) AS nc FROM k GROUP BY ALL), "
            "x AS (SELECT *, row_number() OVER (PARTITION BY profile_id, source ORDER BY sc DESC, nc DESC, ord) AS rank FROM g) "
            "SELECT profile_id, source, rank, pid AS paper_id, ord AS head_doc, n AS n_records, sc AS relevance_score, md5(body) AS body_md5 FROM x WHERE rank <= 24"
        ),
        "normalize_titles": f"WITH {RECORDS} SELECT doc_id, title, {norm('title')} AS norm_title, 'paper-' || left(sha256({norm('title')}), 16) AS title_id FROM r",
        "doc_identity_groups": f"{GROUPED} SELECT 'paper-' || left(sha256(key), 16) AS paper_id, count(*) AS n_docs, min(doc_id) AS head_doc, first(doc_id ORDER BY length(text) DESC, doc_id) AS longest_doc, max(length(text)) AS longest_chars FROM k GROUP BY key",
        "merge_longest_text": (
            f"{GROUPED}, s AS (SELECT key, source, min(doc_id) AS f FROM k GROUP BY ALL), ss AS (SELECT key, string_agg(source, ',' ORDER BY f) AS sources FROM s GROUP BY key) "
            "SELECT min(doc_id) AS head_doc, arg_min(title, doc_id) AS title, md5(first(body ORDER BY length(body) DESC, doc_id)) AS abstract_md5, first(source ORDER BY length(body) DESC, doc_id) AS abstract_source, "
            "coalesce(arg_min(source, doc_id) FILTER (WHERE n_chars % 3 = 0), '') AS journal, count(*) AS n_records, any_value(sources) AS sources, arg_max(lang, doc_id) AS last_lang FROM k JOIN ss USING (key) GROUP BY key"
        ),
        "availability_dates": AVAILABLE,
        "window_filter_undated": "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE 'undated' END AS published_date, 'u' || o_custkey AS url FROM orders WHERE (o_orderstatus = 'P' OR o_orderdate::DATE BETWEEN DATE '1997-06-30' AND DATE '1998-06-30') AND o_custkey % 10 <> 0",
        "parse_dates": PARSED,
        "relevance_scores": _relevance(),
        "relevance_scores_large_dictionary": (
            f"WITH {RECORDS}, t AS (SELECT DISTINCT 'set' || (item_id % 7) AS profile_id, unnest(regexp_extract_all(lower(text), '[a-z]{{4,}}')) AS term FROM benchmark), "
            "d AS (SELECT doc_id, lower(title) AS title, lower(body) AS body FROM r), "
            "h AS (SELECT doc_id, profile_id, any_value(body) AS body, count(*) FILTER (contains(title, term))::INT AS title_hits, count(*) FILTER (contains(body, term))::INT AS body_hits FROM d, t GROUP BY ALL), "
            r"s AS (SELECT *, greatest(0, least(100, title_hits * 45 + body_hits * 8) - CASE WHEN title_hits = 0 AND contains(body, profile_id) AND regexp_matches(body, '\b(negative|tested negative|no evidence of)\b.{0,80}' || profile_id) THEN 40 ELSE 0 END)::INT AS score_points FROM h WHERE title_hits + body_hits > 0) "
            "SELECT doc_id, profile_id, title_hits, body_hits, score_points, score_points / 100.0::DOUBLE AS relevance_score FROM s WHERE score_points >= 18"
        ),
        "query_group_matches": _matches(True),
        "query_group_counts": _plan_counts(),
        "paper_type_split": f"WITH {RECORDS} SELECT source, {KIND} AS paper_type, count(*) AS n_docs, sum(n_chars)::BIGINT AS chars FROM r GROUP BY ALL",
        "topk_per_source": "SELECT source, rank, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY n_chars % 28 DESC, n_chars % 101 DESC, doc_id) AS rank FROM documents) WHERE rank <= 24",
        "arrival_rank": "SELECT doc_id, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS rank FROM documents",
        "metrics_rollup": "SELECT coalesce(source, '(all)') AS source, coalesce(lang, '(all)') AS lang, grouping(source, lang) AS level, count(*) AS n, count(*) FILTER (WHERE quality = 1) AS good, count(*) FILTER (WHERE toxic = 1) AS toxic FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ROLLUP (source, lang)",
        "similar_titles": f"WITH {TITLES}, {scored(TITLE_PAIRS, 84)} SELECT x AS a, y AS b, score FROM pairs",
        "similar_titles_strict": f"WITH {TITLES}, {scored(TITLE_PAIRS, 94)} SELECT x AS a, y AS b, score FROM pairs",
        "title_leaders": f"WITH RECURSIVE {TITLES}, {scored(TITLE_PAIRS, 84)}, {LEADERS} SELECT ord, leader FROM lead",
        "news_dedup": (
            f"WITH RECURSIVE {TITLES}, {scored(TITLE_PAIRS, 84)}, {LEADERS}, j AS (SELECT r.*, l.leader FROM r JOIN lead l ON l.norm = {norm('r.title')}) "
            f"SELECT leader AS head_doc, arg_min(title, doc_id) AS title, 'news-' || left(sha256({norm('arg_min(title, doc_id)')} || '|'), 16) AS news_id, md5(first(body ORDER BY length(body) DESC, doc_id)) AS excerpt_md5, count(*) AS n_records FROM j GROUP BY leader"
        ),
        "news_duplicate_sources": (
            f"WITH RECURSIVE {TITLES}, {scored(TITLE_PAIRS, 84)}, {LEADERS} SELECT l.leader AS head_doc, r.doc_id, r.source, 'https://x.example/' || r.doc_id AS url, r.lang AS publisher "
            f"FROM r JOIN lead l ON l.norm = {norm('r.title')} WHERE r.doc_id <> l.leader"
        ),
        "paper_dedup": PAPERS,
        "conflict_split": CONFLICTS,
        "link_pages_to_docs": LINK + "SELECT page_id, is_event, CASE WHEN y IS NOT NULL AND NOT is_event THEN y::VARCHAR ELSE 'none' END AS paper_id, CASE WHEN NOT is_event THEN coalesce(score / 100, 0.0) ELSE 0.0 END AS link_score FROM linked",
        "unlinked_pages": LINK + "SELECT page_id, is_event FROM linked WHERE is_event OR y IS NULL",
        "mentions_per_doc": LINK + "SELECT y::VARCHAR AS paper_id, count(*) AS n_mentions, min(page_id) AS first_page FROM linked WHERE y IS NOT NULL AND NOT is_event GROUP BY y",
        "review_band": BAND,
        "verdict_removal": (
            "WITH d AS (SELECT doc_id, source, doc_id // 100 AS g FROM documents), x AS (SELECT d.*, count(*) OVER (PARTITION BY source, g) AS n, min(doc_id) OVER (PARTITION BY source, g) AS keep FROM d JOIN labels USING (doc_id) WHERE toxic = 1) "
            "SELECT source, doc_id FROM d WHERE doc_id NOT IN (SELECT doc_id FROM x WHERE n >= 2 AND doc_id <> keep)"
        ),
        "page_main_text": (
            f"WITH a AS (SELECT page_id, url, {_plain(ARTICLE)} AS c, {squeeze(DECODED.format(x=PAGE_TITLE))} AS page_title FROM pages) "
            "SELECT page_id, 'article_or_main' AS method, CASE WHEN length(c) >= 1800 THEN 'full' WHEN length(c) >= 300 THEN 'partial' ELSE 'unavailable' END AS content_status, md5(c) AS content_md5, length(c) AS n_chars, page_title, url AS resolved_url FROM a"
        ),
        "enriched_papers": (
            f"WITH {RECORDS}, a AS (SELECT doc_id, title AS t1, {norm('title')} <> '' AS ok, {squeeze("title || ' ' || lang")} AS t2, {squeeze("'Results' || title || ' ' || body")} AS t3, {_plain(squeeze("title || ' ' || body || ' ' || body"))} AS t4 FROM r), "
            "b AS (SELECT doc_id, t1, unnest([2, 3, 4]) AS pos, unnest([t2, t3, t4]) AS t, unnest(['pmc_bioc', 'jats_xml', 'publisher_html']) AS m FROM a WHERE ok), "
            "c AS (SELECT *, max(length(t)) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM b WHERE length(t) >= 400), "
            "d AS (SELECT * FROM c WHERE before IS NULL OR greatest(before, length(t1)) < 6000 QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length(t) DESC, pos) = 1), "
            f"e AS (SELECT doc_id, pos, m, {cut('t', fixed.PAPER_MAX_CHARS)} AS x FROM d WHERE length(t) > length(t1)) "
            "SELECT a.doc_id::VARCHAR AS paper_id, coalesce(m, CASE WHEN t1 <> '' THEN 'abstract_api' ELSE 'metadata_only' END) AS full_text_method, coalesce('https://c.example/' || pos, '') AS full_text_url, md5(coalesce(x, '')) AS text_md5, length(coalesce(x, '')) AS n_chars FROM a LEFT JOIN e USING (doc_id)"
        ),
        "page_dense_text": (
            f"WITH a AS (SELECT page_id, string_split(regexp_replace({_marked('html')}, '<[^>]+>', ' ', 'g'), chr(1)) AS l FROM pages), "
            "b AS (SELECT page_id, unnest(range(len(l))) AS i, unnest(l) AS t FROM a), "
            f"c AS (SELECT *, {_n_words('t')} - 3 * {_n_words(LINKED)} - 8 AS s FROM b WHERE {_n_words('t')} > 0), "
            "d AS (SELECT *, sum(s) OVER (PARTITION BY page_id ORDER BY i) AS upto FROM c), "
            "e AS (SELECT *, upto - min(upto - s) OVER (PARTITION BY page_id ORDER BY i) AS gain, min(upto - s) OVER (PARTITION BY page_id ORDER BY i) AS low FROM d), "
            "f AS (SELECT * FROM e WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY gain DESC, i) = 1), "
            "g AS (SELECT f.page_id, f.i AS hi, max(d.i) AS lo FROM f JOIN d ON d.page_id = f.page_id AND d.i <= f.i AND d.upto - d.s = f.low GROUP BY ALL), "
            "h AS (SELECT g.page_id, string_agg(d.t, ' ' ORDER BY d.i) AS t FROM g JOIN d ON d.page_id = g.page_id AND d.i BETWEEN g.lo AND g.hi GROUP BY ALL), "
            f"k AS (SELECT page_id, {_plain(squeeze(DECODED.format(x=TRANSLATED)))} AS c FROM h) "
            "SELECT page_id, CASE WHEN c IS NULL THEN 'none' ELSE 'text_density' END AS method, md5(coalesce(c, '')) AS content_md5, length(coalesce(c, '')) AS n_chars FROM pages LEFT JOIN k USING (page_id)"
        ),
        "page_contexts": f"SELECT page_id, sha256(t) AS content_hash, length(t) AS n_chars FROM (SELECT page_id, {VISIBLE} AS t FROM pages) WHERE length(t) >= 200",
        "page_links": (
            f"WITH a AS (SELECT page_id, regexp_extract_all(html, '{link_anchor}', 1) AS h, regexp_extract_all(html, '{link_anchor}', 2) AS t FROM pages), "
            f"b AS (SELECT page_id, unnest(range(len(h))) AS pos, unnest(h) AS h, {squeeze(DECODED.format(x='unnest(t)'))} AS link_title FROM a), "
            f"c AS (SELECT *, unnest({terms}) AS term FROM b) SELECT page_id, pos, term, link_title, CASE WHEN starts_with(h, '/') THEN 'https://site.example' || h ELSE h END AS link_url FROM c WHERE contains(lower(link_title), term)"
        ),
        "candidate_rank": (
            "WITH a AS (SELECT page_id, regexp_extract_all(html, 'href=\"([^\"]+)\"', 1) AS h FROM pages), b AS (SELECT page_id, unnest(range(len(h))) AS pos, unnest(h) AS url FROM a), "
            "c AS (SELECT page_id, url, min(pos) AS pos FROM b GROUP BY ALL), d AS (SELECT page_id, url, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS rank FROM c) SELECT page_id, rank, url FROM d WHERE rank <= 12"
        ),
        "paper_candidates": (
            "WITH a AS (SELECT doc_id, [CASE WHEN doc_id % 3 = 0 THEN 'europe_pmc_xml' END, CASE WHEN doc_id % 3 = 0 THEN 'pmc_bioc' END, 'crossref_link', CASE WHEN doc_id % 2 = 0 THEN 'open_access_pdf' END, 'europe_pmc_link', 'europe_pmc_link', CASE WHEN doc_id % 5 <> 0 THEN 'doi_landing' END, 'source_landing'] AS ms, "
            "['https://www.ebi.ac.uk/europepmc/webservices/rest/PMC' || doc_id || '/fullTextXML', 'https://www.ncbi.nlm.nih.gov/research/bionlp/RESTful/pmcoa.cgi/BioC_json/PMC' || doc_id || '/unicode', 'https://l.example/' || lang, 'https://l.example/' || source, 'https://l.example/' || source, 'https://l.example/' || lang, 'https://doi.org/10.1/' || doc_id, 'https://x.example/' || doc_id] AS us FROM documents), "
            "b AS (SELECT doc_id, unnest(range(8)) AS i, unnest(ms) AS method, unnest(us) AS url FROM a), c AS (SELECT *, row_number() OVER (PARTITION BY doc_id, url ORDER BY i) AS k FROM b WHERE method IS NOT NULL) "
            "SELECT doc_id::VARCHAR AS paper_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS pos, method, url FROM c WHERE k = 1"
        ),
        "best_turns": (
            "WITH a AS (SELECT conv_id, turn, text, length(text) AS n, role = 'assistant' AND length(text) >= 100 AND turn > 0 AS ok FROM conversations), "
            "b AS (SELECT *, max(CASE WHEN ok OR turn = 0 THEN n END) OVER w AS best, coalesce(bool_or(ok) OVER w, false) AS got FROM a WINDOW w AS (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), "
            "c AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY n DESC, turn) AS rn FROM b WHERE (ok OR turn = 0) AND NOT (got AND coalesce(best, 0) >= 400)) SELECT conv_id, turn, md5(text) AS text_md5 FROM c WHERE rn = 1"
        ),
        "budgeted_attach": (
            f"WITH {RECORDS}, a AS (SELECT r.doc_id, title, {squeeze('text')} AS full_, row_number() OVER (PARTITION BY source ORDER BY r.doc_id) AS k, coalesce(quality = 1, false) AS good FROM r LEFT JOIN labels USING (doc_id)), "
            "b AS (SELECT *, k <= 18 AND good AND length(full_) > length(title) AS longer FROM a) SELECT doc_id, CASE WHEN k > 18 THEN 'not_attempted_budget' WHEN longer THEN 'label' WHEN title <> '' THEN 'abstract_api' ELSE 'metadata_only' END AS full_text_method, "
            f"CASE WHEN longer THEN 'E2' WHEN title <> '' THEN 'E1' ELSE 'E0' END AS evidence_level, CASE WHEN longer THEN length({cut('full_', 18000)}) ELSE 0 END AS n_chars FROM b"
        ),
        "boilerplate_removed": f"WITH a AS (SELECT doc_id, {_plain('CASE WHEN doc_id % 4 = 0 THEN chr(86) || chr(105) || chr(101) || chr(119) || ' + repr(' full coverage - ') + ' || text || ' + repr(', by Google News.') + ' ELSE text END')} AS t FROM documents) SELECT doc_id, md5(t) AS text_md5, length(t) AS n_chars FROM a",
        "strip_tags_pages": f"WITH a AS (SELECT page_id, {squeeze(DECODED.format(x=STRIPPED))} AS t FROM pages) SELECT page_id, md5(t) AS text_md5, length(t) AS n_chars FROM a",
        "evidence_sentences": f"WITH {RECORDS}, e AS (SELECT doc_id, {sentences('body')} AS s FROM r), x AS (SELECT doc_id, unnest(range(1, len(s) + 1)) AS pos, unnest(s) AS text FROM e) SELECT doc_id, pos, 'A' || pos AS evidence_id, text FROM x",
        "fallback_five": f"{FALLBACK} SELECT doc_id, kind, " + ", ".join(f"CASE WHEN kind = 'review' THEN {v} ELSE {r} END AS e{i}" for i, (r, v) in enumerate(zip(RESEARCH, REVIEW), 1)) + " FROM e WHERE len(ev) > 0",
        "fallback_news_five": NEWS_FIVE,
        "five_field_summaries": _summary(),
        "task_payloads": f"WITH {RECORDS}, e AS (SELECT *, {sentences('body')} AS s FROM r) SELECT doc_id::VARCHAR AS paper_id, title, CASE WHEN body <> '' THEN 'abstract_only' ELSE 'metadata_only' END AS evidence_scope, len(s) AS n_evidence, coalesce(s[1], '') AS first_text FROM e",
        "numbers_and_dois": f"WITH a AS (SELECT doc_id, {WHOLE} AS w FROM documents) SELECT doc_id, array_to_string({_numbers('w')}, '|') AS numbers, CASE WHEN doc_id % 7 = 0 THEN '10.1234/ab.' || doc_id ELSE 'none' END AS doi FROM a",
        "number_preservation": NUMBERS_KEPT,
        "first_valid_answer": (
            "WITH a AS (SELECT conv_id, turn, text, CASE WHEN turn % 4 = 1 THEN 2 ELSE 1 END AS p FROM conversations WHERE role = 'assistant'), b AS (SELECT *, row_number() OVER (PARTITION BY conv_id, p ORDER BY turn) AS m FROM a), "
            "c AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY p, m) AS k FROM b WHERE m <= 3 AND length(text) >= 150), d AS (SELECT DISTINCT conv_id FROM conversations) "
            "SELECT conv_id, CASE WHEN text IS NULL THEN 'fallback_source_extract' ELSE 'passed' END AS status, CASE p WHEN 1 THEN 'alpha' WHEN 2 THEN 'beta' ELSE '' END AS provider, coalesce('m' || turn, '') AS model, md5(coalesce(text, 'no answer')) AS payload_md5 FROM d LEFT JOIN (SELECT * FROM c WHERE k = 1) USING (conv_id)"
        ),
        "attempts_best": (
            "WITH a AS (SELECT *, list_position(['click', 'view', 'purchase'], event_type) AS p FROM events), b AS (SELECT *, row_number() OVER (PARTITION BY user_id, p ORDER BY event_id) AS m FROM a WHERE p IS NOT NULL AND p > 0), "
            "c AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY p, m) AS k FROM b WHERE m <= 3), w AS (SELECT user_id, min(k) AS kw, count(*) AS n FROM c WHERE value > 60 GROUP BY 1), n AS (SELECT user_id, count(*) AS n FROM c GROUP BY 1) "
            "SELECT n.user_id, c.event_type AS provider, c.event_id::VARCHAR AS model, c.props AS payload, coalesce(w.kw - 1, n.n) AS failed_before FROM n LEFT JOIN w ON w.user_id = n.user_id LEFT JOIN c ON c.user_id = w.user_id AND c.k = w.kw"
        ),
        "json_recovery": "SELECT event_id, CASE WHEN event_id % 4 = 3 THEN -1 ELSE regexp_extract(props, '\"k\": (\\d+)', 1)::BIGINT END AS k FROM events",
        "glossary_protect": f"WITH {RECORDS}, a AS (SELECT doc_id, {_glossary('body')} AS p FROM r) SELECT doc_id, md5(p) AS protected_md5, md5({_restored('upper(replace(p, chr(223), chr(83) || chr(83)))')}) AS restored_md5 FROM a",
        "glossary_repair": (
            f"WITH {RECORDS}, a AS (SELECT doc_id, '汉坦病毒 , ' || title || ' ; 汉坦病毒 。' AS x FROM r), "
            "b AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(x, 'the', '该', 'gi'), 'of the', '的该', 'gi'), 'pour', '为了', 'gi'), 'nicht', '不$1', 'gi'), 'para la', '为此', 'gi') AS x FROM a), "
            f"c AS (SELECT doc_id, replace(replace(replace(replace(replace(x, ' ,', '，'), ',', '，'), ' ;', '；'), ';', '；'), ' :', '：') AS x FROM b) SELECT doc_id, {squeeze(chr(39).join(['regexp_replace(x, ', chr(92) + 's+([。！？；，])', ', ', chr(92) + '1', ', ', 'g', ')']))} AS repaired FROM c"
        ),
        "glossary_by_profile": BY_PROFILE,
        "glossary_repair_by_profile": REPAIRED_BY_PROFILE,
        "memory_routes": (
            f"WITH {RECORDS}, {MEMORY}, f AS (SELECT doc_id, CASE WHEN doc_id % 10 = 9 THEN repeat('汉坦病毒', 8) WHEN doc_id % 10 = 8 THEN '' ELSE title END AS src FROM r) "
            f"SELECT doc_id, 'title' AS field, CASE WHEN src = '' THEN 'empty_source' WHEN {_chinese('src')} THEN 'source_already_chinese' WHEN m.key IS NOT NULL THEN 'from_memory' ELSE 'unresolved' END AS route FROM f LEFT JOIN m ON m.key = {_memory_key(repr('title'), 'src')}"
        ),
        "field_resolution": f"WITH {RECORDS}, {MEMORY}, {RESOLVED} SELECT doc_id, field, status, translated FROM res",
        "record_translations": (
            f"WITH {RECORDS}, {MEMORY}, {RESOLVED} SELECT doc_id, coalesce(max(CASE WHEN field = 'title' AND translated <> '' THEN translated END), '{fixed.TITLE_UNAVAILABLE}') AS title_zh, "
            f"bool_or(field = 'title' AND translated <> '') AS title_translated, max(CASE WHEN field = 'source' THEN CASE WHEN translated <> '' THEN translated ELSE '{fixed.NEWS_NOT_REPORTED}' END END) AS source_zh FROM res GROUP BY doc_id"
        ),
        "memory_upserts": (
            f"WITH {RECORDS}, {MEMORY}, {RESOLVED}, n AS (SELECT key, translated AS text, 2::BIGINT AS seq FROM res WHERE status LIKE 'passed_%' UNION ALL SELECT key, text, seq FROM m), "
            "x AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY seq DESC, text DESC) AS rn FROM n) SELECT key, text, seq FROM x WHERE rn = 1"
        ),
        "inverted_index_rebuild": f"WITH a AS (SELECT doc_id, {squeeze('text')} AS t FROM documents) SELECT doc_id, md5(t) AS text_md5, length(t) AS n_chars FROM a",
        "ordered_distinct": (
            f"WITH {RECORDS}, a AS (SELECT doc_id, list_transform(string_split(text, ' '), lambda v: {squeeze('v')}) AS w FROM r), b AS (SELECT doc_id, unnest(range(len(w))) AS p, unnest(w) AS w FROM a), "
            "c AS (SELECT doc_id, min(p) AS p, arg_min(w, p) AS w FROM b WHERE w <> '' GROUP BY doc_id, replace(lower(w), 'ß', 'ss')), d AS (SELECT doc_id, string_agg(w, '|' ORDER BY p) AS words FROM c GROUP BY doc_id) SELECT r.doc_id, coalesce(words, '') AS words FROM r LEFT JOIN d USING (doc_id)"
        ),
        "cjk_share": f"WITH {RECORDS}, a AS (SELECT doc_id, title || repeat('汉坦病毒', doc_id % 7) AS v FROM r) SELECT doc_id, len(regexp_extract_all(v, '[一-鿿]')) AS n_cjk, {_chinese('v')} AS is_chinese FROM a",
        "history_upsert": (
            "WITH a AS (SELECT o_orderpriority AS profile_id, strftime(o_orderdate, '%Y-%m-%d') AS issue_date, o_orderkey % 2 AS odd, count(*) AS n FROM orders GROUP BY ALL), "
            "b AS (SELECT *, row_number() OVER (PARTITION BY profile_id, issue_date ORDER BY odd DESC) AS k FROM a), c AS (SELECT profile_id, issue_date, n, CASE WHEN odd = 1 THEN 'new' ELSE 'old' END AS run, row_number() OVER (PARTITION BY profile_id ORDER BY issue_date DESC) AS pos FROM b WHERE k = 1) SELECT * FROM c WHERE pos <= 365"
        ),
        "issue_snapshots": (
            "WITH a AS (SELECT o_orderpriority AS profile_id, strftime(o_orderdate, '%Y') AS issue_date, o_orderkey, 1::BIGINT AS run FROM orders), b AS (SELECT profile_id, issue_date, o_orderkey, 2::BIGINT AS run FROM a WHERE profile_id < '3' AND o_orderkey % 2 = 0), "
            "c AS (SELECT * FROM b UNION ALL SELECT * FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.profile_id = a.profile_id AND b.issue_date = a.issue_date)) SELECT c.* FROM c JOIN (SELECT profile_id, max(issue_date) AS issue_date FROM c GROUP BY 1) USING (profile_id, issue_date)"
        ),
        "audit_lines": "SELECT doc_id, source, quality, toxic FROM labels JOIN documents USING (doc_id) WHERE toxic IN (0, 1)",
        "capped_batches": (
            "WITH a AS (SELECT l_suppkey, l_partkey, min(l_orderkey) AS f FROM lineitem GROUP BY ALL), b AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY f, l_partkey) AS k FROM a), "
            "c AS (SELECT l_partkey, min((f, l_suppkey)) AS s FROM b WHERE k <= 2 GROUP BY 1), d AS (SELECT l_partkey, row_number() OVER (ORDER BY s, l_partkey) AS pos FROM c) SELECT l_partkey, pos, (pos - 1) // 100 AS batch FROM d WHERE pos <= 250"
        ),
        "sliding_issue_counts": EVENT_WINDOWS,
        "sliding_issue_counts_stream": EVENT_WINDOWS,
        "first_seen": "SELECT user_id, event_type, arg_min(event_id, ts) AS event_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS ts FROM events GROUP BY ALL",
        "first_seen_stream": "SELECT DISTINCT user_id, event_type FROM events",
        "event_snapshot_stream": "SELECT user_id, event_type, event_id, value, props FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) = 1",
        "union_sources": (
            f"WITH {RECORDS} SELECT 'documents' AS source, title, 'doc:' || doc_id AS url, source AS publisher, lang AS language FROM r UNION ALL SELECT 'pages', {PAGE_TITLE}, url, '', '' FROM pages UNION ALL "
            f"SELECT 'conversations', {squeeze('text')}, 'conv:' || conv_id || ':' || turn, role, '' FROM conversations"
        ),
        "feed_selection": (
            f"WITH {RECORDS}, x AS (SELECT lang, doc_id, CASE WHEN doc_id % 2 = 0 THEN '译' || title ELSE title END AS title, CASE WHEN doc_id % 3 = 0 THEN 'https://doi.org/10.1/' || doc_id ELSE 'u:' || doc_id END AS pl, "
            "CASE WHEN doc_id % 3 = 0 OR true THEN CASE WHEN doc_id % 5 = 0 THEN 'r:' || doc_id ELSE 'u:' || doc_id END END AS nl, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS a, row_number() OVER (PARTITION BY lang ORDER BY doc_id DESC) AS b FROM r) "
            "SELECT lang AS profile_id, 'paper' AS kind, a AS rank, title, pl AS link, '' AS summary FROM x WHERE a <= 10 UNION ALL SELECT lang, 'news', b, title, nl, '' FROM x WHERE b <= 10"
        ),
        "dictionary_split": (
            f"WITH {RECORDS}, a AS (SELECT doc_id, list_concat(string_split(lower(title), ' '), string_split(lower(title), ' ')[4:]) AS w FROM r), "
            "b AS (SELECT doc_id, unnest(range(len(w))) AS p, unnest(w) AS w FROM a), c AS (SELECT doc_id, min(p) AS p, arg_min(w, p) AS w FROM b WHERE w <> '' GROUP BY doc_id, replace(w, 'ß', 'ss')), "
            "d AS (SELECT doc_id, list(w ORDER BY p) AS w FROM c GROUP BY doc_id), e AS (SELECT r.doc_id, CASE WHEN r.doc_id % 2 = 0 THEN '汉坦' || r.doc_id ELSE '' END AS zh, CASE WHEN w IS NULL AND r.doc_id % 2 <> 0 THEN ['d' || r.doc_id] ELSE coalesce(w, []) END AS w FROM r LEFT JOIN d USING (doc_id)) "
            "SELECT 'd' || doc_id AS profile_id, array_to_string(w, '|') AS english_terms, zh AS chinese_terms, array_to_string(w[1:5], '|') AS clinical_terms FROM e"
        ),
        "profile_overlay": "SELECT p_partkey::VARCHAR AS profile_id, CASE WHEN p_partkey % 4 = 0 THEN 'new' ELSE p_name END AS english_terms FROM part",
        "europe_pmc_feed": _feed("'10.1/e' || doc_id", "title", "body", "'B A|' || lang", "source", FEED_DATE, "'https://europepmc.org/article/MED/' || doc_id"),
        "crossref_feed": _feed("'10.1/c' || doc_id", "title", "body", "'Ada ' || lang", "source", FEED_DATE, "'https://doi.org/10.1/C' || doc_id"),
        "semantic_scholar_feed": _feed("'10.1/s' || doc_id", "title", "body", "lang", "source", FEED_DATE, "'https://s.example/' || doc_id"),
        "openalex_feed": _feed("'10.1/o' || doc_id", "title", "body", "lang", "source", FEED_DATE, "'https://o.example/W' || doc_id"),
        "preprint_feed": _feed("'10.1/p' || doc_id", "title", "body", "'A|B|' || lang", "'biorxiv'", FEED_DATE, "'https://www.biorxiv.org/content/10.1/p' || doc_id || 'v2'"),
        "pubmed_feed": _feed("'10.1/m' || doc_id", "trim('A b ' || title)", "trim('AIM: xy ' || body)", "'Ada ' || lang || '|Team'", "source", "'2024-' || lpad((doc_id % 12 + 1)::VARCHAR, 2, '0') || '-05'", "'https://pubmed.ncbi.nlm.nih.gov/' || doc_id || '/'"),
        "rss_feed": _news_feed("rss", "https://n.example/", "body", "source", "'en'"),
        "atom_feed": _news_feed("atom", "https://a.example/", "body", "source", "'en'"),
        "issue_metrics": (
            f"WITH {RECORDS}, k AS (SELECT r.*, {KIND} AS kind, coalesce(quality = 1, false) AS good, doc_id % 3 = 0 AS found, doc_id % 3 = 0 AND n_chars > 1000 AS kept FROM r LEFT JOIN labels USING (doc_id)) "
            "SELECT source AS profile_id, count(*) AS raw_papers, count(*) FILTER (good) AS papers, count(*) FILTER (good AND kind = 'research') AS research, count(*) FILTER (good AND kind = 'review') AS reviews, "
            "count(*) FILTER (found) AS raw_news, count(*) FILTER (kept) AS news, count(*) FILTER (good AND NOT found AND doc_id % 2 = 0) + count(*) FILTER (kept AND lang = 'en') AS translated FROM k GROUP BY source"
        ),
        "answer_validity": (
            "WITH a AS (SELECT o_orderkey, [CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice::VARCHAR END, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey::VARCHAR ELSE '  ' END, o_orderstatus, CASE WHEN o_orderkey % 5 < 3 THEN o_orderpriority END, CASE WHEN o_orderkey % 7 = 1 THEN 'x' END] AS f FROM orders), "
            "b AS (SELECT o_orderkey, len(list_filter(f, lambda x: trim(x) <> ''))::BIGINT AS n_filled FROM a) SELECT o_orderkey, n_filled, n_filled >= 3 AS valid FROM b"
        ),
        "gdelt_feed": _news_feed("GDELT DOC 2.0", "https://g.example/", "''", "source", "lang"),
        "reliefweb_feed": _news_feed("ReliefWeb", "https://r.example/", "body", "source || ', ' || lang", "'en'"),
        "section_buckets": (
            f"WITH {RECORDS}, a AS (SELECT doc_id, 'abstract' AS bucket, title AS t FROM r UNION ALL SELECT doc_id, 'methods', {squeeze('concat(chr(83), ' + repr('tudy design') + ', body)')} FROM r UNION ALL SELECT doc_id, 'results', 'Main findings' || title FROM r UNION ALL SELECT doc_id, 'other', 'Notes' || lang FROM r) "
            "SELECT doc_id, bucket, md5(t) AS text_md5 FROM a WHERE t <> ''"
        ),
        "passage_texts": f"WITH {RECORDS}, a AS (SELECT doc_id, array_to_string({sentences('body')}, ' ') AS t FROM r) SELECT doc_id, md5(t) AS text_md5, length(t) AS n_chars FROM a",
        "linked_data_pages": (
            f"WITH {RECORDS}, a AS (SELECT doc_id, title, body, CASE WHEN doc_id % 3 = 0 THEN CASE WHEN length(body) > 1 THEN body ELSE 'x' END WHEN doc_id % 3 = 1 THEN 'about ' || doc_id ELSE title END AS c FROM r), b AS (SELECT *, {_plain('c')} AS p FROM a) "
            "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN CASE WHEN length(body) > 1 THEN 'jsonld_articleBody' ELSE 'article_or_main' END WHEN doc_id % 3 = 1 THEN 'meta_description' WHEN title = '' THEN 'none' ELSE 'article_or_main' END AS method, md5(p) AS content_md5, "
            "CASE WHEN doc_id % 3 = 0 THEN title WHEN doc_id % 3 = 1 THEN 'T ' || doc_id ELSE '' END AS content_title, CASE WHEN doc_id % 3 = 0 THEN 'https://h.example/c/' || doc_id ELSE 'https://h.example/a/b' END AS resolved_url FROM b"
        ),
    }
