"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from . import quality, secrets

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "list_filter(regexp_split_to_array(coalesce({}, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"

OP1 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOWER.format('text'))} AS w FROM documents),
s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
         ELSE list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4]) END)) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l UNION SELECT doc_id, doc_id FROM documents),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.c AS component_id,
  (SELECT count(*) FROM e WHERE e.a = d.doc_id AND e.b <> d.doc_id)::BIGINT AS n_links
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS c FROM r GROUP BY a) c ON c.a = d.doc_id
"""



def _op3() -> str:
    """Base kinds with their least lengths inside the expressions: a maximal run of a class has its length or none of it."""
    low = _LOWER.format("text")
    kinds = [("assign", low, "(password|passwd|secret|token|api_?key)[\"'']?\\x20*[:=]\\x20*[\"'']?([a-z0-9+/_.=-]+)", 2, 6),
             ("access", "text", "AKIA[A-Z0-9]{16,}", 0, 20), ("hex", "text", "[0-9a-f]{24,}", 0, 24)]
    kinds += [(r.kind, "text", r.pattern, r.group, r.least) for r in secrets.MORE]
    each = "\nUNION ALL\n".join(
        f"SELECT doc_id, text_id, '{kind}' AS kind, {k} AS ord, unnest(range(len(hit))) AS i, unnest(hit) AS m, unnest(grp) AS g, unnest(gap[:len(hit)]) AS gap, {least} AS least FROM ("
        f"SELECT doc_id, text_id, regexp_extract_all({of}, '{rx}') AS hit, regexp_extract_all({of}, '{rx}', {group}) AS grp, string_split_regex({of}, '{rx}') AS gap FROM d WHERE regexp_matches({of}, '{rx}'))"
        for k, (kind, of, rx, group, least) in enumerate(kinds))
    name = "concat_ws(':', kind, stop - length(m), stop)"
    return f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS text_id, coalesce(text, '') AS text FROM documents),
m AS ({each}),
p AS (SELECT *, (sum(length(gap) + length(m)) OVER (PARTITION BY text_id, kind ORDER BY i))::BIGINT AS stop FROM m),
s AS (SELECT text_id, count(*) FILTER (WHERE ord = 0) AS n_assign, count(*) FILTER (WHERE ord = 1) AS n_access, count(*) FILTER (WHERE ord = 2) AS n_hex,
    string_agg({name}, ',' ORDER BY stop - length(m), ord) FILTER (WHERE ord < 3) AS base, string_agg({name}, ',' ORDER BY stop - length(m), ord) AS spans FROM p WHERE length(g) >= least GROUP BY text_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN s USING (text_id)
"""


OP4 = f"""
WITH l AS (
  SELECT doc_id, pos, line, len({_WORDS.format('line')}) AS w FROM (
    SELECT doc_id, unnest(range(len(x))) AS pos, unnest(x) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents))),
q AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS seq, sum(w) OVER (PARTITION BY doc_id ORDER BY pos) AS upto FROM l WHERE w > 0),
span AS (
  SELECT a.doc_id, a.seq AS s, min(b.seq) AS e, 0 AS side FROM q a JOIN q b ON a.doc_id = b.doc_id AND b.seq >= a.seq AND b.upto - a.upto + a.w >= 50 GROUP BY ALL
  UNION ALL
  SELECT b.doc_id, max(a.seq), b.seq, 1 FROM q a JOIN q b ON a.doc_id = b.doc_id AND b.seq >= a.seq AND b.upto - a.upto + a.w >= 50 GROUP BY b.doc_id, b.seq),
run AS (SELECT p.doc_id, p.s, p.e, p.side, list(q.line ORDER BY q.seq) AS x FROM span p JOIN q ON q.doc_id = p.doc_id AND q.seq BETWEEN p.s AND p.e GROUP BY ALL),
later AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY side, x ORDER BY doc_id, s) AS k FROM run) WHERE k > 1),
gone AS (SELECT DISTINCT q.doc_id, q.pos FROM later JOIN q ON q.doc_id = later.doc_id AND q.seq BETWEEN later.s AND later.e),
kept AS (SELECT l.doc_id, count(*) AS n, string_agg(l.line, chr(10) ORDER BY l.pos) AS text FROM l ANTI JOIN gone ON l.doc_id = gone.doc_id AND l.pos = gone.pos GROUP BY l.doc_id)
SELECT d.doc_id, len(string_split(d.text, chr(10)))::BIGINT AS n_lines,
  CASE WHEN coalesce(kept.text, '') = '' THEN 0 ELSE kept.n END::BIGINT AS n_left,
  strlen(coalesce(kept.text, ''))::BIGINT AS bytes_left, md5(coalesce(kept.text, '')) AS text_md5
FROM documents d LEFT JOIN kept USING (doc_id)
"""


def _op5() -> str:
    rules = []
    for measure, least, most, words in quality.RULES.values():
        top, under = measure.split(" / ")
        value = f"({top}::DOUBLE / {under})"
        bounds = ([f"{value} >= {least!r}"] if least is not None else []) + ([f"{value} <= {most!r}"] if most is not None else [])
        rules.append(f"(n_words < {words} OR {under} = 0 OR ({' AND '.join(bounds)}))")
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(quality.STOP_WORDS))
    return f"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS.format('text')} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM documents),
win AS (SELECT doc_id, p, w[p:p + 7] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS p FROM w WHERE len(w) >= 8)),
cov AS (SELECT doc_id, count(DISTINCT q) AS n FROM (
    SELECT doc_id, unnest(range(p, p + 8)) AS q FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1) GROUP BY doc_id),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l) AS n_lines,
    len(list_filter(l, lambda x: regexp_matches(x, '^\\s*[-*•] '))) AS n_bullet_lines,
    len(list_filter(w, lambda x: lower(x) IN ({stop}))) AS n_stop_words,
    coalesce(cov.n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN cov USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {' AND '.join(rules)} AS kept FROM b
"""


_ITEM = f"list_filter(regexp_split_to_array({_LOWER.format('coalesce(text, ' + chr(39) * 2 + ')')}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
OP7 = f"""
WITH d AS (SELECT doc_id, {_ITEM} AS w FROM documents),
b AS (SELECT item_id, {_ITEM} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 13 THEN [w] ELSE list_transform(range(1, len(w) - 11), lambda i: w[i:i + 12]) END) AS g FROM b),
k AS (SELECT DISTINCT len(g) AS k FROM win),
hit AS (SELECT d.doc_id, d.p, d.k, win.item_id FROM (
    SELECT doc_id, p, k, w[p:p + k - 1] AS g FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, k WHERE len(w) >= k)) d JOIN win ON win.g = d.g),
n AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM hit) GROUP BY doc_id),
i AS (SELECT doc_id, list(DISTINCT item_id::VARCHAR ORDER BY item_id::VARCHAR) AS i FROM hit GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n.n, 0)::BIGINT AS n_hit, len(coalesce(i.i, []))::BIGINT AS n_items,
  sha256(coalesce(array_to_string(i.i, ','), '')) AS items_sha256,
  coalesce(n.n, 0) > 0 AND 20 * coalesce(n.n, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN i USING (doc_id)
"""

OP8 = r"""
WITH p AS (SELECT page_id, url, DATE '2024-01-01' + ((page_id * 7) % 366)::INT AS fetched,
    nullif(regexp_replace(regexp_replace(regexp_extract(lower(trim(url)), '^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:@]+)', 1), '\.$', ''), '^www\.', ''), '') AS host,
    list_filter(string_split(regexp_extract(trim(url), '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//[^/?#]*(/[^?#]*)', 1), '/'), lambda x: x <> '') AS path FROM pages),
h AS (SELECT DISTINCT host AS h, ('0x' || substr(md5(host), 1, 4))::INT AS n FROM p WHERE host IS NOT NULL),
d AS (SELECT h, n, DATE '2024-01-01' + (n % 300) AS day FROM h),
list0 AS (
  SELECT h AS entry, day AS since, 'block' AS action FROM d WHERE n % 3 = 0
  UNION ALL SELECT h, day + 90, 'remove' FROM d WHERE n % 6 = 0
  UNION ALL SELECT h || '/en', day, 'allow' FROM d WHERE n % 5 = 0
  UNION ALL SELECT regexp_replace(h, '^[^.]+\.', ''), day, 'block' FROM d WHERE n % 7 = 0),
list1 AS (SELECT entry, since, arg_min(action, CASE action WHEN 'block' THEN 0 WHEN 'allow' THEN 1 ELSE 2 END) AS action FROM list0 GROUP BY entry, since),
iv AS (SELECT *, lead(since) OVER (PARTITION BY entry ORDER BY since) AS until FROM list1),
k AS (SELECT page_id, fetched, unnest(list_concat(
    list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: array_to_string(string_split(host, '.')[i:], '.')),
    list_transform(range(1, len(path) + 1), lambda i: host || '/' || array_to_string(path[1:i], '/')))) AS entry FROM p WHERE host IS NOT NULL),
a AS (SELECT k.page_id, iv.* FROM k JOIN iv ON iv.entry = k.entry AND iv.since <= k.fetched AND (iv.until IS NULL OR k.fetched < iv.until) WHERE action <> 'remove'),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY length(entry) DESC) AS r FROM a) WHERE r = 1)
SELECT p.page_id, p.fetched, coalesce(best.action, 'none') AS verdict, best.entry, best.since FROM p LEFT JOIN best USING (page_id)
"""

OP10 = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to FROM m
"""

#: CRC-32, bit by bit, of a time as decimal text
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(8 * length({0})), lambda i: ((ascii(substr({0}, (i // 8 + 1)::INT, 1)) >> (i % 8)::INT) & 1)::BIGINT)),
    lambda c, b: xor(c >> 1, (xor(c, b) & 1) * 3988292384)))"""
_SLOT = "(epoch_us({}) - ((epoch_us({}) % 21600000000) + 21600000000) % 21600000000) // 21600000000"

OP11 = f"""
WITH k AS (SELECT client_id, ts, coalesce(kind = 'error', false) AS err FROM clicks WHERE client_id IS NOT NULL AND ts IS NOT NULL),
g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY client_id ORDER BY ts) > INTERVAL 15 MINUTE THEN 1 ELSE 0 END AS brk FROM k),
n AS (SELECT *, sum(brk) OVER (PARTITION BY client_id ORDER BY ts) AS no FROM g),
e AS (SELECT client_id, no, min(ts) AS a, max(ts) AS z FROM n GROUP BY ALL),
c AS (SELECT client_id, {_SLOT.format('a', 'a')} AS f, {_SLOT.format('z', 'z')} AS t, {_CRC.format('epoch_us(a)::VARCHAR')} AS crc,
    (SELECT bool_or(err) FROM n WHERE n.client_id = e.client_id AND n.no = e.no AND n.ts = e.z) AS open FROM e),
l AS (SELECT sale_id, max(shipped_at) AS shipped FROM sale_lines GROUP BY sale_id),
s AS (SELECT sale_id, client_id, {_SLOT.format('sold_at', 'sold_at')} AS f, {_SLOT.format('z', 'z')} AS t, open FROM (
    SELECT sales.sale_id, client_id, sold_at, greatest(sold_at, shipped) AS z, coalesce(status = 'open', false) AS open FROM sales LEFT JOIN l ON l.sale_id = sales.sale_id
    WHERE client_id IS NOT NULL AND sold_at IS NOT NULL)),
p AS (SELECT s.sale_id, c.crc, CASE WHEN s.open AND c.open THEN NULL WHEN s.open THEN c.t WHEN c.open THEN s.t ELSE least(s.t, c.t) END - greatest(s.f, c.f) + 1 AS shared,
    sign(s.f - c.f) AS at_start, CASE WHEN s.open AND c.open THEN 0 WHEN s.open THEN 1 WHEN c.open THEN -1 ELSE sign(s.t - c.t) END AS at_end
    FROM s JOIN c ON s.client_id = c.client_id AND (s.f <= c.t OR c.open) AND (c.f <= s.t OR s.open))
SELECT sale_id, CASE WHEN at_start < 0 THEN CASE at_end WHEN -1 THEN 'overlaps' WHEN 0 THEN 'finished_by' ELSE 'contains' END
    WHEN at_start = 0 THEN CASE at_end WHEN -1 THEN 'starts' WHEN 0 THEN 'equals' ELSE 'started_by' END
    ELSE CASE at_end WHEN -1 THEN 'during' WHEN 0 THEN 'finishes' ELSE 'overlapped_by' END END AS relation,
  count(*)::BIGINT AS n_pairs, sum(shared)::BIGINT AS overlap_slots, sum(crc)::BIGINT AS sessions_crc FROM p GROUP BY 1, 2
"""

_TERMS = f"regexp_extract_all({_LOWER.format('text')}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, t, len(t) AS n FROM (SELECT doc_id, {_TERMS} AS t FROM documents) WHERE len(t) > 0),
b AS (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS t FROM benchmark),
a AS (SELECT DISTINCT q, unnest(t) AS term FROM b),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM a) GROUP BY ALL),
g AS (SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS l FROM d),
w AS (SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), g),
m AS (SELECT r, doc_id, 100 - 90 + (90 * n * nd) // l AS m FROM d, g),
s AS (SELECT a.q, m.doc_id, m.r, sum(w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * m.m)))::BIGINT AS score
  FROM a JOIN tf USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST, r) AS rank FROM s WHERE score > 0)
SELECT b.item_id, k.rank::INT AS rank, k.doc_id, k.score FROM k JOIN b USING (q) WHERE k.rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_ngram_jaccard_join": OP1, "op3_secret_scan": _op3(), "op4_line_dedup": OP4, "op5_quality_rules": _op5(), "op7_decontamination": OP7,
        "op8_url_filter": OP8, "op10_warc": OP10, "op11_interval_overlap_join": OP11, "op12_ranked_lexical_search": OP12,
    }
