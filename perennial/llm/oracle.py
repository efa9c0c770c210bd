"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_ITQ = """
WITH RECURSIVE usable AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
    WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM usable a JOIN usable b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
    WHERE list_inner_product(a.e, b.e)
        / (sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))) >= 0.93),
reach AS (
    SELECT vec_id AS node, vec_id AS root FROM embeddings
    UNION SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.node),
least AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node),
degree AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON node = vec_id LEFT JOIN degree ON a = vec_id
"""

_NEAR = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w FROM documents),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct([array_to_string(w[i:i+3], ' ') FOR i IN range(1, len(w) - 2)]) END AS s
    FROM words),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (
    SELECT doc_id AS node, doc_id AS root FROM documents
    UNION SELECT links.b, reach.root FROM reach JOIN links ON links.a = reach.node),
least AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN least ON node = doc_id
"""


def _crc_table() -> str:
    """The 256 remainders of the reflected CRC-32 polynomial."""
    found = []
    for value in range(256):
        for _ in range(8):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        found.append(value)
    return f"{found}::BIGINT[]"


def _draw(text: str) -> str:
    """Sixty bits of the digest of a seeded text."""
    return f"('0x' || substr(md5('interleave:' || {text}), 1, 15))::BIGINT"


_SHARDS = f"""
WITH drawn AS (
    SELECT doc_id, source, (strlen(coalesce(text, '')) + 8)::BIGINT AS size,
        regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS bytes,
        {_draw("coalesce(doc_id::VARCHAR, '')")} AS draw
    FROM documents),
summed AS (
    SELECT doc_id, source, size, draw,
        xor(list_reduce(
            list_prepend(4294967295, list_transform(bytes, lambda b: ('0x' || b)::BIGINT)),
            lambda c, b: xor(c >> 8, list_extract({_crc_table()}, (xor(c, b) & 255) + 1))), 4294967295) AS text_crc32
    FROM drawn),
ranked AS (
    SELECT *, (row_number() OVER (PARTITION BY source ORDER BY draw, doc_id NULLS FIRST) - 1)::DOUBLE AS rank,
        (count(*) OVER (PARTITION BY source))::DOUBLE AS of,
        ({_draw("CASE WHEN source IS NULL THEN '-' ELSE '=' || source END")} >> 30)::DOUBLE / 1073741824.0 AS begin
    FROM summed),
placed AS (
    SELECT *, row_number() OVER (ORDER BY (rank + begin) / of, source NULLS FIRST, rank) - 1 AS place,
        count(*) OVER () AS total
    FROM ranked)
SELECT doc_id, size, text_crc32, 'rows' AS law, (place * 24 // total)::INTEGER AS shard,
    (place - ((place * 24 // total) * total + 23) // 24)::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM placed
"""


_COLLOCATIONS = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
        unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
grams AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
    FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words), (SELECT unnest(range(1, 5)) AS k)
    WHERE i + k - 1 <= len(w)),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
frequent AS (SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM counts WHERE f >= 30),
inside AS (
    SELECT lang, f, array_to_string(w[i:i + s - 1], ' ') AS phrase
    FROM (SELECT *, unnest(range(2, k)) AS s FROM frequent WHERE k > 2), (SELECT unnest(range(1, 4)) AS i)
    WHERE i + s - 1 <= k),
holders AS (SELECT lang, phrase, max(f) AS most FROM inside GROUP BY lang, phrase),
kept AS (
    SELECT c.* FROM frequent c LEFT JOIN holders h ON h.lang = c.lang AND h.phrase = c.phrase
    WHERE k > 1 AND NOT coalesce(100 * most >= 80 * f, false)),
cuts AS (
    SELECT c.lang, c.phrase, c.f AS a, c.cut, x.f AS l, y.f AS r,
        (2000000::HUGEINT * c.f // (x.f + y.f))::BIGINT AS score
    FROM (SELECT *, unnest(range(1, k)) AS cut FROM kept) c
    JOIN frequent x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.cut], ' ')
    JOIN frequent y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.cut + 1:c.k], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def _closing(k: int) -> str:
    """One round that closes the gap of each source by the document nearest to it."""
    return f"""
found{k} AS (
    SELECT e.source, min_by(struct_pack(r := r.rank, s := r.size), (abs(r.size - e.gap), r.rank)) AS found
    FROM ends{k} e JOIN ranked r ON r.source IS NOT DISTINCT FROM e.source
    WHERE r.rank IS NOT NULL AND NOT coalesce(r.rank <= e.last, false) AND NOT list_contains(e.closing, r.rank)
      AND abs(r.size - e.gap) < e.gap
    GROUP BY e.source),
ends{k + 1} AS (
    SELECT e.source, e.last, e.gap - coalesce(f.found.s, 0) AS gap,
        CASE WHEN f.found IS NULL THEN e.closing ELSE list_append(e.closing, f.found.r) END AS closing
    FROM ends{k} e LEFT JOIN found{k} f ON f.source IS NOT DISTINCT FROM e.source),"""


_MIX = f"""
WITH docs AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::BIGINT AS size,
        (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 12))::BIGINT
            + 0.5::DOUBLE) / 281474976710656.0::DOUBLE AS u
    FROM documents),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
        ([5, 2, 1])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
    FROM docs GROUP BY source),
levels AS (
    SELECT *, source_size * 2::DOUBLE AS bound,
        (sum(source_size::DOUBLE) OVER () * 1.5::DOUBLE
            - coalesce(sum(source_size * 2::DOUBLE) OVER before, 0))
        / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
    FROM sources
    WINDOW before AS (ORDER BY source_size * 2::DOUBLE / weight, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
opened AS (
    SELECT (SELECT level FROM levels WHERE weight * level < bound
        ORDER BY bound / weight, source NULLS LAST LIMIT 1) AS level),
targets AS (
    SELECT l.source, l.source_size, least(l.bound, coalesce(l.weight * o.level, l.bound)) AS target
    FROM levels l, opened o),
counts AS (
    SELECT d.source, d.size, count(*) AS n, any_value(t.target) AS target, sqrt(sqrt(d.size::DOUBLE)) AS power
    FROM docs d JOIN targets t ON t.source IS NOT DISTINCT FROM d.source
    WHERE d.size > 0 GROUP BY d.source, d.size),
tried AS (
    SELECT *, (target - 2 * coalesce(sum((n * size)::DOUBLE) OVER (PARTITION BY source ORDER BY size DESC
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum((n * size)::DOUBLE * power) OVER (PARTITION BY source ORDER BY size DESC
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS factor
    FROM counts),
factors AS (SELECT source, max_by(factor, size) AS factor FROM tried WHERE factor * power <= 2 GROUP BY source),
expected AS (
    SELECT d.*, t.source_size, t.target,
        CASE WHEN size = 0 THEN 0 ELSE least(2, coalesce(f.factor * sqrt(sqrt(size::DOUBLE)), 2)) END::DOUBLE AS e
    FROM docs d JOIN targets t ON t.source IS NOT DISTINCT FROM d.source
    LEFT JOIN factors f ON f.source IS NOT DISTINCT FROM d.source),
odds AS (
    SELECT *, floor(e)::BIGINT AS certain,
        CASE WHEN e - floor(e) > 0
            THEN (u / (1 - u)) / ((e - floor(e)) / (1 - (e - floor(e)))) END AS odds
    FROM expected),
ranked AS (SELECT *, odds / (1 + odds) AS rank FROM odds),
wanted AS (SELECT source, any_value(target) - sum(certain * size) AS wanted FROM ranked GROUP BY source),
prefixes AS (
    SELECT r.source, r.rank, w.wanted, sum(r.size) OVER (PARTITION BY r.source ORDER BY r.rank) AS total
    FROM ranked r JOIN wanted w ON w.source IS NOT DISTINCT FROM r.source WHERE r.rank IS NOT NULL),
ends0 AS (
    SELECT w.source, max(p.rank) FILTER (p.total <= p.wanted AND p.wanted > 0) AS last,
        CASE WHEN any_value(w.wanted) > 0 THEN any_value(w.wanted)
            - coalesce(max(p.total) FILTER (p.total <= p.wanted), 0) END AS gap,
        []::DOUBLE[] AS closing
    FROM wanted w LEFT JOIN prefixes p ON p.source IS NOT DISTINCT FROM w.source GROUP BY w.source),
{_closing(0)}
{_closing(1)}
{_closing(2)}
copies AS (
    SELECT r.*, certain + (coalesce(r.rank <= e.last, false) OR coalesce(list_contains(e.closing, r.rank), false))::INT AS copies
    FROM ranked r JOIN ends3 e ON e.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken FROM copies
"""


def _strength(groups: str) -> str:
    """The prior's strength of one level, from its groups with labels."""
    return f"""(
    SELECT coalesce(least(1000, greatest(1, CASE
        WHEN k > 1 AND total > k AND among + (typical - 1) * within_ > 0
            AND (among - within_) / (among + (typical - 1) * within_) > 0
        THEN 1 / ((among - within_) / (among + (typical - 1) * within_)) - 1 ELSE 1000 END)), 1000)::DOUBLE
    FROM (SELECT *, CASE WHEN k > 1 THEN (between_ - total * (goods / total) * (goods / total)) / (k - 1) END AS among,
            CASE WHEN total > k THEN (goods - between_) / (total - k) END AS within_,
            CASE WHEN k > 1 THEN (total - squares / total) / (k - 1) END AS typical
        FROM (SELECT count(*)::DOUBLE AS k, sum(n)::DOUBLE AS total, sum(good)::DOUBLE AS goods,
                sum(n::DOUBLE * n) AS squares, sum(good::DOUBLE * good / n) AS between_
            FROM {groups} WHERE n > 0)))"""


_LONG = (
    "('ac.uk', 'co.uk', 'gov.uk', 'org.uk', 'com.au', 'net.au', 'org.au', 'co.jp', 'ac.jp', 'or.jp', "
    "'co.nz', 'co.za', 'com.br', 'com.cn', 'com.mx', 'co.in', 'co.kr', 'com.tr')"
)

_REPUTATION = rf"""
WITH parsed AS (
    SELECT page_id, coalesce({_LOWER.format("regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)")}, '') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages),
marks AS (
    SELECT doc_id, count(*) AS labels, sum((quality = 1 AND coalesce(toxic, 0) = 0)::INT) AS goods
    FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
hosts AS (
    SELECT host, coalesce(sum(labels), 0)::BIGINT AS n, coalesce(sum(goods), 0)::BIGINT AS good,
        string_split(host, '.') AS parts
    FROM parsed LEFT JOIN marks ON doc_id = page_id GROUP BY host),
cut AS (
    SELECT *, array_to_string(parts[-2:], '.') IN {_LONG} AS long_suffix FROM hosts),
placed AS (
    SELECT host, n, good,
        CASE WHEN long_suffix THEN array_to_string(parts[-2:], '.') ELSE parts[-1] END AS suffix,
        CASE WHEN long_suffix THEN array_to_string(parts[-3:], '.') ELSE array_to_string(parts[-2:], '.') END AS domain
    FROM cut),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(good) AS good FROM placed GROUP BY domain, suffix),
suffixes AS (SELECT suffix, sum(n) AS n, sum(good) AS good FROM domains GROUP BY suffix),
whole AS (SELECT (sum(good) + 1)::DOUBLE / (sum(n) + 2) AS mean FROM suffixes),
strengths AS (SELECT {_strength("suffixes")} AS s, {_strength("domains")} AS d, {_strength("placed")} AS h),
suffix_means AS (
    SELECT suffix, (s * mean + good) / (s * mean + good + s * (1 - mean) + n - good) AS suffix_mean
    FROM suffixes, whole, strengths),
domain_means AS (
    SELECT domain, (d * suffix_mean + good) / (d * suffix_mean + good + d * (1 - suffix_mean) + n - good) AS domain_mean
    FROM domains JOIN suffix_means USING (suffix), strengths),
posterior AS (
    SELECT host, n, h * domain_mean + good AS alpha, h * (1 - domain_mean) + n - good AS beta
    FROM placed JOIN domain_means USING (domain), strengths),
bounds AS (
    SELECT host, n, alpha / (alpha + beta)
        - 1.645 * sqrt(alpha * beta / ((alpha + beta) * (alpha + beta) * (alpha + beta + 1))) AS bound
    FROM posterior),
ruled AS (
    SELECT *, CASE
        WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
    FROM parsed)
SELECT page_id, host, path, rule,
    CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
        WHEN bound >= 0.6 THEN 'allow' ELSE 'block' END AS verdict,
    n AS host_labelled
FROM ruled JOIN bounds USING (host)
"""

ORACLE = {
    "op1_itq_dedup": _ITQ,
    "op5_pareto_mix": _MIX,
    "op7_odd_sketch": _NEAR,
    "op8_url_reputation": _REPUTATION,
    "op13_collocations": _COLLOCATIONS,
    "op12_stratified_shards": _SHARDS,
}
