"""Oracle SQL (DuckDB) of the queries that SQL can express."""

from __future__ import annotations

from twinledger.llm import language_id, license_scan, quality_bayes, source_mix

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _lower(column: str) -> str:
    return f"translate({column}, '{UPPER}', '{LOWER}')"


def language(size: int = 400) -> str:
    """Three-letter windows as text: an n-gram is its letters, in the order of their code points."""
    step = "CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END"
    return f"""
WITH crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), lambda v, k: {step})) AS t),
docs AS (
  SELECT doc_id, lang, text, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
           lambda v, b: xor(v >> 8, t[1 + (xor(v, b) & 255)])), 4294967295) % 3 = 1 AS held_out,
         ' ' || trim(regexp_replace(lower(coalesce(text, '')), '\\P{{L}}+', ' ', 'g')) || ' ' AS s
  FROM documents, crc_table),
letters AS (SELECT doc_id, lang, text, held_out, s FROM docs WHERE s <> '  '),
chars AS (SELECT doc_id, unnest(string_split(s, '')) AS a, generate_subscripts(string_split(s, ''), 1) AS i FROM letters),
codes AS (SELECT doc_id, ord(a)::BIGINT AS c1, lead(ord(a)::BIGINT, 1) OVER w AS c2, lead(ord(a)::BIGINT, 2) OVER w AS c3 FROM chars WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
grams AS (
  SELECT doc_id, c1 AS k FROM codes WHERE c1 <> 32
  UNION ALL SELECT doc_id, (c1 << 21) + c2 FROM codes WHERE c2 IS NOT NULL
  UNION ALL SELECT doc_id, (c1 << 42) + (c2 << 21) + c3 FROM codes WHERE c3 IS NOT NULL AND c2 <> 32),
keyed AS (SELECT doc_id, k, count(*) AS n FROM grams GROUP BY doc_id, k),
own AS (SELECT doc_id, k, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, k) - 1 AS r FROM keyed QUALIFY r < {size}),
counts AS (SELECT lang, k, sum(n) AS n FROM keyed JOIN letters USING (doc_id) WHERE NOT held_out AND lang IS NOT NULL GROUP BY lang, k),
profile AS (SELECT lang, k, row_number() OVER (PARTITION BY lang ORDER BY n DESC, k) - 1 AS p FROM counts QUALIFY p < {size}),
langs AS (SELECT DISTINCT lang FROM profile),
found AS (SELECT doc_id, lang, sum(abs(p - r)) AS d, count(*) AS hits FROM own JOIN profile USING (k) GROUP BY doc_id, lang),
sizes AS (SELECT doc_id, count(*) AS m FROM own GROUP BY doc_id),
far AS (SELECT s.doc_id, l.lang, s.m, coalesce(f.d, 0) + {size} * (s.m - coalesce(f.hits, 0)) AS d
        FROM sizes s CROSS JOIN langs l LEFT JOIN found f ON f.doc_id = s.doc_id AND f.lang = l.lang),
best AS (SELECT doc_id, lang, m, d FROM far QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY d, lang) = 1)
SELECT docs.doc_id, docs.held_out, coalesce(best.lang, '{language_id.UNDETERMINED}') AS lang_pred,
       coalesce(1.0::DOUBLE - best.d::DOUBLE / ({size} * best.m), 0.0) AS score
FROM docs LEFT JOIN best USING (doc_id)"""


def substrings(width: int = 20) -> str:
    return f"""
WITH docs AS (SELECT doc_id, {WORDS} AS w FROM documents),
starts AS (SELECT doc_id, unnest(range(1, len(w) - {width} + 2)) AS i, w FROM docs WHERE len(w) >= {width}),
win AS (SELECT doc_id, i, array_to_string(w[i:i + {width - 1}], ' ') AS k FROM starts),
firsts AS (SELECT k, min({{'d': doc_id, 'i': i}}) AS f FROM win GROUP BY k HAVING count(*) > 1),
again AS (SELECT DISTINCT doc_id, unnest(range(i, i + {width})) AS pos FROM win JOIN firsts USING (k) WHERE {{'d': doc_id, 'i': i}} <> f),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM docs),
cut AS (SELECT words.doc_id, count(*) FILTER (again.pos IS NOT NULL) AS gone, string_agg(word, ' ' ORDER BY words.pos) FILTER (again.pos IS NULL) AS kept
        FROM words LEFT JOIN again ON again.doc_id = words.doc_id AND again.pos = words.pos GROUP BY words.doc_id)
SELECT docs.doc_id, len(w)::BIGINT AS n_words, coalesce(gone, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN cut USING (doc_id)"""


def exact() -> str:
    return f"""
WITH d AS (SELECT doc_id, sha256({_lower("coalesce(text, '')")}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM d"""


def licences() -> str:
    def canonical(column: str) -> str:
        out = f"trim(regexp_replace({_lower(f'regexp_replace({column}, {text(license_scan.COPYRIGHT)}, {text(chr(32))}, {text(chr(103))})')}, {text(license_scan.PUNCTUATION)}, ' ', 'g'))"
        for a, b in license_scan.SPELLINGS:
            out = f"replace({out}, {text(a)}, {text(b)})"
        return f"sha256({out})"

    forms = ", ".join(f"({text(k)}, {text(t)})" for k, ts in license_scan.KNOWN.items() for t in ts)
    return f"""
WITH known AS (SELECT {canonical('form')} AS digest, min(license) AS license FROM (VALUES {forms}) AS f(license, form) GROUP BY 1),
docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs),
found AS (SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS notices, count(*) AS n
          FROM (SELECT doc_id, {canonical('line')} AS digest FROM lines) JOIN known USING (digest) GROUP BY doc_id)
SELECT d.doc_id, k.license, coalesce(f.notices, '') AS notices, coalesce(f.n, 0) AS n_notice_lines, d.digest AS canonical_sha256
FROM (SELECT doc_id, {canonical('text')} AS digest FROM docs) d LEFT JOIN known k USING (digest) LEFT JOIN found f USING (doc_id)"""


def mixture(domains: dict, weights: dict, percent: int, max_epochs: int, seed: int) -> str:
    """The tree domain, lang, source from its root down, then the prefix of each leaf by a running sum."""
    levels = ["domain", "lang", "source"]
    domain = "CASE " + " ".join(f"WHEN source IN ({', '.join(map(text, s))}) THEN {text(n)}" for n, s in domains.items()) + " ELSE 'reference' END"

    def weight(k: int) -> str:
        cases = [(path, w) for path, w in weights.items() if len(path) == k]
        whens = [f"WHEN {' AND '.join(f'{level} = {text(name)}' for level, name in zip(levels, path) if name is not None)} THEN {w}" for path, w in reversed(cases)]
        return f"CASE {' '.join(whens)} ELSE 1 END" if whens else "1"

    parts = []
    for k in range(1, 4):
        cols, up = ", ".join(levels[:k]), ", ".join(["root", *levels[: k - 1]])
        name = levels[k - 1]
        over = f"PARTITION BY {up} ORDER BY CASE WHEN weight > 0 THEN capacity::DOUBLE / weight ELSE 'inf'::DOUBLE END, {name}"
        on = " AND ".join(f"n.{c} = b.{c}" for c in ["root", *levels[: k - 1]])
        parts.append(f"""
n{k} AS (SELECT n.*, b.budget AS b FROM (SELECT 0 AS root, {cols}, sum(capacity) AS capacity, {weight(k)} AS weight FROM leaves GROUP BY {cols}) n JOIN b{k - 1} b ON {on}),
f{k} AS (SELECT *, capacity::HUGEINT * sum(weight) OVER ({over} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
          <= (b - coalesce(sum(capacity) OVER ({over} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::HUGEINT * weight AS full_ FROM n{k}),
r{k} AS (SELECT *, b - sum(CASE WHEN full_ THEN capacity ELSE 0 END) OVER (PARTITION BY {up}) AS rest, sum(CASE WHEN full_ THEN 0 ELSE weight END) OVER (PARTITION BY {up}) AS sharing FROM f{k}),
s{k} AS (SELECT *, CASE WHEN full_ THEN capacity WHEN sharing > 0 THEN (rest::HUGEINT * weight) // sharing ELSE 0 END AS share,
          sum(CASE WHEN NOT full_ AND weight > 0 THEN 1 ELSE 0 END) OVER ({over} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS turn FROM r{k}),
b{k} AS (SELECT root, {cols}, share + CASE WHEN NOT full_ AND weight > 0 AND turn <= b - sum(share) OVER (PARTITION BY {up}) THEN 1 ELSE 0 END AS budget FROM s{k})""")
    return f"""
WITH docs AS (SELECT doc_id, {domain} AS domain, coalesce(lang, '{source_mix.NONE}') AS lang, coalesce(source, '{source_mix.NONE}') AS source, len({WORDS})::BIGINT AS n_tokens FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens) AS tokens, sum(n_tokens) * {max_epochs} AS capacity FROM docs WHERE n_tokens > 0 GROUP BY ALL),
b0 AS (SELECT 0 AS root, least(floor(sum(tokens) * {percent} / 100), sum(capacity))::HUGEINT AS budget FROM leaves),
{",".join(parts)},
plan AS (SELECT domain, lang, source, (budget // tokens) AS epochs, budget % tokens AS over_ FROM b3 JOIN leaves USING (domain, lang, source)),
run AS (SELECT doc_id, domain, lang, source, n_tokens, epochs, over_, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source
          ORDER BY md5('{seed}:' || epochs || ':' || doc_id) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
        FROM docs JOIN plan USING (domain, lang, source) WHERE n_tokens > 0)
SELECT doc_id, domain, lang, source, n_tokens, epochs::INTEGER AS epochs, greatest(least(over_ - ahead, n_tokens), 0)::BIGINT AS prefix_tokens,
       (epochs * n_tokens + greatest(least(over_ - ahead, n_tokens), 0))::BIGINT AS tokens_taken
FROM run WHERE epochs * n_tokens + greatest(least(over_ - ahead, n_tokens), 0) > 0"""


def jaccard(n: int = 4, percent: int = 85) -> str:
    """Components by spreading the smallest id until nothing changes."""
    return f"""
WITH RECURSIVE docs AS (SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) >= {n} THEN list_distinct(list_transform(range(1, len(w) - {n} + 2), lambda i: array_to_string(w[i:i + {n - 1}], ' ')))
                             WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM docs),
keys AS (SELECT doc_id, s, sha256(array_to_string(list_sort(s), chr(10))) AS k FROM sets WHERE len(s) > 0),
points AS (SELECT k, min(doc_id) AS p, any_value(len(s)) AS m, any_value(s) AS s FROM keys GROUP BY k),
every AS (SELECT p, m, hash(unnest(s)) AS g FROM points),
items AS (SELECT p, m, g FROM every WHERE g IN (SELECT g FROM every GROUP BY g HAVING count(*) > 1)),
pairs AS (SELECT a.p AS x, b.p AS y FROM items a JOIN items b ON a.g = b.g AND a.p <> b.p AND 100 * least(a.m, b.m) >= {percent} * greatest(a.m, b.m)
          GROUP BY a.p, a.m, b.p, b.m HAVING 100 * count(*) >= {percent} * (a.m + b.m - count(*))),
reach AS (SELECT p AS x, p AS y FROM points UNION SELECT reach.x, pairs.y FROM reach JOIN pairs ON pairs.x = reach.y),
labels AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT sets.doc_id, len(sets.s)::BIGINT AS n_shingles, coalesce(component_id, sets.doc_id) AS component_id
FROM sets LEFT JOIN keys USING (doc_id) LEFT JOIN points USING (k) LEFT JOIN labels ON x = p"""


def neighbours(k: int = 5, every: int = 50) -> str:
    norm = "sqrt(list_sum(list_transform(v, lambda a: a * a)))"
    return f"""
WITH raw AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
fine AS (SELECT vec_id, v, {norm} AS n FROM raw WHERE len(list_filter(v, lambda a: a IS NULL OR isnan(a) OR isinf(a))) = 0 AND len(list_filter(v, lambda a: a <> 0)) > 0),
usual AS (SELECT len(v) AS d FROM fine GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
e AS (SELECT vec_id, v, n FROM fine WHERE len(v) = (SELECT d FROM usual)),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v) / (q.n * c.n) AS score FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % {every} = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= {k}"""


def site_quality(keep_at: float = 0.5) -> str:
    b = quality_bayes.BINS

    def share(n: str, of: str, step: int) -> str:
        return f"CASE WHEN {of} > 0 THEN least(floor({n} * 100 / {of} / {step}), {b - 1}) ELSE 0 END::INTEGER"

    count = lambda pattern: f"len(regexp_extract_all(t, {text(pattern)}))"
    bins = {
        "length": f"least(length(bin(words)), {b - 1})", "punct": share(count(r"[!-/:-@\[-`{-~]"), "chars", 2), "upper": share(count("[A-Z]"), "chars", 3),
        "digit": share(count("[0-9]"), "chars", 2), "repeat": share("len(list_distinct(string_split(t, ' ')))", "words", 8),
        "word": f"CASE WHEN words > 0 THEN least(floor(chars / words), {b - 1}) ELSE 0 END::INTEGER"}
    names = list(bins)
    marks = " UNION ALL ".join(f"SELECT y, {i} AS f, {c} AS b FROM d JOIN y USING (doc_id)" for i, c in enumerate(names))
    score = " + ".join(["ln((t1 + 1)::DOUBLE / (t0 + 1))", *(f"coalesce((SELECT r FROM ratio WHERE f = {i} AND b = {c}), ln((t0 + {b})::DOUBLE / (t1 + {b})))" for i, c in enumerate(names))])

    def strength(source: str, mean: str) -> str:
        own = f"(sum(n * {mean} * (1 - {mean})) / sum(n))"
        excess = f"greatest(sum(n * (s / n - {mean}) * (s / n - {mean})) / sum(n) - sum({mean} * (1 - {mean})) / sum(n), 1e-6)"
        return f"(SELECT greatest(1.0, least({own} / {excess} - 1, 1e5)) FROM {source})"

    return f"""
WITH texts AS (SELECT doc_id, coalesce(source, '(none)') AS host, coalesce(lang, '(none)') AS path, coalesce(text, '') AS t, length(coalesce(text, '')) AS chars, len({WORDS}) AS words FROM documents),
d AS (SELECT doc_id, host, path, {", ".join(f"{v} AS {k}" for k, v in bins.items())} FROM texts),
y AS (SELECT doc_id, quality AS y FROM labels WHERE quality IN (0, 1)),
marks AS ({marks}),
counts AS (SELECT f, b, sum(y) AS n1, sum(1 - y) AS n0 FROM marks GROUP BY f, b),
totals AS (SELECT coalesce(sum(n1), 0) AS t1, coalesce(sum(n0), 0) AS t0 FROM counts WHERE f = 0),
ratio AS (SELECT f, b, ln((n1 + 1)::DOUBLE / (t1 + {b})) - ln((n0 + 1)::DOUBLE / (t0 + {b})) AS r FROM counts, totals),
p AS (SELECT doc_id, host, path, 1 / (1 + exp(-greatest(least({score}, 12.0), -12.0))) AS p FROM d, totals),
paths AS (SELECT host, path, count(*) AS n, sum(p) AS s FROM p GROUP BY host, path),
hosts AS (SELECT host, sum(n) AS n, sum(s) AS s, (SELECT avg(p) FROM p) AS mu FROM paths GROUP BY host),
hp AS (SELECT host, mu, (s + {strength('hosts', 'mu')} * mu) / (n + {strength('hosts', 'mu')}) AS hpost FROM hosts),
pp AS (SELECT host, path, n, s, mu, hpost FROM paths JOIN hp USING (host)),
post AS (SELECT host, path, mu, hpost, (s + {strength('pp', 'hpost')} * hpost) / (n + {strength('pp', 'hpost')}) AS ppost FROM pp),
q AS (SELECT doc_id, p, hpost, ppost, 1 / (1 + exp(-(ln(p / (1 - p)) + ln(ppost / (1 - ppost)) - ln(mu / (1 - mu))))) AS q FROM p JOIN post USING (host, path))
SELECT doc_id, round(p, 6) AS evidence, round(hpost, 6) AS host_posterior, round(ppost, 6) AS path_posterior, round(q, 6) AS quality, q >= {keep_at} AS keep FROM q"""


CRC_TABLE = "crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)), lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)) AS t)"


def _crc32(value: str) -> str:
    """crc32 of a text of code points below U+0800, with crc_table in reach."""
    codes = f"list_transform(string_split({value}, ''), lambda c: unicode(c)::BIGINT)"
    utf8 = f"flatten(list_transform({codes}, lambda c: CASE WHEN c < 128 THEN [c] ELSE [192 + (c >> 6), 128 + (c & 63)] END))"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {utf8}), lambda v, b: xor(v >> 8, t[1 + (xor(v, b) & 255)])), 4294967295)"


def runs() -> str:
    """Stretches of each lag as islands of matching places; those that a stretch of a smaller lag covers go."""
    return f"""
WITH {CRC_TABLE},
docs AS (SELECT doc_id, {WORDS} AS w, {_crc32('CAST(doc_id AS VARCHAR)')} AS h FROM documents, crc_table),
dealt AS (SELECT doc_id, w, h, len(w) AS n, (h // 10) % greatest(len(w), 1) AS a, 3 + (h // 10) % 8 AS parts FROM docs),
texts AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // parts) END]) ELSE w END AS w FROM dealt),
words AS (SELECT doc_id, n, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM texts),
hits AS (SELECT y.doc_id, y.i, y.i - x.i AS q FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (SELECT doc_id, q, min(i) - q AS s, count(*) + q AS size FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS isle FROM hits) GROUP BY doc_id, q, isle),
long_ AS (SELECT * FROM islands WHERE size >= greatest(6, 4 * q)),
runs AS (SELECT * FROM long_ a WHERE NOT EXISTS (SELECT 1 FROM long_ b WHERE b.doc_id = a.doc_id AND b.q < a.q AND b.s <= a.s AND b.s + b.size >= a.s + a.size)),
gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + size)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS line FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id),
listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || size || ',' || q || chr(10), '' ORDER BY s, q) AS line FROM runs GROUP BY doc_id),
best AS (SELECT doc_id, s, size, q FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY size / q DESC, s, q) = 1)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, s AS start, size AS length, q AS period, 1000 * size // q AS exponent_milli,
       sha256(coalesce(listed.line, '')) AS runs_sha256, sha256(coalesce(kept.line, '')) AS collapsed_sha256
FROM documents LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id) LEFT JOIN best USING (doc_id)"""


def variants(typo: int = 97) -> str:
    """Near words by the word with one code point left out: the same place for a replaced one, the other word for an inserted one."""
    return f"""
WITH RECURSIVE {CRC_TABLE},
found AS (SELECT doc_id, unnest(regexp_extract_all({_lower('text')}, '[A-Za-z\\x{{00C0}}-\\x{{00FF}}]+')) AS r FROM documents),
hashed AS (SELECT r, count(*) AS k, {_crc32("(CAST(doc_id AS VARCHAR) || ':' || r)")} AS h FROM found, crc_table GROUP BY doc_id, r, t),
counts AS (SELECT CASE WHEN h % {typo} = 0 THEN left(r, h % length(r)) || substring(r, h % length(r) + 2) ELSE r END AS word, sum(k)::BIGINT AS n FROM hashed GROUP BY 1),
words AS (SELECT word, n FROM counts WHERE length(word) >= 5 AND n >= 3),
holes AS (SELECT word, n, i, left(word, i) || substring(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
near AS (SELECT a.word, b.word AS other, b.n FROM holes a JOIN holes b USING (rest, i) WHERE a.word <> b.word
         UNION SELECT h.word, w.word, w.n FROM holes h JOIN words w ON h.rest = w.word
         UNION SELECT w.word, h.word, h.n FROM holes h JOIN words w ON h.rest = w.word),
best AS (SELECT word, count(*) AS n_near, min({{'rank': -n, 'other': other}}) AS b FROM near GROUP BY word),
forms AS (SELECT word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.rank >= 2 * words.n THEN b.other END AS form, CASE WHEN -b.rank >= 2 * words.n THEN -b.rank END AS form_n
          FROM words LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS at FROM forms UNION ALL SELECT walk.word, forms.form FROM walk JOIN forms ON forms.word = walk.at WHERE forms.form IS NOT NULL),
ends AS (SELECT walk.word, walk.at AS root FROM walk JOIN forms ON forms.word = walk.at WHERE forms.form IS NULL)
SELECT word, form, root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n FROM forms JOIN ends USING (word)"""


def build(domains: dict, weights: dict, percent: int) -> dict[str, str]:
    return {
        "op2_language_id": language(), "op3_substring_dedup": substrings(), "op4_source_mix": mixture(domains, weights, percent, 2, 7), "op6_exact_dedup": exact(),
        "op7_license_scan": licences(), "op8_nn_descent": neighbours(), "op9_quality_classifier": site_quality(), "op10_ngram_jaccard": jaccard(),
        "op12_periodic_runs": runs(), "op13_spelling_variants": variants(),
    }
