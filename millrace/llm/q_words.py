"""Queries over the words of documents: spelling variants, toxicity, phrases."""

from __future__ import annotations

from . import bloom_cascade, phrases, spelling, toxicity
from .catalog import query, table

MIN_LENGTH, MIN_COUNT = 7, 2


_LETTERS = r"[A-Za-z\x{00C0}-\x{00FF}]+"
#: The words of each document as they are counted, and those long and frequent enough, in SQL.
_SLIPPED_SQL = rf"""run AS (SELECT doc_id, run, count(*) AS k FROM (SELECT doc_id, translate(unnest(regexp_extract_all(text, '{_LETTERS}')),
        '{bloom_cascade.UPPER}', '{bloom_cascade.LOWER}') AS run FROM documents) GROUP BY ALL),
    crc_table AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce([i::BIGINT] || range(8),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))),
    keyed AS (SELECT *, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS b FROM run),
    summed AS (SELECT *, xor(list_reduce([4294967295::BIGINT] || list_transform(range(length(b) // 2), lambda k: ('0x' || b[2 * k + 1:2 * k + 2])::BIGINT),
        lambda c, x: xor(c >> 8, t[xor(c, x) % 256 + 1])), 4294967295) AS h FROM keyed, crc_table),
    word AS (SELECT CASE WHEN h % {spelling.SLIP} = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, sum(k)::BIGINT AS n
        FROM summed GROUP BY 1 HAVING length(word) >= {MIN_LENGTH} AND sum(k) >= {MIN_COUNT})"""


@query(
    "op11_spelling",
    f"""WITH RECURSIVE {_SLIPPED_SQL},
    less AS (SELECT word, n, i, word[:i] || word[i + 2:] AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM word)),
    pair AS (SELECT a.word AS a, a.n AS an, b.word AS b, b.n AS bn FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
        UNION SELECT a.word, a.n, b.word, b.n FROM word a JOIN less b ON a.word = b.rest
        UNION SELECT b.word, b.n, a.word, a.n FROM word a JOIN less b ON a.word = b.rest),
    found AS (SELECT a, count(*) AS n_near, first(b ORDER BY bn DESC, encode(b)) AS f, max(bn) AS fn FROM pair GROUP BY a),
    told AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN fn >= {spelling.RATIO} * n THEN f END AS form, CASE WHEN fn >= {spelling.RATIO} * n THEN fn END AS form_n
        FROM word LEFT JOIN found ON a = word),
    way AS (SELECT word, word AS last, 0 AS step FROM told UNION ALL SELECT way.word, told.form, step + 1 FROM way JOIN told ON told.word = way.last WHERE form IS NOT NULL)
    SELECT told.word, form, root, n, n_near, form_n FROM told JOIN (SELECT word, arg_max(last, step) AS root FROM way GROUP BY word) r ON r.word = told.word""",
)
def op11_spelling(spark, sf):
    return spelling.document_variants(table(spark, sf, "documents").select("doc_id", "text"), MIN_LENGTH, MIN_COUNT)


@query("op12_toxicity")
def op12_toxicity(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", "toxic")
    return toxicity.judge(table(spark, sf, "documents").select("doc_id", "text"), labels).drop("matches")


LONGEST, LEAST, PERCENT, TOP = 3, 10, 50, 2_000


@query(
    "op13_phrases",
    rf"""WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
            translate(text, '{bloom_cascade.UPPER}', '{bloom_cascade.LOWER}'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
    w AS (SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM piece),
    one AS (SELECT lang, x, count(*) AS f FROM (SELECT lang, unnest(w) AS x FROM w) GROUP BY ALL),
    size AS (SELECT lang, sum(f)::BIGINT AS n FROM one GROUP BY lang),
    two AS (SELECT lang, x, y, count(*) AS f FROM (SELECT lang, w[i] AS x, w[i + 1] AS y FROM (SELECT lang, w, unnest(range(1, len(w))) AS i FROM w)) GROUP BY ALL),
    three AS (SELECT lang, x, y, z, count(*) AS a FROM (SELECT lang, w[i] AS x, w[i + 1] AS y, w[i + 2] AS z FROM (SELECT lang, w, unnest(range(1, len(w) - 1)) AS i FROM w))
        GROUP BY ALL HAVING count(*) >= {LEAST}),
    longer AS (SELECT lang, x, y, max(a) AS most FROM (SELECT lang, x, y, a FROM three UNION ALL SELECT lang, y, z, a FROM three) GROUP BY ALL),
    cut AS (SELECT two.lang, two.x || ' ' || two.y AS phrase, two.f AS a, 1 AS k, p.f AS l, q.f AS r FROM two JOIN one p ON p.lang = two.lang AND p.x = two.x
            JOIN one q ON q.lang = two.lang AND q.x = two.y LEFT JOIN longer g ON g.lang = two.lang AND g.x = two.x AND g.y = two.y
            WHERE two.f >= {LEAST} AND coalesce(100 * most < {PERCENT} * two.f, TRUE)
        UNION ALL SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, a, 1, p.f, q.f FROM three t JOIN one p ON p.lang = t.lang AND p.x = t.x
            JOIN two q ON q.lang = t.lang AND q.x = t.y AND q.y = t.z
        UNION ALL SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, a, 2, p.f, q.f FROM three t JOIN two p ON p.lang = t.lang AND p.x = t.x AND p.y = t.y
            JOIN one q ON q.lang = t.lang AND q.x = t.z),
    scored AS (SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM cut),
    lowest AS (SELECT lang, phrase, a, l, r, score FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM lowest)
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN size USING (lang) WHERE rank <= {TOP}""",
)
def op13_phrases(spark, sf):
    return phrases.collocations(table(spark, sf, "documents").select("lang", "text"), LONGEST, LEAST, PERCENT, TOP)
