"""DuckDB SQL for the queries that SQL can express, over the whole tables."""

from __future__ import annotations

from rankmart.llm import decontaminate, license_scan, substring_dedup

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _ascii_words(text: str) -> str:
    lowered = f"translate(coalesce({text}, ''), '{_UPPER}', '{_UPPER.lower()}')"
    return rf"regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _op1() -> str:
    templates = [*license_scan.BASE, *license_scan.TEXTS]
    pairs = ", ".join(
        f"({n}, '{t.label}', {t.exact}, {len(t.words) - 1}, {p}, '{t.words[p]}', "
        f"'{t.words[p + 1]}')"
        for n, t in enumerate(templates)
        for p in range(len(t.words) - 1)
    )
    return f"""
WITH templates(template, label, exact, pairs, place, one, two) AS (VALUES {pairs}),
docs AS (SELECT doc_id, {_ascii_words("text")} AS words FROM documents),
ones AS (
    SELECT doc_id, unnest(words) AS one, generate_subscripts(words, 1) - 1 AS pos FROM docs),
twos AS (
    SELECT *, lead(one) OVER (PARTITION BY doc_id ORDER BY pos) AS two FROM ones),
votes AS (
    SELECT doc_id, template, label, exact, pairs, pos - place AS diagonal, place
    FROM twos JOIN templates USING (one, two)),
exact_places AS (
    SELECT doc_id, label, diagonal FROM votes WHERE exact
    GROUP BY doc_id, template, label, pairs, diagonal HAVING count(DISTINCT place) = pairs),
diagonals AS (SELECT DISTINCT doc_id, template, label, exact, pairs, diagonal FROM votes),
merged AS (
    SELECT d.doc_id, d.label, d.exact, count(DISTINCT v.place) / d.pairs AS coverage
    FROM diagonals d JOIN votes v ON v.doc_id = d.doc_id AND v.template = d.template
        AND v.diagonal BETWEEN d.diagonal
            AND d.diagonal + CASE WHEN d.exact THEN 0 ELSE {license_scan.GAP} END
    GROUP BY d.doc_id, d.template, d.label, d.exact, d.pairs, d.diagonal),
labelled AS (
    SELECT doc_id, label FROM exact_places
    UNION SELECT doc_id, label FROM merged
    WHERE NOT exact AND coverage >= {license_scan.THRESHOLD}),
base AS (
    SELECT doc_id, count(*) AS n_base, min(diagonal) AS first_word,
        max(diagonal) AS last_word,
        array_to_string(list_sort(list(DISTINCT label)), ',') AS base_labels
    FROM exact_places GROUP BY doc_id),
labels_of AS (
    SELECT doc_id, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels
    FROM labelled GROUP BY doc_id),
best AS (SELECT doc_id, max(coverage) AS score FROM merged GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base,
    first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
    coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
    coalesce(score, 0.0)::DOUBLE AS score
FROM docs LEFT JOIN base USING (doc_id) LEFT JOIN labels_of USING (doc_id)
    LEFT JOIN best USING (doc_id)"""


def _op2() -> str:
    window, equal = decontaminate.WINDOW, decontaminate.EQUAL
    return f"""
WITH docs AS (SELECT doc_id, {_ascii_words("text")} AS words FROM documents),
items AS (SELECT item_id, {_ascii_words("text")} AS words FROM benchmark),
doc_words AS (
    SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS p FROM docs),
item_words AS (
    SELECT item_id, len(words) AS size, unnest(words) AS word,
        generate_subscripts(words, 1) - 1 AS t FROM items),
meetings AS (
    SELECT doc_id, item_id, size, p - t AS diagonal, t
    FROM doc_words JOIN item_words USING (word)),
likely AS (
    SELECT doc_id, item_id, size, diagonal, list(t) AS places, count(*) AS n
    FROM meetings GROUP BY ALL HAVING count(*) >= CASE WHEN size < {window} THEN size
        ELSE {equal} END),
starts AS (
    SELECT *, unnest(generate_series(greatest(0, -diagonal),
        least(size, d.words_n - diagonal) - least(size, {window}))) AS s
    FROM likely JOIN (SELECT doc_id, len(words) AS words_n FROM docs) d USING (doc_id)),
passing AS (
    SELECT *, len(list_filter(places, lambda x: x >= s AND x < s + {window})) AS hits FROM starts)
SELECT doc_id, item_id, min(diagonal + s)::BIGINT AS first_word,
    max(diagonal + s + least(size, {window}) - 1)::BIGINT AS last_word,
    max(n)::BIGINT AS equal_words, max(n / size)::DOUBLE AS overlap
FROM passing WHERE size >= 6
    AND hits >= CASE WHEN size < {window} THEN size ELSE {equal} END
GROUP BY doc_id, item_id"""


def _op3() -> str:
    window = substring_dedup.WINDOW
    return rf"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents),
words AS (
    SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS p FROM docs),
windows AS (
    SELECT doc_id, unnest(generate_series(0, len(words) - {window})) AS s, words FROM docs),
spelled AS (
    SELECT doc_id, s, array_to_string(words[s + 1 : s + {window}], ' ') AS w FROM windows),
repeats AS (
    SELECT doc_id, s FROM (
        SELECT doc_id, s, min(doc_id) OVER (PARTITION BY w) AS least FROM spelled)
    WHERE least < doc_id),
covered AS (
    SELECT DISTINCT doc_id, unnest(generate_series(s, s + {window - 1})) AS p FROM repeats),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text, count(*) AS n
    FROM words ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
    sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)"""


_OP11 = r"""
WITH chosen AS (
    SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.id AS anchor_id, a.label AS own, r.id, r.label,
        CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
    FROM chosen a JOIN chosen r ON a.id % 50 = 0 AND r.id <> a.id AND len(r.v) = len(a.v)
), positives AS (
    SELECT anchor_id, own, id AS positive_id, score AS positive_score FROM scored WHERE label = own
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.positive_id,
    CAST(row_number() OVER (
        PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
    s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND s.label <> p.own
    AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3"""

# A run has three words in a row that are equal a period apart: candidates come from there.
_OP12 = r"""
WITH split AS (
    SELECT doc_id, list_filter(
        regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
        list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
            lambda c: CAST(ascii(c) AS BIGINT)) AS digits
    FROM documents
), hashed AS (
    SELECT doc_id, words, len(words) AS n, xor(4294967295, list_reduce(
        list_concat([CAST(4294967295 AS BIGINT)], digits), lambda h, digit: list_reduce(
            list_concat([xor(h, digit)], range(8)),
            lambda x, bit: xor(x >> 1, 3988292384 * (x & 1))))) AS h
    FROM split
), looping AS (
    SELECT *, (h // 10) % n AS a, 1 + (n - (h // 10) % n) // (3 + (h // 10) % 8) AS p FROM hashed
), texts AS MATERIALIZED (
    SELECT row_number() OVER () AS d, doc_id, n,
        CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n),
            lambda i: words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END])
        ELSE words END AS words
    FROM looping
), tokens AS (
    SELECT d, unnest(range(n)) AS i, unnest(words) AS w FROM texts
), grams AS (
    SELECT d, i, lag(hash(w)) OVER place AS before,
        hash(w, lead(w) OVER place, lead(w, 2) OVER place) AS gram
    FROM tokens WINDOW place AS (PARTITION BY d ORDER BY i)
), starts AS (
    SELECT a.d, a.i, b.i - a.i AS q
    FROM grams a JOIN grams b ON a.d = b.d AND a.gram = b.gram AND a.i < b.i
    WHERE a.before IS DISTINCT FROM b.before OR a.i = 0
), stretches AS (
    SELECT d, i AS start, q, n, coalesce(list_position(list_transform(
        range(i, n - q), lambda j: words[j + 1] <> words[j + 1 + q]), true) - 1, n - q - i) + q AS length
    FROM starts JOIN texts USING (d) WHERE q <= n // 4
), runs AS (
    SELECT d, start, length, min(q) AS period FROM stretches
    WHERE length >= greatest(6, 4 * q) GROUP BY ALL
), told AS (
    SELECT d, count(*) AS n_runs,
        arg_min(struct_pack(start, length, period), (-length, start, period)) AS best,
        string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period)
            AS lines
    FROM runs GROUP BY d
), dropped AS (
    SELECT d, list_distinct(flatten(list(range(start + period, start + length)))) AS gone
    FROM runs GROUP BY d
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length,
    best.period AS period, 1000 * best.length // best.period AS exponent_milli,
    sha256(coalesce(lines, '')) AS runs_sha256,
    sha256(array_to_string(CASE WHEN gone IS NULL THEN words ELSE list_transform(
        list_filter(range(n), lambda i: NOT list_contains(gone, i)), lambda i: words[i + 1]) END, ' ')) AS collapsed_sha256
FROM texts LEFT JOIN told USING (d) LEFT JOIN dropped USING (d)"""


ORACLE: dict[str, str] = {
    "op1_license_scan": _op1(),
    "op2_decontamination": _op2(),
    "op3_substring_dedup": _op3(),
    "op11_hard_negatives": _OP11,
    "op12_periodic_runs": _OP12,
}
