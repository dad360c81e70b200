"""DuckDB SQL for the queries that SQL can express, on the same tables.

It follows the definitions of the results, not the operators' methods: all
pairs of documents that share a shingle, every template against every unit,
every candidate string against the formulas of its tests.
"""

from __future__ import annotations

from emporium.llm import licences, secrets

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

JACCARD = f"""
WITH RECURSIVE texts AS (
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS w FROM documents
), sets AS (
    SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]) END) AS s
    FROM texts
), shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
    SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach AS (SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce(least_id, doc_id)) AS component_id
FROM sets LEFT JOIN (SELECT x, min(y) AS least_id FROM reach GROUP BY x) AS r ON r.x = doc_id
"""


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _licences() -> str:
    known = ", ".join(f"({_text(k)}, [{', '.join(map(_text, licences.pairs_of(v)))}])" for k, v in licences.TEMPLATES.items())
    blank = "'\\n[ \\t\\r]*\\n'"
    return f"""
    WITH templates(licence, known) AS (VALUES {known}),
    units AS (
        SELECT doc_id, 'line' AS unit, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS unit_no, unnest(string_split(text, chr(10))) AS body FROM documents
        UNION ALL
        SELECT * FROM (
            SELECT doc_id, 'paragraph', generate_subscripts(string_split_regex(text, {blank}), 1) - 1, unnest(string_split_regex(text, {blank})) AS body FROM documents
        ) AS p WHERE contains(body, chr(10))
        UNION ALL SELECT doc_id, 'text', 0, text FROM documents WHERE regexp_matches(text, {blank})
    ), words AS (SELECT doc_id, unit, unit_no, list_filter(string_split_regex(lower(body), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM units),
    pairs AS (SELECT doc_id, unit, unit_no, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS p FROM words WHERE len(w) > 1),
    scored AS (
        SELECT doc_id, unit, unit_no, licence, len(p) AS n_pairs, 2.0::DOUBLE * len(list_intersect(p, known)) / (len(p) + len(known)) AS dice
        FROM pairs JOIN templates ON 2.0::DOUBLE * least(len(p), len(known)) / (len(p) + len(known)) >= {licences.THRESHOLD}
    ),
    texts AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(lower(text), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM documents),
    places AS (SELECT r, i - 1 AS place, w[i] || ' ' || w[i + 1] AS pair FROM (SELECT r, w, unnest(range(1, len(w))) AS i FROM texts) AS x),
    shared AS (SELECT r, place, licence, size FROM places JOIN (SELECT licence, len(known) AS size, unnest(known) AS pair FROM templates) AS k USING (pair)),
    breaks AS (SELECT *, coalesce(place - lag(place) OVER (PARTITION BY r, licence ORDER BY place) - 1 > 2 + size // 16, TRUE) AS broken FROM shared),
    numbered AS (SELECT *, count_if(broken) OVER (PARTITION BY r, licence ORDER BY place) AS passage FROM breaks),
    spans AS (SELECT r, licence, min(place) AS a, max(place) AS b FROM numbered GROUP BY r, licence, passage),
    passages AS (
        SELECT doc_id, a, licence, known, list_distinct(list_transform(range(a + 1, b + 2), lambda i: w[i] || ' ' || w[i + 1])) AS p
        FROM spans JOIN texts USING (r) JOIN templates USING (licence)
    ),
    every_unit AS (
        SELECT * FROM scored
        UNION ALL SELECT doc_id, 'passage', a, licence, len(p), 2.0::DOUBLE * len(list_intersect(p, known)) / (len(p) + len(known)) FROM passages
    )
    SELECT doc_id, unit, CAST(unit_no AS INTEGER) AS unit_no, licence, CAST(n_pairs AS INTEGER) AS n_pairs, dice FROM every_unit WHERE dice >= {licences.THRESHOLD}
    """


ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)


def _found(pattern: str, columns: str) -> str:
    """Matches of a pattern with their places, by the lengths of what lies between."""
    p = _text(pattern)
    return f"""
        SELECT doc_id, {columns} FROM (
            SELECT doc_id, hits[i] AS hit, parts[i] AS part, list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0) AS pos
            FROM (
                SELECT doc_id, hits, parts, gaps, unnest(range(1, len(hits) + 1)) AS i
                FROM (SELECT doc_id, regexp_extract_all(text, {p}) AS hits, regexp_extract_all(text, {p}, {1 if pattern != ASSIGN else 2}) AS parts, string_split_regex(text, {p}) AS gaps FROM texts) AS f
            ) AS n
        ) AS placed"""


def _secrets() -> str:
    # An identifier's letters: four fifths as in English, one fifth evenly spread; a class stays
    # with 0.85 in hex and base32, and in base64 by the row of the class before (digit, lower,
    # upper, sign); a vowel follows a consonant with 0.5 and a vowel with 0.2.
    letters = "ETAOINSHRDLCUMWFGYPBVKJXQZ"
    english = "[1270, 906, 817, 751, 697, 675, 633, 609, 599, 425, 403, 278, 276, 241, 236, 223, 202, 197, 193, 149, 98, 77, 15, 15, 10, 7]"
    mixed = "[[0.7, 0.1, 0.1, 0.1], [0.05, 0.85, 0.05, 0.05], [0.05, 0.2, 0.7, 0.05], [0.15, 0.4, 0.4, 0.05]]"
    share = f"(0.8::DOUBLE * {english}[k] / list_sum({english}) + 0.2::DOUBLE / 26)"
    uniform = "(CASE WHEN size = 16 THEN CASE k WHEN 0 THEN 10 ELSE 6 END WHEN size = 32 THEN CASE k WHEN 0 THEN 6 ELSE 26 END ELSE CASE k WHEN 0 THEN 10 WHEN 3 THEN 2 ELSE 26 END END / size::DOUBLE)"
    follows = f"(CASE WHEN size = 64 THEN {mixed}[j + 1][k + 1] WHEN j = k THEN 0.85 ELSE 0.05 END)::DOUBLE"
    vowel = f"(SELECT sum({share}) FROM range(1, 27) AS v(k) WHERE '{letters}'[k] IN ('A', 'E', 'I', 'O', 'U'))"
    after = "CASE WHEN before THEN 0.2::DOUBLE ELSE 0.5::DOUBLE END"
    base = [
        _found(ASSIGN, "CAST(pos AS INT) AS a, 0 AS kind, CAST(pos + length(hit) AS INT) AS b, length(part) >= 8 AS ok"),
        _found(f"({secrets.ACCESS})", "CAST(pos AS INT), 1, CAST(pos + length(hit) AS INT), TRUE"),
        _found(f"({secrets.HEX})", "CAST(pos AS INT), 2, CAST(pos + length(hit) AS INT), TRUE"),
    ]
    alphabet = f"WHEN 16 THEN '0123456789abcdef' WHEN 32 THEN '{UPPER}234567' WHEN 64 THEN '{UPPER}{LOWER}0123456789+/'"
    names = "['assign', 'access', 'hex', 'random']"
    return f"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    base AS (SELECT doc_id, a, kind, b FROM ({' UNION ALL '.join(base)}) AS x WHERE ok),
    runs AS ({_found('([A-Za-z0-9+/_=-]{20,})', "CAST(pos AS INT) AS a, CAST(pos + length(hit) AS INT) AS b, rtrim(hit, '=') AS body")}),
    coded AS (
        SELECT *, length(body) AS n, CASE WHEN length(body) < 8 THEN 0
            WHEN regexp_full_match(body, '[0-9a-f]+|[0-9A-F]+') THEN 16 WHEN regexp_full_match(body, '[A-Z2-7]+') THEN 32 ELSE 64 END AS size
        FROM runs
    ), weights AS (
        SELECT (SELECT list(CAST(round(1000 * ln(1 / 26.0::DOUBLE / {share})) AS BIGINT) ORDER BY k) FROM range(1, 27) AS l(k)) AS letter_weights,
            (SELECT list(CAST(round(1000 * ln(if(own, {vowel}, 1 - {vowel}) / if(own, {after}, 1 - {after}))) AS BIGINT) ORDER BY before, own)
                FROM (VALUES (FALSE, FALSE), (FALSE, TRUE), (TRUE, FALSE), (TRUE, TRUE)) AS t(before, own)) AS tone_weights
    ), steps AS (
        SELECT size, list(CAST(round(1000 * ln({uniform} / {follows})) AS BIGINT) ORDER BY j, k) AS step_weights
        FROM (VALUES (16), (32), (64)) AS s(size), range(0, 4) AS b(j), range(0, 4) AS o(k) GROUP BY size
    ), listed AS (
        SELECT *, list_transform(string_split(if(size = 16, lower(body), translate(body, '-_', '+/')), ''), lambda c: instr(CASE size {alphabet} END, c) - 1) AS place,
            list_transform(string_split(upper(body), ''), lambda c: instr('{letters}', c)) AS letter,
            list_transform(string_split(body, ''), lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN 0 WHEN c BETWEEN 'a' AND 'z' THEN 1 WHEN c BETWEEN 'A' AND 'Z' THEN 2 ELSE 3 END) AS class,
            list_transform(string_split(upper(body), ''), lambda c: if(c IN ('A', 'E', 'I', 'O', 'U'), 1, 0)) AS vowel
        FROM coded JOIN steps USING (size), weights
    ), summed AS (
        SELECT *, list_sum(list_transform(range(0, size), lambda k: len(list_filter(place, lambda x: x = k)) ** 2)) AS squares,
            1 + len(list_filter(range(2, n + 1), lambda i: (2 * place[i] >= size) <> (2 * place[i - 1] >= size))) AS r,
            list_sum(list_transform(place, lambda x: (x - (size - 1) / 2.0::DOUBLE) ** 2)) AS spread,
            list_sum(list_transform(range(2, n + 1), lambda i: (place[i] - (size - 1) / 2.0::DOUBLE) * (place[i - 1] - (size - 1) / 2.0::DOUBLE))) AS along,
            list_sum(list_transform(letter, lambda k: if(k > 0, letter_weights[greatest(k, 1)] + if(size = 16, CAST(round(1000 * ln(26 / 6.0::DOUBLE)) AS BIGINT), 0), if(size = 32, CAST(round(1000 * ln(10 / 6.0::DOUBLE)) AS BIGINT), 0))))
                + list_sum(list_transform(range(2, n + 1), lambda i: step_weights[4 * class[i - 1] + class[i] + 1]))
                + list_sum(list_transform(range(2, n + 1), lambda i: if(class[i] = class[i - 1] AND class[i] IN (1, 2), tone_weights[2 * vowel[i - 1] + vowel[i] + 1], 0))) AS ratio
        FROM listed
    ), tested AS (
        SELECT doc_id, a, b, size, CAST(floor(log2(n)) AS INT) AS band,
            if((size::DOUBLE / n * squares - n - (size - 1)) / sqrt(2.0::DOUBLE * (size - 1) * (n - 1) / n) <= 3.3
                AND abs((r - 1 - (n - 1) / 2.0::DOUBLE) / (sqrt(n - 1) / 2.0::DOUBLE)) <= 3.3 AND abs(along / spread * sqrt(n)) <= 3.3,
                CAST(least(600, greatest(0, floor((ratio - round(1000 * ln(3))) / (100 * ln(10))))) AS INT), 0) AS bin
        FROM summed
    ), passed AS (
        SELECT size, band, min(bin) AS least_bin FROM (
            SELECT size, band, bin, sum(count(*)) OVER (PARTITION BY size, band ORDER BY bin DESC) AS above, sum(count(*)) OVER (PARTITION BY size, band) AS total FROM tested GROUP BY size, band, bin
        ) AS bins WHERE 10.0::DOUBLE ** (-bin / 10.0::DOUBLE) <= 0.01 * above / total GROUP BY size, band
    ), spans AS (
        SELECT * FROM base
        UNION ALL SELECT doc_id, a, 3, b FROM tested JOIN passed USING (size, band)
        WHERE bin >= least_bin AND NOT EXISTS (SELECT 1 FROM base WHERE base.doc_id = tested.doc_id AND base.a < tested.b AND tested.a < base.b)
    ), said AS (SELECT *, {names}[kind + 1] || ':' || a || ':' || b AS span FROM spans)
    SELECT t.doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex,
        count(*) FILTER (WHERE kind = 3) AS n_random,
        sha256(coalesce(string_agg(span, ',' ORDER BY a, kind) FILTER (WHERE kind < 3), '')) AS base_sha256,
        coalesce(string_agg(span, ',' ORDER BY a, kind), '') AS spans
    FROM texts t LEFT JOIN said s USING (doc_id) GROUP BY t.doc_id
    """


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of ``text``, bit by bit."""
    byte = f"CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT)"
    bits = f"flatten(list_transform(range(octet_length(encode({text}))), lambda i: list_transform(range(8), lambda k: ({byte} >> CAST(k AS INT)) & 1)))"
    step = "lambda c, b: xor(c >> 1, CASE WHEN (xor(c, b) & 1) = 1 THEN 3988292384 ELSE 0 END)"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bits}), {step}), 4294967295)"


def _spelling() -> str:
    """All words with one place masked, and with one place left out."""
    latin = "[A-Za-z\u00C0-\u00FF]+"
    letters = f"translate(run, '{UPPER}', '{LOWER}')"
    h = _crc32("(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)")
    return f"""
    WITH RECURSIVE runs AS (
        SELECT doc_id, run, count(*) AS times FROM (
            SELECT doc_id, {letters} AS run FROM (SELECT doc_id, unnest(regexp_extract_all(text, '{latin}')) AS run FROM documents) AS r WHERE length(run) >= 6
        ) AS l GROUP BY doc_id, run
    ), hashed AS (SELECT run, times, {h} AS h FROM runs),
    words AS (
        SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
            SELECT times, CASE WHEN h % 199 = 0 THEN left(run, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word FROM hashed
        ) AS w WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5
    ), places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
    cut AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM places),
    near AS (
        SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
        UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
        UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
    ), best AS (SELECT word, count(*) AS n_near, max(near_n) AS most, arg_min(near, (-near_n, near)) AS near FROM near GROUP BY word),
    forms AS (
        SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 5 * w.n THEN near END AS form, CASE WHEN most >= 5 * w.n THEN most END AS form_n
        FROM words w LEFT JOIN best b ON w.word = b.word
    ), walk AS (
        SELECT word, word AS at, form AS next FROM forms
        UNION ALL SELECT walk.word, f.word, f.form FROM walk JOIN forms f ON f.word = walk.next
    )
    SELECT f.word, f.form, walk.at AS root, f.n, f.n_near, f.form_n FROM forms f JOIN walk ON walk.word = f.word AND walk.next IS NULL
    """


def _merkle() -> str:
    """Whole trees, level by level, and each leaf walked up through both."""

    def leaf(text: str) -> str:
        fields = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)
        return "sha256(" + " || ".join(f"coalesce(octet_length(encode({f})) || ':' || {f}, '-')" for f in fields) + ")"

    def forest(name: str, bottom: str) -> str:
        block = "PARTITION BY tree, level, pos // 8 ORDER BY pos ROWS BETWEEN"
        return f"""
    {name}(level, tree, pos, digest, width) AS (
        {bottom}
        UNION ALL
        SELECT level + 1, tree, pos // 8, sha256(string_agg(digest, '' ORDER BY pos)), (max(width) + 7) // 8 FROM {name} WHERE width > 1 GROUP BY level, tree, pos // 8
    ), {name}_sides AS (
        SELECT level, tree, pos, coalesce(string_agg(digest, '') OVER ({block} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
            coalesce(string_agg(digest, '') OVER ({block} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
        FROM {name} WHERE width > 1
    )"""

    def walk(name: str, over: str, bottom: str) -> str:
        return f"""
    {name}(tree, start, level, pos, node, proof) AS (
        {bottom}
        UNION ALL
        SELECT w.tree, w.start, w.level + 1, w.pos // 8, sha256(l || node || r), proof || l || r FROM {name} w JOIN {over}_sides s ON w.tree = s.tree AND w.level = s.level AND w.pos = s.pos
    )"""

    lower = f"translate(text, '{UPPER}', '{LOWER}')"
    return f"""
    WITH RECURSIVE hashed AS (
        SELECT doc_id, lang, {leaf("text")} AS leaf, CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN {leaf(lower)} ELSE {leaf("text")} END AS seen FROM documents
    ), placed AS (
        SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY lang) AS width,
            row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
        FROM hashed
    ), {forest("nodes", "SELECT 0, tree, pos, leaf, width FROM placed")},
    {forest("roofs", "SELECT 0, 0, tree, digest, count(*) OVER () FROM nodes WHERE width = 1")},
    {walk("low", "nodes", "SELECT tree, pos, 0, pos, seen, '' FROM placed")},
    ended AS (SELECT w.tree, start, node, proof, n.digest AS subroot FROM low w JOIN nodes n ON w.tree = n.tree AND w.level = n.level AND w.pos = n.pos WHERE n.width = 1),
    {walk("high", "roofs", "SELECT 0, tree::VARCHAR || ':' || start::VARCHAR, 0, tree, node, proof FROM ended")},
    done AS (SELECT start, node, proof, n.digest AS root FROM high w JOIN roofs n ON w.level = n.level AND w.pos = n.pos WHERE n.width = 1)
    SELECT doc_id, leaf, subroot, root, sha256(d.proof) AS proof_sha256, d.node AS folded_root, d.node = root AS verified
    FROM placed p JOIN ended e ON p.tree = e.tree AND p.pos = e.start JOIN done d ON d.start = p.tree::VARCHAR || ':' || p.pos::VARCHAR
    """


ORACLE = {"op3_jaccard_join": JACCARD, "op6_secret_scans": _secrets(), "op10_licence_scans": _licences(), "op11_spelling_variants": _spelling(), "op12_merkle_manifest": _merkle()}
