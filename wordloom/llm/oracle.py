"""SQL for the registered queries that SQL can express, in DuckDB's dialect."""

from __future__ import annotations

from wordloom.llm.licenses import LICENSES, NOTICES

_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _decontamination() -> str:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    split = f"regexp_extract_all({_LOWER.format('text')}, '{word}')"
    return f"""WITH items AS (SELECT item_id, {split} AS w FROM benchmark),
    placed AS (
        SELECT item_id, w, least(len(w), 10) AS n, unnest(range(len(w) - least(len(w), 10) + 1)) AS s
        FROM items WHERE len(w) > 0),
    windows AS (SELECT DISTINCT item_id, n, array_to_string(w[s + 1:s + n], ' ') AS gram FROM placed),
    docs AS (SELECT doc_id, {split} AS w FROM documents),
    starts AS (SELECT doc_id, w, unnest(range(len(w))) AS s FROM docs),
    grams AS (
        SELECT doc_id, s, n, array_to_string(w[s + 1:s + n], ' ') AS gram
        FROM starts, (SELECT DISTINCT n FROM windows) WHERE s + n <= len(w)),
    hits AS (SELECT doc_id, s, n, item_id FROM grams JOIN windows USING (n, gram)),
    covered AS (
        SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
    listed AS (
        SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
        sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)"""


def _mixing() -> str:
    """Targets by one running sum over the sources, samples by one over each source."""
    word = r"[^\x20\x09-\x0D]+"
    return rf"""WITH docs AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{word}')) AS size,
            (('0x' || substr(md5(concat_ws(':', 'mix', coalesce(doc_id::VARCHAR, ''),
                coalesce(md5(text), ''))), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496 AS u,
            len(regexp_extract_all(coalesce(text, ''), '(?m)\S[ \t\r]*$')) AS lines,
            len(regexp_extract_all(coalesce(text, ''), '(?m)[.!?]["'')]*[ \t\r]*$')) AS closed
        FROM documents),
    keyed AS (
        SELECT doc_id, source, size,
            -ln(u) / least(1.0, greatest(0.1, closed::DOUBLE / greatest(lines, 1))) AS key
        FROM docs),
    sources AS (
        SELECT source, sum(size)::BIGINT AS source_size,
            [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
        FROM keyed GROUP BY source),
    running AS (
        SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER earlier, 0) AS rest,
            sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0) AS shares
        FROM sources WINDOW earlier AS (
            ORDER BY 3 * source_size / weight, source NULLS LAST
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    marked AS (SELECT *, 3 * source_size * shares <= rest * weight AS cut FROM running),
    targets AS (
        SELECT source, source_size, CASE WHEN cut THEN (3 * source_size)::DOUBLE
            ELSE (weight * max(rest) FILTER (NOT cut) OVER ())::DOUBLE
                / (max(shares) FILTER (NOT cut) OVER ())::DOUBLE END AS target
        FROM marked),
    planned AS (
        SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs
        FROM targets),
    summed AS (
        SELECT doc_id, size, source_size, target, epochs, target - epochs * source_size AS rest,
            sum(size) OVER (PARTITION BY k.source ORDER BY key) AS upto,
            sum(size) OVER (PARTITION BY k.source, key) AS unit
        FROM keyed k JOIN planned p ON k.source IS NOT DISTINCT FROM p.source)
    SELECT doc_id, size, source_size, target, (size * (epochs + CASE
        WHEN upto <= rest OR upto - unit < rest AND upto - rest < rest - (upto - unit)
        THEN 1 ELSE 0 END))::BIGINT AS taken
    FROM summed"""


def _quality() -> str:
    """The rules in SQL, all of them for every text; their order makes no difference."""
    word = r"[^\x20\x09-\x0D]+"
    return rf"""WITH docs AS (
        SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{word}') AS w
        FROM documents),
    starts AS (SELECT doc_id, w, unnest(range(len(w) - 2)) AS s FROM docs),
    grams AS (SELECT doc_id, s, array_to_string(w[s + 1:s + 3], ' ') AS gram FROM starts),
    again AS (
        SELECT doc_id, s FROM (
            SELECT doc_id, s, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM grams) WHERE n > 1),
    repeats AS (
        SELECT doc_id, count(DISTINCT p) AS n_repeat_words
        FROM (SELECT doc_id, unnest(range(s, s + 3)) AS p FROM again) GROUP BY doc_id),
    lines AS (
        SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
        FROM (SELECT doc_id, unnest(regexp_split_to_array(t, '\n')) AS line FROM docs)
        WHERE regexp_matches(line, '{word}') GROUP BY doc_id),
    measured AS (
        SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
            len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
            coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
            coalesce(n_lines, 0) AS n_lines, len(list_distinct(w)) AS n_distinct
        FROM docs LEFT JOIN repeats USING (doc_id) LEFT JOIN lines USING (doc_id)),
    base AS (
        SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT base_failed AND 10 * n_symbols <= n_words AND 2 * n_dup_lines <= n_lines
            AND word_chars BETWEEN 2 * n_words AND 25 * n_words
            AND n_distinct * n_distinct >= n_words AS kept
    FROM base"""


def _line_dedup() -> str:
    return r"""WITH docs AS (
        SELECT doc_id, text, regexp_split_to_array(text, '\n') AS l FROM documents),
    placed AS (
        SELECT doc_id, least(len(l), 3) AS n, unnest(range(len(l) - least(len(l), 3) + 1)) AS s, l
        FROM docs WHERE text IS NOT NULL),
    windows AS (
        SELECT doc_id, s, n, l[s + 1:s + n] AS w FROM placed
        WHERE regexp_matches(array_to_string(l[s + 1:s + n], ''), '[^\x20\x09-\x0D]')),
    ranked AS (
        SELECT *, row_number() OVER of_window AS r, first_value(doc_id) OVER of_window AS d1,
            first_value(s) OVER of_window AS s1, first_value(n) OVER of_window AS n1
        FROM windows WINDOW of_window AS (PARTITION BY w ORDER BY doc_id NULLS FIRST, s)),
    gone AS (
        SELECT DISTINCT doc_id, p FROM (
            SELECT doc_id, d1, s1 + n1 AS free, unnest(range(s, s + n)) AS p FROM ranked WHERE r > 1)
        WHERE doc_id <> d1 OR p >= free),
    numbered AS (SELECT doc_id, unnest(range(len(l))) AS p, unnest(l) AS line FROM docs),
    kept AS (
        SELECT doc_id, count(*) AS n_lines, count(g.p) AS n_removed,
            coalesce(string_agg(line, chr(10) ORDER BY n.p) FILTER (g.p IS NULL), '') AS text
        FROM numbered n LEFT JOIN gone g USING (doc_id, p) GROUP BY doc_id)
    SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
        sha256(coalesce(k.text, '')) AS kept_sha256
    FROM docs LEFT JOIN kept k USING (doc_id)"""


def _licenses() -> str:
    sign = r"(?:\(c\)|©|&copy;)"
    year = r"(?:(?:19|20)[0-9][0-9]|20xx|[<\[{(]?(?:years?|yyyy)\b)"
    notice = rf"(?:portions )?(?:copyright ?(?:{sign}|{year}|[<\[{{])|{sign} ?{year})"
    openers = (
        "all rights reserved|everyone is permitted|licensed under|permission is granted"
        "|permission is hereby granted|permission to use|redistribution and use"
        "|released under|spdx license|this library is|this program is|this work is"
    )

    def replaced(text: str, *steps: tuple[str, str]) -> str:
        for pattern, by in steps:
            text = f"regexp_replace({text}, '{pattern}', '{by}', 'g')"
        return text

    def canonical(text: str) -> str:
        bare = replaced(
            f"lower(coalesce({text}, ''))",
            (r"\n[^\p{L}\p{N}]*\n", "\x1e"),
            (r"[^\p{L}\p{N}\x1e()©<\[{&;]+", " "),
            (f"({openers}|{notice})", "\x1e\\1"),
            (notice + r"[^\x1e]{0,160}", " "),
            ("all rights reserved", " "),
            (r"[^\p{L}\p{N}]+", " "),
        )
        return replaced(
            f"trim({bare})",
            (r"licence", "license"),
            (r"sub license", "sublicense"),
            (r"(author|initial|organ|real|recogn|util)is(e|ing|ation)", r"\1iz\2"),
            (r"(behavi|col|fav|hon|lab)our", r"\1or"),
            (r"non (commercial|infring)", r"non\1"),
            (r"(^| )https ", r"\1http "),
        )

    def matched(form: str) -> str:
        title = (
            r"^(?:the )?(?:(?:new |modified |revised |simplified )?(?:bsd (?:[23]|two|three) clause"
            r"|[23] clause bsd|isc|mit|bsd zero clause|zero clause bsd) license"
            r"|(?:new|modified|revised|simplified) bsd license|0bsd)(?: (?:mit|isc))?(?: |$)"
        )
        terms = f"regexp_replace({form}, '{title}', '')"
        holders = replaced(
            terms,
            (r" (?:[1-3]|[a-c]|i{1,3}) (redistributions (?:of|in)|neither the names?) ", r" \1 "),
            (
                r" neither the names? of .{1,300}? nor the names of (?:its|their|any|other)? ?contributors may ",
                " neither the name of holder nor the names of its contributors may ",
            ),
            (r" provided by .{1,200}? as is and any express ", " provided by holder as is and any express "),
            (r" in no event shall .{1,200}? be liable ", " in no event shall holder be liable "),
        )
        opening = "redistribution and use in source and binary forms"
        return f"CASE WHEN starts_with({terms}, '{opening}') THEN {holders} ELSE {terms} END"

    texts = ", ".join(
        "('{}', '{}')".format(name, text.replace("'", "''")) for name, text in LICENSES + NOTICES
    )
    return rf"""WITH given AS (SELECT * FROM (VALUES {texts}) AS v(license, text)),
    forms AS (SELECT {canonical('text')} AS form, license FROM given),
    known AS (SELECT form, min(license) AS license FROM forms WHERE form <> '' GROUP BY form),
    whole AS (
        SELECT match, min(license) AS license
        FROM (SELECT {matched('form')} AS match, license FROM forms) WHERE match <> '' GROUP BY match),
    docs AS (SELECT doc_id, text, {canonical('text')} AS form FROM documents),
    matching AS (SELECT doc_id, form, {matched('form')} AS match FROM docs),
    lines AS (
        SELECT doc_id, {canonical('line')} AS form
        FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '\n')) AS line FROM documents)),
    named AS (
        SELECT doc_id, count(*) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS notices
        FROM lines JOIN known USING (form) GROUP BY doc_id)
    SELECT doc_id, sha256(form) AS canonical_sha256, license, coalesce(n, 0) AS n_notice_lines,
        coalesce(notices, '') AS notices
    FROM matching LEFT JOIN whole USING (match) LEFT JOIN named USING (doc_id)"""


def _warc() -> str:
    return """WITH read AS (
        SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS size FROM pages),
    ranked AS (
        SELECT *, CASE WHEN size >= 1000 THEN max(page_id) OVER (PARTITION BY html) END AS largest
        FROM read)
    SELECT page_id, size AS payload_bytes, sha1(html) AS payload_digest,
        CASE WHEN largest <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN largest <> page_id THEN largest END AS refers_to
    FROM ranked"""


def _collocations() -> str:
    """Every n-gram of a piece by position, counted as text; cuts and containment by joins."""
    return rf"""WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
        FROM (SELECT lang, unnest(string_split_regex({_LOWER.format('text')}, '[.,;:!?\x0A-\x0D]')) AS piece
              FROM documents)),
    totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
    grams AS (
        SELECT lang, k, array_to_string(w[s:s + k - 1], ' ') AS phrase
        FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM pieces, (VALUES (1), (2), (3)) AS sizes(k))),
    counted AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 10),
    cuts AS (
        SELECT lang, k, phrase, f, j, array_to_string(string_split(phrase, ' ')[1:j], ' ') AS head,
            array_to_string(string_split(phrase, ' ')[j + 1:], ' ') AS tail
        FROM counted, (VALUES (1), (2)) AS places(j) WHERE j < k),
    shares AS (
        SELECT c.lang, c.k, c.phrase, c.f AS a, c.j, x.f AS l, y.f AS r,
            1000000::HUGEINT * c.f * c.f // (x.f::HUGEINT * y.f) AS score
        FROM cuts c JOIN counted x ON x.lang = c.lang AND x.phrase = c.head
        JOIN counted y ON y.lang = c.lang AND y.phrase = c.tail),
    lowest AS (
        SELECT * FROM shares QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
    halves AS (
        SELECT lang, array_to_string(string_split(phrase, ' ')[1:2], ' ') AS phrase, f FROM counted WHERE k = 3
        UNION ALL SELECT lang, array_to_string(string_split(phrase, ' ')[2:3], ' '), f FROM counted WHERE k = 3),
    kept AS (
        SELECT * FROM lowest c WHERE NOT EXISTS (
            SELECT 1 FROM halves h WHERE h.lang = c.lang AND h.phrase = c.phrase AND 100 * h.f >= 50 * c.a)),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
    SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score
    FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontamination": _decontamination(),
        "op3_line_dedup": _line_dedup(),
        "op4_mixing": _mixing(),
        "op5_quality_rules": _quality(),
        "op8_license_scan": _licenses(),
        "op9_warc": _warc(),
        "op13_phrase_collocations": _collocations(),
    }
