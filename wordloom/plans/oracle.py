"""SQL that answers the registered queries independently, in DuckDB's dialect.

n-grams come from ``lead`` over the words of a line here, not from array slices.
"""

from __future__ import annotations

# The library's fixed values once more, so that a wrong one there shows up here.
UNITS = ("B", "KB", "MB", "GB", "TB")
PART_BYTES = 4194304
SMALL_PART_BYTES = 16384

_WORD = r"[\p{L}0-9](?:[\p{L}0-9''-]*[\p{L}0-9])?"
_RAW_WORD = "[^ \\t\\n\\r\\f]+"


def _lines(table: str, key: str, column: str) -> str:
    return rf"""
    parts AS (
        SELECT {key} AS id, regexp_split_to_array({column}, '\r\n|\r|\n') AS a
        FROM {table} WHERE {column} IS NOT NULL),
    numbered AS (SELECT id, a, unnest(range(len(a))) AS line_no FROM parts),
    lines AS (
        SELECT id, line_no, a[line_no + 1] AS line FROM numbered
        WHERE NOT (line_no = len(a) - 1 AND a[line_no + 1] = ''))"""


def _words(table: str = "documents", key: str = "doc_id", column: str = "text") -> str:
    return _lines(table, key, column) + rf""",
    arrays AS (SELECT id, line_no, regexp_extract_all(lower(line), '{_WORD}') AS w FROM lines),
    words AS (
        SELECT id, line_no, unnest(range(len(w))) AS pos, unnest(w) AS word FROM arrays)"""


def _grams(n: int, table: str = "documents", key: str = "doc_id", column: str = "text") -> str:
    ahead = ", ".join(f"lead(word, {k}) OVER line AS w{k}" for k in range(1, n))
    tail = " || ',' || ".join(f"w{k}" for k in range(1, n))
    return _words(table, key, column) + f""",
    ahead AS (
        SELECT id, line_no, word AS head, {ahead} FROM words
        WINDOW line AS (PARTITION BY id, line_no ORDER BY pos)),
    grams AS (
        SELECT id, line_no, head, {tail} AS tail FROM ahead WHERE w{n - 1} IS NOT NULL)"""


def _word_count(table: str = "documents", key: str = "doc_id", column: str = "text") -> str:
    return f"WITH {_words(table, key, column)} SELECT word, count(*) AS n FROM words GROUP BY word"


def _ngram_count(n: int, table: str = "documents", key: str = "doc_id") -> str:
    return f"""WITH {_grams(n, table, key)}
    SELECT head || ',' || tail AS gram, count(*) AS n FROM grams GROUP BY gram"""


def _total(table: str, column: str) -> str:
    return rf"""SELECT 'word' AS key, n FROM (
        SELECT sum(len(regexp_extract_all({column}, '{_RAW_WORD}')))::BIGINT AS n FROM {table})
    WHERE n > 0"""


def _entries(
    n: int, table: str = "documents", key: str = "doc_id", column: str = "text"
) -> str:
    return _grams(n, table, key, column) + """,
    entries AS (SELECT head, tail, count(*) AS n FROM grams GROUP BY head, tail)"""


def _dealt(
    n: int,
    part_bytes: int = PART_BYTES,
    table: str = "documents",
    key: str = "doc_id",
    column: str = "text",
) -> str:
    return f"""WITH {_entries(n, table, key, column)},
    sized AS (
        SELECT head, sum(strlen(tail) + length(n::VARCHAR) + 3) AS bytes
        FROM entries GROUP BY head),
    dealt AS (
        SELECT head, tail, n, CASE WHEN bytes <= {part_bytes} THEN 0
            ELSE ('0x' || substr(md5(tail), 1, 8))::BIGINT % ceil(bytes / {part_bytes})::BIGINT
            END::BIGINT AS part
        FROM entries JOIN sized USING (head))"""


def _stripes(n: int, part_bytes: int = PART_BYTES, *of: str) -> str:
    return f"""{_dealt(n, part_bytes, *of)}
    SELECT head, part, string_agg(tail || ':' || n, ', ' ORDER BY tail) AS stripe
    FROM dealt GROUP BY head, part"""


def _line_stripes(n: int) -> str:
    return f"""WITH {_grams(n)},
    counted AS (
        SELECT id, line_no, head, tail, count(*) AS n FROM grams GROUP BY id, line_no, head, tail)
    SELECT id AS doc_id, line_no, head,
        string_agg(tail || ':' || n, ', ' ORDER BY tail) AS stripe
    FROM counted GROUP BY id, line_no, head"""


def _gram_totals(n: int) -> str:
    rows = _words() if n == 1 else _grams(n)
    gram = "word FROM words" if n == 1 else "head || ',' || tail FROM grams"
    return f"""WITH {rows}, emitted(gram) AS (SELECT {gram})
    SELECT (SELECT count(*) FROM lines) AS lines, count(*) AS grams,
        count(DISTINCT gram) AS distinct_grams FROM emitted"""


def _last_counts() -> str:
    """The last count that 7 does not divide, of the odd half before that of the even one."""
    return f"""WITH {_words()},
    counted AS (
        SELECT id % 2 AS half, word, count(*) AS n FROM words GROUP BY ALL HAVING count(*) % 7 <> 0)
    SELECT word, max_by(n, half) AS n FROM counted GROUP BY word"""


def _report(words: str) -> str:
    def section(name: str, order: str) -> str:
        return f"""SELECT '{name}' AS section, row_number() OVER (ORDER BY {order}) AS place, word, n
            FROM (SELECT * FROM counted ORDER BY {order} LIMIT 10)"""

    return f"""WITH counted AS ({words})
    SELECT 'words' AS section, 1::BIGINT AS place, NULL::VARCHAR AS word, count(*) AS n FROM counted
    UNION ALL SELECT 'tokens', 1, NULL, sum(n)::BIGINT FROM counted
    UNION ALL {section("most frequent", "n DESC, word DESC")}
    UNION ALL {section("least frequent", "n, word")}"""


def _two_series() -> str:
    return """WITH named AS (
        SELECT event_type || '_' || strftime(ts, '%Y%m') AS name, event_id % 2 AS half,
            floor(value * 1000)::BIGINT AS value FROM events),
    complete AS (SELECT name FROM named GROUP BY name HAVING count(DISTINCT half) = 2)
    SELECT name, CASE half WHEN 0 THEN 'even' ELSE 'odd' END AS series, value
    FROM named JOIN complete USING (name)"""


def _unit(value: str, rounded: str) -> str:
    """``rounded`` holds ``{}`` for the scaled value: ties go up or to the even digit."""
    steps = "".join(
        f" WHEN {value} >= {1024**p} THEN "
        f"format('{{:.3f}} {UNITS[p]}', {rounded.format(f'({value} / {1024**p})')})"
        for p in range(len(UNITS) - 1, 0, -1)
    )
    return f"CASE{steps} ELSE format('{{:.3f}} {UNITS[0]}', {rounded.format(f'({value})')}) END"


def _clock(value: str) -> str:
    return (
        f"printf('%02d:%02d:%02d.%03d', ({value} // 3600000)::BIGINT, "
        f"({value} // 60000 % 60)::BIGINT, ({value} // 1000 % 60)::BIGINT, ({value} % 1000)::BIGINT)"
    )


def _run_recap() -> str:
    mean_bytes = _unit("mean_bytes::DOUBLE", "round({}, 3)")
    return f"""WITH runs AS (
        SELECT event_type AS job, event_id AS run, value <= 100 AS ok, user_id,
            floor(value * 1000)::BIGINT AS ms FROM events),
    sums AS (
        SELECT job, count(*) FILTER (ok) AS good, count(*) AS attempts,
            coalesce(sum(ms) FILTER (ok), 0)::BIGINT AS total_ms,
            coalesce(sum(ms * user_id) FILTER (ok), 0)::BIGINT AS total_bytes,
            coalesce(sum(user_id) FILTER (ok), 0)::BIGINT AS total_spilled,
            coalesce(max_by(ms, run) FILTER (ok), 0)::BIGINT AS reduce_output_records
        FROM runs GROUP BY job),
    means AS (
        SELECT *, coalesce(total_ms // nullif(good, 0), 0) AS mean_ms,
            coalesce(total_bytes // nullif(good, 0), 0) AS mean_bytes,
            coalesce(total_spilled // nullif(good, 0), 0)::BIGINT AS avg_spilled_records
        FROM sums)
    SELECT job, good AS successful_runs, attempts AS total_attempts,
        attempts - good AS failed_runs, {_clock("total_ms")} AS total_time,
        {_clock("mean_ms")} AS average_time, {mean_bytes} AS avg_map_output_bytes,
        avg_spilled_records, reduce_output_records
    FROM means"""


def _series_means() -> str:
    return f"""WITH means AS (
        SELECT event_type AS series,
            sum(floor(value * 1000)::BIGINT)::DOUBLE / count(*) AS mean
        FROM events GROUP BY event_type)
    SELECT series, mean, {_unit("mean", "{}")} AS shown FROM means"""


def oracle_sql() -> dict[str, str]:
    words = _word_count()
    by_document = f"""WITH {_words()}
        SELECT id AS doc_id, word, count(*) AS n FROM words GROUP BY id, word"""
    found = {
        "word_count": words,
        "line_records": f"WITH {_lines('documents', 'doc_id', 'text')} "
        "SELECT id AS doc_id, line_no, line FROM lines",
        "normalized_lines": f"""WITH {_words()}
            SELECT id AS doc_id, line_no, array_to_string(w, ' ') AS normalized FROM arrays""",
        "tokens": f"WITH {_words()} SELECT id AS doc_id, line_no, pos, word FROM words",
        "total_word_count": _total("documents", "text"),
        "corpus_totals": f"SELECT count(*) AS words, sum(n)::BIGINT AS tokens FROM ({words})",
        "top_words": f"SELECT * FROM ({words}) ORDER BY n DESC, word DESC LIMIT 10",
        "bottom_words": f"SELECT * FROM ({words}) ORDER BY n, word LIMIT 10",
        "cooccurrence_pairs": _ngram_count(2),
        "cooccurrence_entries": f"WITH {_entries(2)} SELECT head, tail, n FROM entries",
        "cooccurrence_stripes": _stripes(2),
        "cooccurrence_stripes_in_parts": _stripes(2, SMALL_PART_BYTES),
        "cooccurrence_stripes_conversations": _stripes(
            2, PART_BYTES, "conversations", "(conv_id, turn)"
        ),
        "ngram_stripes_3_pages": _stripes(3, PART_BYTES, "pages", "page_id", "html"),
        "stripes_merged": _stripes(2, SMALL_PART_BYTES),
        "ngram_stripes_3_merged": _stripes(3, SMALL_PART_BYTES),
        "word_count_two_runs": words,
        "corpus_report": _report(words),
        "file_last_counts": _last_counts(),
        "two_series_round_trip": _two_series(),
        "stripe_maps": f"{_dealt(2, SMALL_PART_BYTES)} SELECT head, part, tail, n FROM dealt",
        "line_stripes": _line_stripes(2),
        "line_stripes_3": _line_stripes(3),
        "word_count_by_document": by_document,
        "gram_totals_1": _gram_totals(1),
        "gram_totals_3": _gram_totals(3),
        "gram_totals_10": _gram_totals(10),
        "tsv_round_trip": words,
        "stripes_tsv_round_trip": _stripes(2, SMALL_PART_BYTES),
        "file_totals": f"""SELECT count(*) AS words,
            coalesce(sum(n) FILTER (n % 7 <> 0), 0)::BIGINT AS tokens FROM ({words})""",
        "file_top_words": f"""SELECT * FROM ({words}) WHERE n % 7 <> 0
            ORDER BY n DESC, word DESC LIMIT 10""",
        "file_bottom_words": f"""SELECT * FROM ({words}) WHERE n % 7 <> 0
            ORDER BY n, word LIMIT 10""",
        "word_count_from_files": words,
        "run_recap": _run_recap(),
        "series_means": _series_means(),
        "word_count_pages": _word_count("pages", "page_id", "html"),
        "word_count_conversations": _word_count("conversations", "(conv_id, turn)"),
        "word_count_benchmark": _word_count("benchmark", "item_id"),
        "total_word_count_pages": _total("pages", "html"),
        "ngram_pairs_3_conversations": _ngram_count(3, "conversations", "(conv_id, turn)"),
    }
    for n in (2, 3, 5, 10):
        found[f"ngram_pairs_{n}"] = _ngram_count(n)
    for n in (5, 10):
        found[f"ngram_pairs_{n}_coded"] = _ngram_count(n)
    for n in (3, 5, 10):
        found[f"ngram_head_tail_{n}"] = f"""WITH {_grams(n)}
            SELECT id AS doc_id, line_no, head, tail FROM grams"""
        found[f"ngram_stripes_{n}"] = _stripes(n)
    found["ngram_stripes_3_in_parts"] = _stripes(3, SMALL_PART_BYTES)
    return found
