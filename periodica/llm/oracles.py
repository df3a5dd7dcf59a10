"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from periodica.llm.common import LOWER, UPPER

# The CRC-32 of each byte, from the reversed polynomial.
CRC_STEPS = """
    SELECT list_transform(range(256), lambda b: list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda held, turn: CASE WHEN held & 1 = 1 THEN xor(held >> 1, 3988292384) ELSE held >> 1 END)) AS steps
"""


def _crc32(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of an SQL expression, beside a row of CRC_STEPS."""
    digits = f"hex(encode({text}))"
    digit = f"(instr('0123456789ABCDEF', substr({digits}, %s, 1)) - 1)"
    octets = f"list_transform(range(1, length({digits}), 2), lambda i: 16 * {digit % 'i'} + {digit % 'i + 1'})"
    step = "lambda held, octet: xor(held >> 8, steps[1 + (xor(held, octet) & 255)])"
    return f"CAST(xor(list_reduce([4294967295] || {octets}, {step}), 4294967295) AS BIGINT)"


def _words(text: str) -> str:
    return rf"regexp_extract_all(translate(coalesce({text}, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


ORACLES: dict[str, str] = {
    "op6_exact_dedup": f"""
        WITH normal AS (
            SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS body FROM documents
        ), judged AS (
            SELECT doc_id, body, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size
            FROM normal WINDOW same AS (PARTITION BY body)
        )
        SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(body) AS text_sha256
        FROM judged
    """,
    "op12_importance_resampling": f"""
        WITH crc AS MATERIALIZED ({CRC_STEPS}),
        split AS (SELECT doc_id, {_words("text")} AS words FROM documents),
        source_words AS (SELECT word, count(*) AS n FROM (SELECT unnest(words) AS word FROM split) GROUP BY word),
        target_words AS (
            SELECT word, count(*) AS n FROM (SELECT unnest({_words("text")}) AS word FROM benchmark) GROUP BY word
        ),
        hashed AS MATERIALIZED (
            SELECT word, {_crc32("word")} % 10000 AS bucket
            FROM (SELECT word FROM source_words UNION SELECT word FROM target_words) AS both_words, crc
        ),
        counts AS (
            SELECT bucket, sum(s) AS s, sum(t) AS t
            FROM (
                SELECT bucket, n AS s, 0 AS t FROM source_words JOIN hashed USING (word)
                UNION ALL
                SELECT bucket, 0, n FROM target_words JOIN hashed USING (word)
            )
            GROUP BY bucket
        ),
        totals AS (SELECT sum(s) + 10000 AS s, sum(t) + 10000 AS t FROM counts),
        gains AS (
            SELECT bucket, CAST(floor(1000 * ln((c.t + 1)::DOUBLE * totals.s::DOUBLE
                / ((c.s + 1)::DOUBLE * totals.t::DOUBLE))) AS BIGINT) AS gain
            FROM counts AS c, totals
        ),
        weighed AS (
            SELECT doc_id, CAST(floor(sum(gain)::DOUBLE / count(*)) AS BIGINT) AS weight
            FROM (SELECT doc_id, unnest(words) AS word FROM split) JOIN hashed USING (word) JOIN gains USING (bucket)
            GROUP BY doc_id
        ),
        scored AS (
            SELECT doc_id, len(words) AS n_features, coalesce(weight, 0) AS weight,
                coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8)
                    AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
            FROM split LEFT JOIN weighed USING (doc_id)
        ),
        ranked AS (
            SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
            FROM scored WHERE n_features >= 20
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN place <= n * 10 // 100 THEN place END AS rank
        FROM scored LEFT JOIN ranked USING (doc_id)
    """,
    "op13_spelling_variants": rf"""
        WITH RECURSIVE crc AS MATERIALIZED ({CRC_STEPS}),
        runs AS (
            SELECT doc_id, run, count(*) AS n
            FROM (
                SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                    '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run
                FROM documents
            )
            GROUP BY doc_id, run
        ),
        hashed AS (SELECT run, n, {_crc32("doc_id || ':' || run")} AS h FROM runs, crc WHERE length(run) >= 6),
        results AS (
            SELECT n, CASE WHEN h % 199 = 0
                THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
            FROM hashed
        ),
        words AS MATERIALIZED (
            SELECT word, CAST(sum(n) AS BIGINT) AS n FROM results WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
        ),
        cut AS MATERIALIZED (
            SELECT word, n, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail
            FROM words, unnest(range(1, length(word) + 1)) AS places(i)
        ),
        pairs AS (
            SELECT a.word, b.word AS near, b.n FROM cut AS a JOIN cut AS b ON a.head = b.head AND a.tail = b.tail AND a.word <> b.word
            UNION
            SELECT a.word, b.word, b.n FROM cut AS a JOIN words AS b ON a.head || a.tail = b.word
            UNION
            SELECT b.word, a.word, a.n FROM cut AS a JOIN words AS b ON a.head || a.tail = b.word
        ),
        ordered AS (
            SELECT word, near, n, count(*) OVER same AS n_near,
                row_number() OVER (PARTITION BY word ORDER BY n DESC, encode(near)) AS place
            FROM pairs WINDOW same AS (PARTITION BY word)
        ),
        named AS MATERIALIZED (
            SELECT w.word, w.n, coalesce(o.n_near, 0) AS n_near,
                CASE WHEN o.n >= 5 * w.n THEN o.near END AS form, CASE WHEN o.n >= 5 * w.n THEN o.n END AS form_n
            FROM words AS w LEFT JOIN ordered AS o ON o.word = w.word AND o.place = 1
        ),
        followed AS (
            SELECT word, word AS reached FROM named
            UNION ALL
            SELECT f.word, n.form FROM followed AS f JOIN named AS n ON n.word = f.reached WHERE n.form IS NOT NULL
        ),
        ends AS (
            SELECT f.word, f.reached AS root FROM followed AS f JOIN named AS n ON n.word = f.reached WHERE n.form IS NULL
        )
        SELECT word, form, root, n, n_near, form_n FROM named JOIN ends USING (word)
    """,
}
