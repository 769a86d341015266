"""The same in SQL, where SQL can say it."""

#: Words of a lower-cased text.
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all(coalesce({_LOWER}, ''), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

#: CRC-32 of the numbers 0 to 15, as fixed by its polynomial: a step for four bits.
_CRC_OF_FOUR_BITS = """[
    0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948,
    3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]"""

#: The four bits of every byte of a feature, low ones first.
_FOURS = """list_transform(range(0, CAST(2 * octet_length(encode(feature)) AS BIGINT)),
    lambda i: CAST(strpos('0123456789ABCDEF', hex(encode(feature))[i + 2 - 2 * (i % 2)]) - 1 AS BIGINT))"""

_BUCKET = f"""CAST(xor(list_reduce({_FOURS},
    lambda c, v: xor(c >> 4, {_CRC_OF_FOUR_BITS}[(xor(c, v) & 15) + 1]), CAST(4294967295 AS BIGINT)),
    4294967295) % 10000 AS BIGINT)"""


def _features(table: str, key: str) -> str:
    """Features of one to three words, one row each."""
    return f"""
        SELECT {key}, unnest(list_concat(w,
            list_transform(range(1, CAST(len(w) AS BIGINT)), lambda i: w[i] || ' ' || w[i + 1]),
            list_transform(range(1, CAST(len(w) - 1 AS BIGINT)), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS feature
        FROM (SELECT {key}, {_WORDS} AS w FROM {table}) t"""


SQL: dict[str, str] = {
    "op8_perspectives": """
        WITH m AS (
            SELECT conv_id, coalesce(role, 'unknown') AS role, coalesce(text, '') || '<|im_end|>' || chr(10) AS body,
                   row_number() OVER (PARTITION BY conv_id
                       ORDER BY turn NULLS FIRST, coalesce(role, 'unknown'), coalesce(text, '')) - 1 AS ordinal
            FROM conversations),
        shown AS (
            SELECT m.conv_id, speaker, ordinal - ordinal % 64 AS first_message, ordinal, role = speaker AS own, body,
                   '<|im_start|>' || CASE WHEN role = speaker THEN 'assistant' ELSE 'user name=' || role END || chr(10) AS head
            FROM m JOIN (SELECT DISTINCT conv_id, role AS speaker FROM m) s ON m.conv_id IS NOT DISTINCT FROM s.conv_id)
        SELECT conv_id, speaker, CAST(first_message AS BIGINT) AS first_message, count(*) AS n_messages,
               CAST(sum(CASE WHEN own THEN length(body) ELSE 0 END) AS BIGINT) AS n_learned,
               string_agg(head || body, '' ORDER BY ordinal) AS text,
               string_agg(CASE WHEN own THEN length(head) || ',' || length(body)
                               ELSE (length(head) + length(body)) || ',0' END, ',' ORDER BY ordinal) AS mask
        FROM shown GROUP BY ALL""",
    "op11_resampling": f"""
        WITH own AS (SELECT doc_id, feature, count(*) AS n FROM ({_features('documents', 'doc_id')}) f GROUP BY ALL),
        wanted AS (SELECT feature, count(*) AS n FROM ({_features('benchmark', 'item_id')}) f GROUP BY ALL),
        named AS (SELECT feature, {_BUCKET} AS bucket
                  FROM (SELECT feature FROM own UNION SELECT feature FROM wanted) d),
        s AS (SELECT bucket, sum(n) AS n FROM own JOIN named USING (feature) GROUP BY ALL),
        t AS (SELECT bucket, sum(n) AS n FROM wanted JOIN named USING (feature) GROUP BY ALL),
        gains AS (
            SELECT bucket, CAST(floor(1000 * ln(
                CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * CAST((SELECT sum(n) FROM s) + 10000 AS DOUBLE)
                / (CAST(s.n + 1 AS DOUBLE) * CAST((SELECT sum(n) FROM t) + 10000 AS DOUBLE)))) AS BIGINT) AS gain
            FROM s LEFT JOIN t USING (bucket)),
        weights AS (SELECT doc_id, sum(n) AS n_features, sum(n * gain) AS weight
                    FROM own JOIN named USING (feature) JOIN gains USING (bucket) GROUP BY ALL),
        scored AS (
            SELECT d.doc_id, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features,
                   CAST(coalesce(weight, 0) AS BIGINT) AS weight, len({_WORDS}) >= 20 AS enough,
                   CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln(
                       (CAST('0x' || sha256('42:' || d.doc_id)[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
            FROM documents d LEFT JOIN weights w ON d.doc_id = w.doc_id),
        drawn AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scored WHERE enough)
        SELECT s.doc_id, n_features, weight, score,
               CASE WHEN rank <= 5 * (SELECT count(*) FROM drawn) // 100 THEN CAST(rank AS BIGINT) END AS rank
        FROM scored s LEFT JOIN drawn r ON s.doc_id = r.doc_id""",
    "op12_hard_negatives": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scores AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
                   CAST(list_dot_product(CAST(a.e AS DOUBLE[]), CAST(b.e AS DOUBLE[])) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT p.anchor_id, positive_id,
               CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM positives p JOIN scores s ON p.anchor_id = s.anchor_id
        WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10""",
    "op13_decontamination": f"""
        WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        windows AS (
            SELECT item_id, unnest(CASE WHEN len(w) < 10 THEN [w]
                ELSE list_transform(range(1, CAST(len(w) - 8 AS BIGINT)), lambda i: w[i:i + 9]) END) AS words
            FROM items WHERE len(w) > 0),
        docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        sizes AS (SELECT DISTINCT len(words) AS size FROM windows),
        runs AS (
            SELECT doc_id, pos, size, w[pos:pos + size - 1] AS words
            FROM (SELECT doc_id, w, size, unnest(range(1, CAST(len(w) - size + 2 AS BIGINT))) AS pos FROM docs, sizes) r),
        found AS (SELECT doc_id, pos, size, item_id FROM runs JOIN windows USING (words)),
        hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit
                FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS place FROM found) p GROUP BY ALL),
        met AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
                FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) i GROUP BY ALL)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs d LEFT JOIN hit h ON d.doc_id = h.doc_id LEFT JOIN met m ON d.doc_id = m.doc_id""",
}
