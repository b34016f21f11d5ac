"""SQL of the queries that SQL can express over the small tables; for the others tests hold brute-force versions."""

_WORDS = "list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"

QUALITY = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {_WORDS} AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM documents),
w AS (SELECT r, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM d WHERE len(words) >= 3)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM w) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
m AS (SELECT d.r, doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
    FROM d LEFT JOIN covered ON d.r = covered.r)
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words,
    n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 10 * word_chars OR 100 * n_dup_lines > 30 * n_lines
        OR word_chars < 2 * n_words OR word_chars > 25 * n_words) AS kept
FROM m"""

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_RUNS = f"regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

SEARCH = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_RUNS} AS words FROM documents),
b AS (SELECT row_number() OVER () AS q, item_id, {_RUNS} AS words FROM benchmark),
totals AS (SELECT count(*) FILTER (len(words) > 0) AS n, sum(len(words))::HUGEINT AS l FROM d),
asked AS (SELECT q, term, count(*)::BIGINT AS times FROM (SELECT q, unnest(words) AS term FROM b) GROUP BY q, term),
held AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(words) AS term FROM d) GROUP BY r, term),
weights AS (SELECT term, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
    FROM (SELECT term, count(*) AS df FROM held GROUP BY term), totals),
sizes AS (SELECT r, doc_id, (25 + (75 * len(words) * n) // l)::BIGINT AS m FROM d, totals WHERE len(words) > 0),
scores AS (SELECT q, r, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN sizes USING (r) GROUP BY q, r),
ranked AS (SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id)::INTEGER AS rank
    FROM scores JOIN sizes USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked JOIN b USING (q) WHERE rank <= 10"""

#: crc32 byte by byte, by its table of 256 remainders (polynomial 0xEDB88320).
RESAMPLING = f"""
WITH steps AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
    lambda c, k: xor(c >> 1, (c & 1) * 3988292384))) AS steps),
d AS (SELECT row_number() OVER () AS r, doc_id, {_RUNS} AS words FROM documents),
b AS (SELECT -row_number() OVER () AS r, {_RUNS} AS words FROM benchmark),
runs AS (SELECT r, array_to_string(words[i:i + k], ' ') AS feature
    FROM (SELECT r, words, k, unnest(range(1, len(words) - k + 1)) AS i FROM (FROM d SELECT r, words UNION ALL FROM b SELECT r, words), (SELECT unnest([0, 1, 2]) AS k))),
found AS (SELECT r, feature, count(*)::BIGINT AS times FROM runs GROUP BY r, feature),
hexed AS (SELECT feature, hex(encode(feature)) AS digits FROM (SELECT DISTINCT feature FROM found)),
sums AS (SELECT feature, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(digits), 2), lambda i: ('0x' || digits[i:i + 1])::BIGINT)),
    lambda c, byte: xor(c >> 8, steps[(xor(c, byte) & 255) + 1])), 4294967295) % 10000 AS bucket FROM hexed, steps),
per AS (SELECT r, bucket, sum(times)::BIGINT AS times FROM found JOIN sums USING (feature) GROUP BY r, bucket),
buckets AS (SELECT bucket, coalesce(sum(times) FILTER (r > 0), 0)::DOUBLE AS s, coalesce(sum(times) FILTER (r < 0), 0)::DOUBLE AS t FROM per GROUP BY bucket),
totals AS (SELECT coalesce(sum(s), 0) AS all_s, coalesce(sum(t), 0) AS all_t FROM buckets),
gains AS (SELECT bucket, floor(1000 * ln((t + 1) * (all_s + 10000) / ((s + 1) * (all_t + 10000))))::BIGINT AS gain FROM buckets, totals),
weights AS (SELECT r, sum(times)::BIGINT AS n_features, sum(times * gain)::BIGINT AS weight FROM per JOIN gains USING (bucket) WHERE r > 0 GROUP BY r),
scores AS (SELECT r, doc_id, len(words) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('42:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score
    FROM d LEFT JOIN weights USING (r)),
drawn AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id)::BIGINT AS rank, count(*) OVER () AS n FROM scores WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 5 * n // 100 THEN rank END AS rank FROM scores LEFT JOIN drawn USING (r)"""

ORACLE: dict[str, str] = {"op6_quality": QUALITY, "op12_resampling": RESAMPLING, "op13_search": SEARCH}
