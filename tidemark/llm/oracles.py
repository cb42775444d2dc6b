r"""SQL counterparts of the corpus queries, where SQL can express them.

The others are held against brute force in tests/llm: op3 (byte strings), op5 (a trained model), op7 (estimated
accuracies), op8 (alignment), op9 and op10 (a tokenizer).
"""

from __future__ import annotations

WORDS = r"[^\x20\x09-\x0D]+"

#: crc32 of a text's bytes, with its table of 256 built by the rule of the reflected polynomial.
CRC = """
xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)),
  lambda a, b: xor(a >> 8, crc_of[1 + (xor(a, b) & 255)])), 4294967295::BIGINT)
"""


def _rounds(shards: int, source: str) -> str:
    """The jump hash of doc_id, one round after the other over all rows; a row stops where its place leaves the shards."""
    step = "((k * 2862933555777941757 + 1) % 18446744073709551616)"
    return f"""
  SELECT * FROM (WITH RECURSIVE r(doc_id, k, b, j) AS (
    SELECT doc_id, doc_id::UHUGEINT, -1::BIGINT, 0::BIGINT FROM {source}
    UNION ALL
    SELECT doc_id, k2, j, floor((j + 1) * (2147483648.0::DOUBLE / ((k2 // 8589934592)::DOUBLE + 1)))::BIGINT
    FROM (SELECT *, {step} AS k2 FROM r WHERE j < {shards}))
  SELECT doc_id, b::INTEGER AS shard FROM r WHERE j >= {shards})"""


OP1 = f"""
WITH bits AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n::BIGINT, range(8)),
    lambda a, i: CASE WHEN (a & 1) = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END)) AS crc_of),
sized AS (SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT + 1 AS size,
    ({CRC.format(text="coalesce(text, '')")})::BIGINT AS text_crc32 FROM documents, bits),
here AS ({_rounds(8, "documents")}),
grown AS ({_rounds(9, "documents")})
SELECT doc_id, size, text_crc32, 'key' AS law, here.shard AS shard,
  row_number() OVER (PARTITION BY here.shard ORDER BY doc_id % 1024, doc_id) - 1 AS slot, grown.shard AS grown_shard
FROM sized JOIN here USING (doc_id) JOIN grown USING (doc_id)
"""

#: The shortest windows of whole lines with 8 words that begin, or end, at a line; the first of equal ones in the order of
#: (doc_id, line) kept.
OP2 = f"""
WITH lines AS (
  SELECT doc_id, line, txt, len(regexp_extract_all(txt, '{WORDS}')) AS n FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS txt, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM documents)),
filled AS (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY line) AS upto FROM lines WHERE n > 0),
windows AS (
  SELECT s.doc_id AS doc_id, s.line AS line, e.line AS last
  FROM filled s ASOF JOIN filled e ON s.doc_id = e.doc_id AND s.upto - s.n + 8 <= e.upto
  UNION
  SELECT e.doc_id AS doc_id, s.line AS line, e.line AS last
  FROM filled e ASOF JOIN filled s ON e.doc_id = s.doc_id AND e.upto - 8 >= s.upto - s.n),
bodies AS (
  SELECT w.doc_id AS doc_id, w.line AS line, w.last AS last, string_agg(f.txt, chr(10) ORDER BY f.line) AS body
  FROM windows w JOIN filled f ON f.doc_id = w.doc_id AND f.line BETWEEN w.line AND w.last GROUP BY ALL),
late AS (SELECT doc_id, line, last FROM (SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, line) AS nth FROM bodies) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(line, last + 1)) AS line FROM late),
runs AS (SELECT doc_id, count(*) AS removed_lines, count(*) FILTER (WHERE before IS NULL OR before < line - 1) AS removed_runs
  FROM (SELECT doc_id, line, lag(line) OVER (PARTITION BY doc_id ORDER BY line) AS before FROM gone) GROUP BY doc_id),
kept AS (SELECT l.doc_id AS doc_id, string_agg(l.txt, chr(10) ORDER BY l.line) AS rest
  FROM lines l ANTI JOIN gone g ON g.doc_id = l.doc_id AND g.line = l.line GROUP BY l.doc_id)
SELECT d.doc_id AS doc_id, CASE WHEN r.doc_id IS NULL THEN d.text ELSE coalesce(k.rest, '') END AS text,
  coalesce(r.removed_lines, 0)::INTEGER AS removed_lines, coalesce(r.removed_runs, 0)::INTEGER AS removed_runs
FROM documents d LEFT JOIN runs r ON r.doc_id = d.doc_id LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

#: Full sets compared wherever two documents share a shingle, then the smallest reachable id.
OP4 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORDS}') AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(list_slice(w, i, i + 3), ' ')) END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, low) AS (SELECT a, a FROM edges UNION SELECT e.b, r.low FROM reached r JOIN edges e ON e.a = r.doc_id WHERE r.low < e.b),
lowest AS (SELECT doc_id, min(low) AS low FROM reached GROUP BY doc_id)
SELECT d.doc_id AS doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, coalesce(l.low, d.doc_id)::BIGINT AS component_id,
  d.doc_id = coalesce(l.low, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN lowest l ON l.doc_id = d.doc_id
"""

_ESCAPED = r"replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>')"
OP6 = rf"""
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length('### ' || role || ': ') + length({_ESCAPED}) + length(' </turn>' || chr(10)))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""


_SHA = "sha256('7:' || coalesce(doc_id::VARCHAR, ''))"
OP11 = rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text, {_SHA} AS h FROM documents),
drawn AS (SELECT *, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS u, {", ".join(f"('0x' || substr(h, {8 * i + 1}, 8))::BIGINT AS h{i + 1}" for i in range(4))} FROM texts),
cuts AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
    WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
cut AS (SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix FROM cuts)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(prefix)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM cut
"""


def _vector_rounds(rounds: int, parts: int, entries: int) -> str:
    """Assignments a0 .. a{rounds}, each from all distances, and the codebooks b0 .. b{rounds} between them."""
    steps = [
        f"b0 AS (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, comp FROM parts"
        f" WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {entries}))"
    ]
    for r in range(rounds + 1):
        steps.append(
            f"a{r} AS (SELECT vec_id, part, min(pair[1]) AS dist, arg_min(pair[2], pair) AS entry FROM (SELECT vec_id, p.part AS part,"
            f" [list_sum(list_transform(list_zip(p.comp, b{r}.comp), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, entry] AS pair"
            f" FROM parts p JOIN b{r} ON p.part = b{r}.part) GROUP BY vec_id, part)"
        )
        if r < rounds:
            steps.append(
                f"m{r} AS (SELECT part, entry, list(mean ORDER BY place) AS comp FROM (SELECT part, entry, place, (s - ((s % n) + n) % n) // n AS mean FROM ("
                f"SELECT part, entry, place, sum(v)::BIGINT AS s, count(*) AS n FROM (SELECT part, entry, unnest(comp) AS v, generate_subscripts(comp, 1) AS place"
                f" FROM parts JOIN a{r} USING (vec_id, part)) GROUP BY ALL)) GROUP BY part, entry),\n"
                f"b{r + 1} AS (SELECT part, entry, coalesce(m{r}.comp, b{r}.comp) AS comp FROM b{r} LEFT JOIN m{r} USING (part, entry))"
            )
    return ",\n".join(steps)


OP12 = f"""
WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
parts AS (SELECT vec_id, part, v[(part * len(v) // 16 + 1):((part + 1) * len(v) // 16)] AS comp FROM kept, range(16) t(part)),
{_vector_rounds(2, 16, 64)},
codes AS (SELECT vec_id, string_agg(lpad(to_hex(entry), 2, '0'), '' ORDER BY part) AS code, sum(dist)::BIGINT AS error FROM a2 GROUP BY vec_id),
books AS (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, place)) AS digest
  FROM (SELECT part, entry, unnest(comp) AS v, generate_subscripts(comp, 1) AS place FROM b2))
SELECT vec_id, lower(code) AS code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, digest AS codebooks_sha256
FROM codes JOIN kept USING (vec_id), books
"""

#: Sources by the ratio of limit to weight: those whose limit is below what the level after them would give stop at it.
OP13 = f"""
WITH sized AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORDS}'))::BIGINT AS size FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1]::BIGINT AS weight FROM sources),
ranked AS (SELECT *, row_number() OVER (ORDER BY source_size::DOUBLE / weight, source) AS k FROM weighed),
levels AS (SELECT k, (sum(source_size) OVER ())::BIGINT - coalesce(sum(3 * source_size) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS rest,
  (sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS shares, 3 * source_size AS most, weight FROM ranked),
level AS (SELECT rest, shares FROM levels WHERE most::HUGEINT * shares > weight::HUGEINT * rest ORDER BY k LIMIT 1),
targets AS (SELECT source, source_size, CASE WHEN rest IS NULL OR 3 * source_size::HUGEINT * shares <= weight::HUGEINT * rest THEN (3 * source_size)::DOUBLE
  ELSE weight::DOUBLE * rest::DOUBLE / shares::DOUBLE END AS target FROM weighed LEFT JOIN level ON true),
rated AS (SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM (SELECT *, (floor(rate)
  + (('0x' || substr(sha256('13:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE < rate - floor(rate))::INTEGER)::INTEGER AS copies FROM rated)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_sharding": OP1, "op2_line_dedup": OP2, "op4_near_dedup": OP4, "op6_chat_format": OP6} | {
        "op11_fill_middle": OP11, "op12_vector_codes": OP12, "op13_mixing": OP13,
    }
