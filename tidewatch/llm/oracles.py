"""DuckDB SQL for the queries that SQL can express."""

from .urls import BASE, DOUBT, RULES, THRESHOLD, WEIGHT, Z

ORACLES = {}

ORACLES["op1_topk"] = """
WITH v AS (
  SELECT DISTINCT vec_id,
         list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), c AS (
  SELECT vec_id, unnest(range(1, len(v) + 1)) AS i, unnest(v) AS w FROM v
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.w * c.w) AS BIGINT) AS score
  FROM c AS q JOIN c ON q.i = c.i AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0
  GROUP BY q.vec_id, c.vec_id
), r AS (
  SELECT query_id, vec_id, score,
         row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""

ORACLES["op7_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source,
         CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                              lambda x: x <> '')) AS BIGINT) AS size,
         (CAST(('0x' || substr(md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13)) AS BIGINT)
          + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
  SELECT source, source_size,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS turn,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
           WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight,
         CAST(2 * source_size AS DOUBLE) AS cap
  FROM s
), l AS (
  SELECT *, row_number() OVER o AS place,
         (1.5::DOUBLE * CAST(sum(source_size) OVER () AS DOUBLE)
          - CAST(coalesce(sum(2 * source_size) OVER (ORDER BY cap / weight, turn
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
         / CAST(sum(weight) OVER (ORDER BY cap / weight, turn
              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM w WINDOW o AS (ORDER BY cap / weight, turn)
), m AS (
  SELECT (SELECT level FROM l WHERE cap / weight > level ORDER BY place LIMIT 1) AS common
), t AS (
  SELECT source, source_size, coalesce(least(cap, weight * common), cap) AS target FROM l, m
), h AS (
  SELECT source, size, CAST(count(*) AS BIGINT) AS n,
         CAST(floor(1024 * sqrt(CAST(size AS DOUBLE))) AS BIGINT) AS pull
  FROM d GROUP BY source, size
), f AS (
  SELECT h.source, size, pull,
         (target - 2 * CAST(coalesce(sum(size * n) OVER (PARTITION BY h.source ORDER BY size DESC
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
         / nullif(CAST(sum(size * n * pull) OVER (PARTITION BY h.source ORDER BY size DESC
              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE), 0) AS tried
  FROM h JOIN t ON h.source IS NOT DISTINCT FROM t.source
), g AS (
  SELECT source, arg_max(tried, size) FILTER (WHERE tried * pull < 2) AS factor
  FROM f GROUP BY source
), e AS (
  SELECT d.*, t.source_size, t.target,
         CASE WHEN size = 0 THEN 0.0::DOUBLE WHEN factor IS NULL THEN 2.0::DOUBLE
              ELSE least(2.0::DOUBLE, factor * CAST(floor(1024 * sqrt(CAST(size AS DOUBLE))) AS BIGINT))
         END AS copies
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
         JOIN g ON d.source IS NOT DISTINCT FROM g.source
), p AS (
  SELECT *, CAST(floor(copies) AS BIGINT) AS certain, copies - floor(copies) AS p,
         target - CAST(sum(CAST(floor(copies) AS BIGINT) * size) OVER (PARTITION BY source) AS DOUBLE) AS rest
  FROM e
), k AS (
  SELECT *, (u / (1 - u)) / (p / (1 - p)) AS rank FROM p WHERE p > 0
), x AS (
  SELECT doc_id, sum(size) OVER (PARTITION BY source ORDER BY rank, doc_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size / 2.0 <= rest AS extra
  FROM k
)
SELECT p.doc_id, p.size, p.source_size, p.target,
       CAST((p.certain + CASE WHEN coalesce(x.extra, false) THEN 1 ELSE 0 END) * p.size AS BIGINT) AS taken
FROM p LEFT JOIN x ON p.doc_id = x.doc_id
"""


#: Enough for paths of this many segments less one; the tables have three at most.
_URL_LEVELS = 8


def _urls() -> str:
    """The tree of op5, level by level."""

    def fits(rule) -> str:
        return (
            f"(host = '{rule.host}' OR ends_with(host, '.{rule.host}'))"
            f" AND starts_with(path, '{rule.path}')"
        )

    ordered = sorted(RULES, key=lambda r: -len(r.name))
    named = " ".join(f"WHEN {fits(r)} THEN '{r.name}'" for r in ordered)
    judged = " ".join(f"WHEN {fits(r)} THEN '{r.verdict}'" for r in ordered)
    plain = "translate(seg, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def purity(of: str, parent: str) -> str:
        return (f"({of}b + {WEIGHT}::DOUBLE * {parent} + {of}u * {DOUBT * BASE!r}::DOUBLE)"
                f" / ({of}l + {WEIGHT}::DOUBLE + {of}u * {DOUBT}::DOUBLE)")

    sql = f"""
WITH u AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), p AS (
  SELECT *, CASE {named} END AS rule, CASE {judged} END AS by_rule,
    list_transform(list_filter(string_split(path, '/'), lambda seg: seg <> ''), lambda seg:
      CASE WHEN regexp_matches({plain}, '^[0-9a-f-]{{8,}}$') AND regexp_matches({plain}, '[0-9]')
           THEN '<id>'
           WHEN regexp_matches({plain}, '^[^-_]+([-_][^-_]+){{2,}}$') THEN '<slug>'
           ELSE regexp_replace({plain}, '[0-9]+', '<n>', 'g') END) AS segs
  FROM u
), shapes AS (
  SELECT host, segs, CAST(count(by_rule) AS DOUBLE) AS l,
         CAST(count(*) FILTER (WHERE by_rule = 'block') AS DOUBLE) AS b,
         CAST(count(*) FILTER (WHERE by_rule IS NULL) AS DOUBLE) AS u
  FROM p GROUP BY host, segs
), roots AS (
  SELECT host, {purity('r', f'{BASE}::DOUBLE')} AS purity
  FROM (SELECT host, sum(b) AS rb, sum(l) AS rl, sum(u) AS ru FROM shapes GROUP BY host)
), t0 AS (
  SELECT shapes.*, '' AS prefix, purity FROM shapes JOIN roots USING (host)
)"""
    for i in range(_URL_LEVELS):
        sql += f""", c{i} AS (
  SELECT host, prefix, coalesce(segs[{i + 1}], '$') AS level, sum(b) AS cb, sum(l) AS cl, sum(u) AS cu
  FROM t{i} GROUP BY ALL
), k{i} AS (
  SELECT *, sum(cb) OVER g AS pb, sum(cl) OVER g AS pl
  FROM c{i} WINDOW g AS (PARTITION BY host, prefix)
), m{i} AS (
  SELECT host, prefix, level, cb, cl, cu,
    CASE WHEN level = '$' THEN '$'
         WHEN cl > 0 AND pb > 0 AND pb < pl
              AND abs(cb / cl - pb / pl) > {Z}::DOUBLE * sqrt(pb / pl * (1 - pb / pl) / cl) THEN level
         WHEN cl > 0 THEN '<~>' ELSE '<?>' END AS node
  FROM k{i}
), n{i} AS (
  SELECT *, sum(cb) OVER g AS nb, sum(cl) OVER g AS nl, sum(cu) OVER g AS nu
  FROM m{i} WINDOW g AS (PARTITION BY host, prefix, node)
), t{i + 1} AS (
  SELECT t{i}.host, segs, l, b, u,
    CASE WHEN ends_with(t{i}.prefix, '/$') THEN t{i}.prefix ELSE t{i}.prefix || '/' || node END AS prefix,
    CASE WHEN ends_with(t{i}.prefix, '/$') THEN purity ELSE {purity('n', 'purity')} END AS purity
  FROM t{i} JOIN n{i} ON t{i}.host = n{i}.host AND t{i}.prefix = n{i}.prefix
   AND coalesce(segs[{i + 1}], '$') = level
)"""
    return sql + f"""
SELECT page_id, host, path, rule, prefix AS template, purity,
       coalesce(by_rule, CASE WHEN purity > {THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict
FROM p JOIN t{_URL_LEVELS} USING (host, segs)
"""


ORACLES["op5_urls"] = _urls()

ORACLES["op10_quality"] = r"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT doc_id, text,
         list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         string_split(text, chr(10)) AS lines
  FROM base
), gram AS (
  SELECT doc_id, i,
         w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM split, unnest(range(1, len(w) - 1)) AS r(i)
), twice AS (
  SELECT doc_id, g FROM gram GROUP BY doc_id, g HAVING count(*) > 1
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n
  FROM gram JOIN twice USING (doc_id, g), unnest([0, 1, 2]) AS o(k)
  GROUP BY doc_id
), line AS (
  SELECT doc_id, l, regexp_replace(l, '[\x20\x09-\x0D]', '', 'g') AS solid,
         lower(trim(l, ' ' || chr(9) || chr(11) || chr(12) || chr(13))) AS plain
  FROM split, unnest(lines) AS u(l)
), lines AS (
  SELECT doc_id,
         count(*) - count(DISTINCT l) AS n_dup_lines,
         sum(CASE WHEN
           length(regexp_replace(l, '[^#*$%&|<>]', '', 'g')) > 0.08 * length(l)
           OR (length(regexp_replace(l, '[^!]', '', 'g')) > 0.08 * length(l)
               AND length(regexp_replace(l, '[^!]', '', 'g')) > 2)
           OR (length(regexp_replace(l, '[^|»›•·]', '', 'g')) >= 2
               AND length(regexp_replace(l, '[^|»›•·]', '', 'g')) * 25 >= length(l))
           OR plain IN ('home', 'menu', 'next', 'previous', 'back to top', 'read more',
                        'log in', 'sign up', 'skip to content', 'share this', 'search')
           OR contains(plain, 'all rights reserved') OR contains(plain, 'terms of use')
           OR contains(plain, 'terms of service') OR contains(plain, 'privacy policy')
           OR contains(plain, 'cookie policy') OR contains(plain, 'accept cookies')
           OR contains(plain, 'uses cookies') OR contains(plain, 'enable javascript')
           OR contains(plain, 'lorem ipsum') OR contains(plain, 'licensed under')
           OR contains(plain, 'copyright (c)') OR contains(plain, '©')
         THEN 0 ELSE length(solid) END) AS left_chars
  FROM line WHERE solid <> '' GROUP BY doc_id
), counts AS (
  SELECT s.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(l.n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
         coalesce(l.left_chars, 0) AS left_chars
  FROM split s LEFT JOIN covered c USING (doc_id) LEFT JOIN lines l USING (doc_id)
), marked AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         CASE WHEN word_chars = 0 THEN 0.0::DOUBLE
              ELSE 1 - CAST(left_chars AS DOUBLE) / CAST(word_chars AS DOUBLE) END AS lost
  FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND lost <= 0.5 AS kept, lost
FROM marked
"""


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of a text of one-byte and two-byte characters, bit by bit."""
    step = """list_reduce(list_concat([xor(a, b)], range(8)),
                       lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))"""
    codes = f"""flatten(list_transform(range(1, length({text}) + 1), lambda i:
      CASE WHEN ord(substr({text}, i, 1)) < 128 THEN [CAST(ord(substr({text}, i, 1)) AS BIGINT)]
           ELSE [192 + (CAST(ord(substr({text}, i, 1)) AS BIGINT) >> 6),
                 128 + (CAST(ord(substr({text}, i, 1)) AS BIGINT) & 63)] END))"""
    all_bytes = f"list_concat([CAST(4294967295 AS BIGINT)], {codes})"
    return f"xor(4294967295, list_reduce({all_bytes}, lambda a, b: {step}))"


ORACLES["op11_spelling"] = rf"""
WITH r AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS run
  FROM documents
), l AS (
  SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run,
         count(*) AS n
  FROM r WHERE length(run) >= 7 GROUP BY ALL
), h AS (
  SELECT run, n, {_crc32("(id || ':' || run)")} AS h FROM l
), w AS (
  SELECT CASE WHEN h % 31 = 0
              THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
              ELSE run END AS word, n
  FROM h
), v AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM w
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), cuts AS (
  SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, unnest(range(0, length(word))) AS i FROM v)
), p AS (
  SELECT a.word, b.word AS other FROM cuts AS a JOIN cuts AS b
    ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT cuts.word, v.word FROM cuts JOIN v ON cuts.rest = v.word
  UNION
  SELECT v.word, cuts.word FROM cuts JOIN v ON cuts.rest = v.word
), m AS (
  SELECT p.word, p.other, v.n AS other_n,
         row_number() OVER (PARTITION BY p.word ORDER BY v.n DESC, encode(p.other)) AS place,
         count(*) OVER (PARTITION BY p.word) AS n_near
  FROM p JOIN v ON p.other = v.word
), f AS (
  SELECT v.word, v.n, coalesce(m.n_near, 0) AS n_near,
         CASE WHEN m.other_n >= 10 * v.n THEN m.other END AS form,
         CASE WHEN m.other_n >= 10 * v.n THEN m.other_n END AS form_n
  FROM v LEFT JOIN m ON v.word = m.word AND m.place = 1
), steps AS (
  WITH RECURSIVE s AS (
    SELECT word, word AS pos, form FROM f
    UNION ALL
    SELECT s.word, f.word, f.form FROM s JOIN f ON s.form = f.word
  )
  SELECT word, pos AS root FROM s WHERE form IS NULL
)
SELECT f.word, f.form, steps.root, f.n, f.n_near, f.form_n FROM f JOIN steps ON f.word = steps.word
"""


def _levels(name: str, depth: int) -> str:
    """CTEs name0 .. name<depth> of (grp, pos, n, digest): each level of the trees in name0."""
    out = []
    for k in range(1, depth + 1):
        out.append(f"""{name}{k} AS (
  SELECT grp, pos // 16 AS pos, (n + 15) // 16 AS n,
         CASE WHEN n > 1 THEN sha256(string_agg(digest, '' ORDER BY pos)) ELSE max(digest) END AS digest
  FROM {name}{k - 1} GROUP BY grp, pos // 16, n
)""")
    return ",\n".join(out)


def _sides(name: str, depth: int) -> str:
    """CTE name_side of (k, grp, pos, n, l, r): what stands beside each node pos each level."""
    of = [f"""SELECT {k} AS k, grp, pos, n,
         coalesce(string_agg(digest, '') OVER (PARTITION BY grp, pos // 16 ORDER BY pos
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(digest, '') OVER (PARTITION BY grp, pos // 16 ORDER BY pos
                  ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}{k}""" for k in range(depth)]
    return f"{name}_side AS (\n  " + "\n  UNION ALL ".join(of) + "\n)"


def _merkle(depth: int) -> str:
    def part(column):
        text = f"CAST({column} AS VARCHAR)"
        return f"coalesce(CAST(strlen({text}) AS VARCHAR) || ':' || {text}, '-')"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    head = " || ".join(part(c) for c in ("doc_id", "source", "lang", "n_chars"))
    joins, steps = [], []
    for tree, pos in (("g", "d.pos"), ("t", "s.pos")):
        grp = "d.grp" if tree == "g" else "''"
        for k in range(depth):
            joins.append(
                f"JOIN {tree}_side AS {tree}{k}_ ON {tree}{k}_.k = {k} AND {tree}{k}_.grp = {grp}"
                f" AND {tree}{k}_.pos = {pos} // {16**k}"
            )
            steps.append(f"{tree}{k}_")
    siblings = " || ".join(f"{s}.l || {s}.r" for s in steps)
    folds, now = [], "now"
    for k, s in enumerate(steps):
        folds.append(f"f{k} AS (SELECT *, CASE WHEN n{k} > 1 THEN sha256(l{k} || {now} || r{k})"
                     f" ELSE {now} END AS now{k} FROM {f'f{k - 1}' if k else 'j'})")
        now = f"now{k}"
    sides = ", ".join(f"{s}.l AS l{k}, {s}.r AS r{k}, {s}.n AS n{k}" for k, s in enumerate(steps))
    return f"""
WITH leaves AS (
  SELECT doc_id, coalesce('=' || source, '') AS grp,
         sha256({head} || {part("text")}) AS digest,
         CASE WHEN {_crc32("coalesce(CAST(doc_id AS VARCHAR), 'x')")} % 5 = 0 AND doc_id IS NOT NULL
              THEN sha256({head} || {part(lower)})
              ELSE sha256({head} || {part("text")}) END AS now
  FROM documents
), d AS (
  SELECT doc_id, grp, digest, now, count(*) OVER (PARTITION BY grp) AS n,
         row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos
  FROM leaves
), g0 AS (
  SELECT grp, pos, n, digest FROM d
), {_levels("g", depth)}, {_sides("g", depth)}, s AS (
  SELECT grp AS of, digest AS subroot, row_number() OVER (ORDER BY encode(grp)) - 1 AS pos,
         count(*) OVER () AS n
  FROM g{depth}
), t0 AS (
  SELECT '' AS grp, pos, n, subroot AS digest FROM s
), {_levels("t", depth)}, {_sides("t", depth)}, j AS (
  SELECT d.doc_id, d.digest AS leaf, s.subroot, t{depth}.digest AS root, d.now,
         sha256({siblings}) AS proof_sha256, {sides}
  FROM d JOIN s ON d.grp = s.of JOIN t{depth} ON true
  {' '.join(joins)}
), {", ".join(folds)}
SELECT doc_id, leaf, subroot, root, proof_sha256, {now} AS folded_root, {now} = root AS verified
FROM f{len(steps) - 1}
"""


#: As many levels as 16**5 documents in a source, or sources, need; those left over change nothing.
ORACLES["op12_merkle"] = _merkle(5)

ORACLES["op13_warc"] = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body FROM pages
), d AS (
  SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS hex,
         max(page_id) OVER (PARTITION BY body) AS best
  FROM p
), b AS (
  SELECT *, array_to_string(list_transform(range(0, 32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             CAST((CAST('0x' || substr(hex, 10 * (i // 8) + 1, 10) AS BIGINT)
                   >> (35 - 5 * (i % 8))) & 31 AS INTEGER) + 1, 1)), '') AS payload_digest
  FROM d
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM best THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM best THEN best END AS refers_to,
       CASE WHEN page_id IS NOT DISTINCT FROM best THEN true END AS intact
FROM b
"""
